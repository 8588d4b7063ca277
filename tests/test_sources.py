import pytest

from cohortry.plans import QUERIES
from cohortry.session import shared_dir
from cohortry.sources import codelists, extracts, tables

from .conftest import SMALL

SCHEMA_XML = """<schema><columns>
<datacolumn><displayname>Value</displayname><header>value</header><columnposition>3</columnposition></datacolumn>
<datacolumn><displayname>Patient</displayname><header>patid</header><columnposition>1</columnposition></datacolumn>
<datacolumn><displayname>Code</displayname><header>medcodeid</header><columnposition>2</columnposition></datacolumn>
</columns></schema>"""
LOG_XML = """<log>
<section><title>DrugIssue data request</title><item><text>started</text></item>
<item><timestamp>t1</timestamp><text>2 records retrieved in 3 seconds</text></item></section>
<section><title>Patient data request</title><item><timestamp>t2</timestamp><text>Found 5  records retrieved</text></item></section>
<section><title>Other</title><item><text>nothing</text></item></section></log>"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "a.txt").write_text("patid\tmedcodeid\tvalue\n1\t007\tx\n2\t8\t\n")
    (tmp_path / "data" / "b.txt").write_text("patid\tmedcodeid\tvalue\n3\t9\t1.5\n")
    (tmp_path / "data" / "notes.csv").write_text("not part of the extract\n")
    (tmp_path / "schema.xml").write_text(SCHEMA_XML)
    (tmp_path / "log.xml").write_text(LOG_XML)
    return tmp_path


def test_schema_in_column_order(spark, folder):
    schema = extracts.extract_schema(spark, str(folder / "schema.xml"))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [("patid", "string"), ("medcodeid", "string"), ("value", "string")]
    rows = extracts.schema_from_xml(spark, str(folder / "schema.xml")).collect()
    assert {(r.displayname, r.header, r.columnposition) for r in rows} == {("Value", "value", 3), ("Patient", "patid", 1), ("Code", "medcodeid", 2)}


@pytest.mark.parametrize("with_schema", [True, False])
def test_extract_reads_all_text_files(spark, folder, with_schema):
    df = extracts.read_extract(spark, str(folder / "data"), str(folder / "schema.xml") if with_schema else None)
    assert {tuple(r) for r in df.collect()} == {("1", "007", "x"), ("2", "8", None), ("3", "9", "1.5")}


def test_log_counts_and_check(spark, folder):
    counts = extracts.read_log_counts(spark, str(folder / "log.xml"))
    assert {tuple(r) for r in counts.collect()} == {("DrugIssue data request", 2), ("Patient data request", 5)}
    found = {"DrugIssue data request": spark.range(2), "Patient data request": spark.range(4), "Practice data request": spark.range(1)}
    rows = {tuple(r) for r in extracts.check_count(counts, found).collect()}
    assert rows == {("DrugIssue data request", 2, 2, True), ("Patient data request", 5, 4, False), ("Practice data request", None, 1, False)}
    with pytest.raises(ValueError, match="found"):
        extracts.check_count(counts, found, strict=True)
    good = {"DrugIssue data request": spark.range(2)}
    assert extracts.check_count(counts, good, strict=True).count() == 1


def test_codelists_of_any_column_names(spark, tmp_path):
    (tmp_path / "m.txt").write_text("MedCodeId\tOther\tTerm\n1\tz\tAsthma\n1\ty\tAsthma\n2\tx\tWheeze\n")
    (tmp_path / "p.txt").write_text("drugsubstancename\tProdCodeId\nSimvastatin\t10\n")
    (tmp_path / "n.txt").write_text("Group\tprodcodeid\n3\t11\n")
    rows = codelists.read_codelists(spark, {n: str(tmp_path / f"{n}.txt") for n in "mpn"}).collect()
    assert {tuple(r) for r in rows} == {("m", "1", "Asthma"), ("m", "2", "Wheeze"), ("p", "10", "Simvastatin"), ("n", "11", None)}
    (tmp_path / "bad.txt").write_text("a\tb\n1\t2\n")
    with pytest.raises(ValueError, match="codelist bad"):
        codelists.read_codelist(spark, str(tmp_path / "bad.txt"), "bad")


def test_split_by_term_keeps_a_code_in_one_part(spark):
    rows = [("l", "1", "RHABDOmyolysis"), ("l", "1", "other name"), ("l", "2", "myopathy"), ("l", "3", None)]
    found, rest = codelists.codelist_split_by_term(spark.createDataFrame(rows, "list_name string, code string, term string"), "rhabdo")
    assert [r.code for r in found.collect()] == ["1"]
    assert sorted(r.code for r in rest.collect()) == ["2", "3"]


def test_codelist_from_blank_separated_text(spark, tmp_path):
    (tmp_path / "l.txt").write_text("'12 345 some long term'\n'7\t 8\n'only\n\n'  9   10   x y\n")
    rows = codelists.codelist_from_text(spark, str(tmp_path / "l.txt")).collect()
    assert {tuple(r) for r in rows} == {("12", "345"), ("7", "8"), ("9", "10")}


def test_write_only_when_asked(spark):
    path, df = shared_dir(spark), spark.range(3)
    assert tables.write_table(df, path, save=False) is df
    assert tables.write_table(df, path).count() == 3
    assert tables.write_table(spark.range(2), path).count() == 2


def test_layout_spreads_a_hot_key_and_equal_rows(spark):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS patid", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS x")
    source, path = shared_dir(spark), shared_dir(spark)
    tables.write_table(df, source)
    stored = tables.cluster_layout(spark, source, path, partitions=6)
    assert not stored.exceptAll(df).count() and stored.count() == 9000
    sizes = stored.selectExpr("input_file_name() AS f", "patid").groupBy("f").agg({"patid": "count"}).collect()
    assert len(sizes) == 6 and max(r[1] for r in sizes) < 2 * 9000 / 6


def test_export_is_whole_in_one_or_many_files(spark, tmp_path):
    df = spark.range(100).repartition(4).selectExpr("id", "array(id, id + 1) AS a")
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    tables.export_delimited(df, one, sep="\t", single_file=True)
    tables.export_delimited(df, many)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1 and len(list((tmp_path / "many").glob("part-*"))) == 4
    for path, sep in ((one, "\t"), (many, ",")):
        back = extracts.read_csv_typed(spark, path, "id bigint, a string", sep)
        assert {(r.id, r.a) for r in back.collect()} == {(i, f"{i},{i + 1}") for i in range(100)}


def test_batches_are_cut_to_the_contract(spark, tmp_path):
    columns = tables.CONTRACTS["practice"]
    for i in range(2):
        spark.createDataFrame([(f"{i}", "extra", "b", "c", "d")], "pracid string, extra string, region string, uts string, lcd string").write.parquet(str(tmp_path / str(i)))
    df = tables.read_batches(spark, [str(tmp_path / "0"), str(tmp_path / "1")], "practice")
    assert tuple(df.columns) == columns and sorted(r.pracid for r in df.collect()) == ["0", "1"]


class NamedSession:
    """Stands for a session of a cluster whose settings name a shared folder, or none."""

    def __init__(self, spark, folder):
        self.conf = self
        self.folder, self.sparkContext, self.master = folder, self, "spark://cluster"
        self._jsc = spark.sparkContext._jsc

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.folder


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) != shared_dir(spark)
    assert shared_dir(NamedSession(spark, "hdfs://store/shared/")).startswith("hdfs://store/shared/cohortry-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(NamedSession(spark, None))


def test_materialise_reads_back_what_was_stored(spark):
    stored = tables.materialise(spark.range(5).selectExpr("id", "uuid() AS u"))
    assert stored.exceptAll(stored).count() == 0 and stored.count() == 5 and stored.inputFiles()


def test_schemas_are_not_merged_on_writing_parquet(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), str(tmp_path / "t"), merge_schema=True)


def test_export_query_is_written_in_parallel(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda self, n: pytest.fail("one task writes the table"))
    assert QUERIES["export_delimited"](spark, SMALL).count() > 0
