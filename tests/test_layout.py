"""Stored layouts, checks of delivered files, packed records and comparison by hashes."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortry.functions.dates import pack_last, pack_pick, unpack_last, unpack_pick
from cohortry.operators import events, outcome, sets
from cohortry.plans.whole import research_bucketed, whole_study
from cohortry.sources import extracts, layout, tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_meet_without_a_shuffle(spark):
    rows = spark.range(2000).selectExpr("id % 97 AS patid", "id AS v")
    a, b = layout.write_bucketed(rows, buckets=4), layout.write_bucketed(rows.withColumnRenamed("v", "w"), buckets=4)
    joined = a.groupBy("patid").agg(F.sum("v").alias("v")).hint("merge").join(b.groupBy("patid").agg(F.max("w").alias("w")), "patid")
    assert "hashpartitioning" not in plan(joined)
    plain = rows.groupBy("patid").agg(F.sum("v").alias("v"), F.max("v").alias("w"))
    assert sorted(joined.collect()) == sorted(plain.select(joined.columns).collect())


def test_research_on_buckets_does_not_shuffle_events_by_patient(views):
    text = plan(research_bucketed(views))
    assert "Bucketed: true" in text or "SelectedBucketsCount" in text
    for line in text.splitlines():
        assert "Exchange hashpartitioning(patid" not in line


def files_read(folder, column, value):
    """Files whose statistics do not rule the value out."""
    hit = 0
    for path in Path(folder.removeprefix("file:")).glob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        k = meta.schema.names.index(column)
        hit += any(s.min <= value <= s.max for g in range(meta.num_row_groups) if (s := meta.row_group(g).column(k).statistics))
    return hit


@pytest.mark.parametrize("code", ["id * 7919 % 512", "concat('c', lpad(id * 7919 % 512, 4, '0'))"])
def test_interleaved_files_serve_both_keys(spark, tmp_path, code):
    rows = spark.range(64 * 512).selectExpr("id % 640 AS patid", f"{code} AS code", "id AS other")
    rows.write.parquet(f"{tmp_path}/plain")
    one = tables.cluster_layout(spark, f"{tmp_path}/plain", f"{tmp_path}/one", ("patid",), 64)
    both = layout.interleaved_layout(spark, f"{tmp_path}/plain", f"{tmp_path}/both", ("patid", "code"), 64)
    assert sorted(both.collect()) == sorted(rows.collect()) and one.count() == both.count()
    value = both.filter("patid = 300").first().code
    by_patient = {f: files_read(f"{tmp_path}/{f}", "patid", 300) for f in ("one", "both")}
    by_code = {f: files_read(f"{tmp_path}/{f}", "code", value) for f in ("one", "both")}
    assert by_code["both"] <= 24 < 60 <= by_code["one"] and by_patient["both"] <= 24
    assert by_code["both"] + by_patient["both"] < by_code["one"] + by_patient["one"]


def test_interleaved_layout_takes_nulls_and_hot_values(spark, tmp_path):
    rows = spark.range(900).selectExpr("CASE WHEN id % 3 > 0 THEN 1 ELSE nullif(id, 0) END AS patid", "CASE WHEN id % 5 > 0 THEN date'2020-01-01' END AS code")
    rows.write.parquet(f"{tmp_path}/plain")
    out = layout.interleaved_layout(spark, f"{tmp_path}/plain", f"{tmp_path}/both", ("patid", "code"), 9)
    assert sorted(out.collect(), key=str) == sorted(rows.collect(), key=str)
    assert len(list(Path(f"{tmp_path}/both").glob("*.parquet"))) > 4
    rows.limit(0).write.parquet(f"{tmp_path}/none")
    assert layout.interleaved_layout(spark, f"{tmp_path}/none", f"{tmp_path}/none2", ("patid", "code")).count() == 0


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_ranks_count_the_borders_below_in_compiled_steps(spark, ranges):
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 11 > 0 THEN id * id % 977 END AS a", "CASE WHEN id % 13 > 0 THEN concat('c', id % 50) END AS b",
        "CASE WHEN id % 7 = 0 THEN double('nan') ELSE id % 5 END AS c",
    ).cache()
    shares = ", ".join(str(k / ranges) for k in range(1, ranges))
    got = layout.with_range_ranks(rows, ["a", "b", "c"], ranges)
    assert got.columns == ["a", "b", "c", "_rank0", "_rank1", "_rank2"] and "lambda" not in plan(got)
    for name, number, rank in (("a", "double(a)", "_rank0"), ("b", "double(conv(rpad(substring(hex(encode(b, 'UTF-8')), 1, 12), 12, '0'), 16, 10))", "_rank1"), ("c", "c", "_rank2")):
        if ranges > 1:
            cuts = rows.selectExpr(f"percentile_approx({number}, array({shares}), 10000)").first()[0]
            below = " + ".join(f"int(coalesce(double('{b}') < {number}, false))" for b in cuts)
        else:
            below = "0"
        assert got.filter(f"{rank} <> {below}").count() == 0 and got.filter(f"{name} IS NULL AND {rank} <> 0").count() == 0


@pytest.mark.parametrize("value, least", [
    ("CASE WHEN id % 11 > 0 THEN id * id % 977 END", 100), ("CASE id % 400 WHEN 0 THEN double('nan') WHEN 1 THEN double('inf') ELSE id * 0.5 END", 100),
    ("CASE WHEN id % 9 > 0 THEN -double('inf') ELSE double(id) END", 2), ("CASE WHEN id % 13 > 0 THEN concat('c', lpad(id % 500, 3, '0')) END", 100),
    ("date_add(date'1990-01-01', int(id % 700))", 100), ("7", 1), ("CAST(NULL AS long)", 1),
])
def test_places_sort_like_values_within_a_range(spark, value, least):
    got = layout.with_range_ranks(spark.range(2000).selectExpr(f"{value} AS a", "id % 3 AS b"), ["a", "b"], 4, 20)
    assert got.columns == ["a", "b", "_rank0", "_rank1", "_place"]
    found = [(r._rank0, r._place) for r in got.orderBy("a").collect()]
    assert found == sorted(found) and len(set(found)) >= least and all(0 <= place < 2**20 for _, place in found)


def test_interleaved_rows_stay_in_the_order_of_the_keys_within_a_cell(spark, tmp_path):
    spark.range(5000).selectExpr("id * 7919 % 5000 AS patid", "id % 10 AS prodcodeid").write.parquet(f"{tmp_path}/plain")
    layout.interleaved_layout(spark, f"{tmp_path}/plain", f"{tmp_path}/both", partitions=1, ranges=2)
    (path,) = Path(f"{tmp_path}/both").glob("*.parquet")
    rows = pq.ParquetFile(path).read().to_pylist()
    key = [(r["patid"], r["prodcodeid"]) for r in rows]
    turns = [k for k in range(1, len(key)) if key[k] < key[k - 1]]
    assert len(rows) == 5000 and turns == [2500]  # cells of low and high patients, twice, each in the order of the keys


def test_files_are_reconciled(spark, tmp_path):
    good, cut = ["a\tb", "1\tx", "2\ty"], ["a\tb", "1\tx", "3"]
    for name, lines in (("one", good), ("two", good), ("three", cut), ("late", good)):
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "notes.md").write_text("not a record\n")
    name = F.regexp_extract("file", r"(\w+)\.txt$", 1).alias("file")
    found = extracts.check_files(spark, str(tmp_path), 2).select(name, "records", "header", "bad_records", "checksum")
    by_name = {r.file: r for r in found.collect()}
    assert set(by_name) == {"one", "two", "three", "late"} and by_name["three"].bad_records == 1 and by_name["one"].records == 2
    assert by_name["one"].checksum == by_name["two"].checksum != by_name["three"].checksum
    sent = spark.createDataFrame([(n, 2, "a\tb", by_name["one"].checksum) for n in ("one", "two", "three", "lost")], "file string, records long, header string, checksum long")
    seen = {r.file: (r.missing, r.unexpected, r.records_ok, r.header_ok, r.checksum_ok) for r in extracts.reconcile_files(sent, found).collect()}
    assert seen == {
        "one": (False, False, True, True, True), "two": (False, False, True, True, True), "three": (False, False, True, True, False),
        "lost": (True, False, False, False, False), "late": (False, True, False, False, False),
    }


def test_packed_records_sort_and_come_back(spark):
    days = [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]
    amounts = [None, -(2**31), -1, 0, 2**31 - 1]
    df = spark.createDataFrame([(d, r, a) for d in days for r in range(1, 6) for a in amounts], "d date, r int, a int")
    for undated_last in (True, False):
        got = df.withColumn("p", pack_pick(F.col("d"), F.col("r"), undated_last))
        assert got.filter(~(unpack_pick(F.col("p"), undated_last)[0].eqNullSafe(F.col("d")) & (unpack_pick(F.col("p"), undated_last)[1] == F.col("r")))).count() == 0
        order = [(r.d, r.r) for r in got.select("d", "r", "p").distinct().orderBy("p").collect()]
        assert order == sorted(order, key=lambda x: ((x[0] is None) == undated_last, x[0] or dt.date(1, 1, 1), x[1]))
    got = df.filter("d IS NOT NULL").withColumn("p", pack_last(F.col("d"), F.col("a")))
    assert got.filter(~(unpack_last(F.col("p"))[0].eqNullSafe(F.col("d")) & unpack_last(F.col("p"))[1].eqNullSafe(F.col("a")))).count() == 0
    order = [(r.d, r.a) for r in got.select("d", "a", "p").distinct().orderBy("p").collect()]
    assert order == sorted(order, key=lambda x: (x[0], x[1] is not None, x[1] or 0))


def test_outcomes_need_no_sort(views):
    found = outcome.add_outcome(views.patient, views.rare_observation, whole_study(views).outcome)
    assert "SortAggregate" not in plan(found)


def test_frames_compared_by_hash(spark):
    rows = spark.range(500).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'x' END AS a", "CASE WHEN id % 2 = 1 THEN 'x' END AS b").cache()
    assert sets.diff_frames_by_hash(rows, rows.repartition(3)).count() == 0
    one = rows.filter("id = 7")
    for other in (rows.unionByName(one), rows.exceptAll(one), rows.withColumns({"a": F.when(F.col("id") == 7, F.col("b")).otherwise(F.col("a")), "b": F.when(F.col("id") == 7, F.col("a")).otherwise(F.col("b"))})):
        want = sorted(map(str, sets.diff_frames(rows, other).collect()))
        assert want and sorted(map(str, sets.diff_frames_by_hash(rows, other).collect())) == want
    assert sets.diff_frames_by_hash(rows, rows.limit(0)).count() == 500


def test_sets_run_by_first_appearance(spark):
    day = [dt.date(2020, 1, k) for k in range(1, 6)]
    rows = [(1, day[2], "b"), (1, day[0], "c"), (1, day[2], "a"), (1, day[4], "c"), (1, None, "z"), (1, day[3], None), (2, day[0], None)]
    df = spark.createDataFrame(rows, "patid int, on date, v string")
    got = {(r.patid, r.on): list(r.seen) for r in events.running_sets(df, "on", "v").collect()}
    assert got == {(1, day[0]): ["c"], (1, day[2]): ["c", "a", "b"], (1, day[3]): ["c", "a", "b"], (1, day[4]): ["c", "a", "b"], (2, day[0]): []}
