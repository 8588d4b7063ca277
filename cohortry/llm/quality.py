"""Quality rules as weak supervision.

Each rule votes for (1) or against (-1) a document or abstains (0). Expectation-maximisation over the
counts of vote patterns estimates how often each rule is right and how common good documents are; a
document is kept when its posterior probability of being good is at least one half. Everything is a
DataFrame or SQL expression: the counts of a text are array functions inside its row, the patterns (at
most 3 to the number of rules) one small aggregate, and the estimation one fold over that aggregate. A
text of more than ``LONG_BYTES`` is cut into slices at word ends, and what its row would hold as arrays is
counted over rows of words and lines instead, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .common import WORD_GAP, WORD_SPACE, fresh, whole

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
# Texts up to so many bytes are counted inside their rows; slices of longer ones have so many characters.
LONG_BYTES, SLICE_CHARS = 1 << 20, 1 << 16
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Rule, vote for, vote against; neither: it abstains. {0} stands for the struct of counts.
RULES = (
    ("symbols", "100 * {0}.n_symbols <= 2 * {0}.n_words", "100 * {0}.n_symbols > 10 * {0}.n_words"),
    ("repeats", "100 * {0}.n_repeat_words <= 20 * {0}.n_words", "100 * {0}.n_repeat_words > 40 * {0}.n_words"),
    ("lines", "10 * {0}.n_dup_lines <= {0}.n_lines", "10 * {0}.n_dup_lines > 3 * {0}.n_lines"),
    ("word_length", "{0}.word_chars BETWEEN 3 * {0}.n_words AND 10 * {0}.n_words", "NOT {0}.word_chars BETWEEN 2 * {0}.n_words AND 15 * {0}.n_words"),
    ("capitals", "100 * {0}.n_upper <= 20 * ({0}.n_upper + {0}.n_lower)", "100 * {0}.n_upper > 50 * ({0}.n_upper + {0}.n_lower)"),
    ("marks", "100 * {0}.n_marks <= 10 * {0}.n_words", "100 * {0}.n_marks > 30 * {0}.n_words"),
    ("length", "{0}.n_words >= 100", "{0}.n_words < 20"),
)
# Start of the estimation, pseudo-counts (right, all) of each rule, and limits that keep it from collapsing.
START_PRIOR, START_ACCURACY, PSEUDO, ROUNDS = 0.8, 0.7, (7.0, 10.0), 12
PRIOR_RANGE, ACCURACY_RANGE = (0.05, 0.95), (0.55, 0.99)


def _number_of(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.expr("CAST(array() AS array<string>)")).otherwise(F.split(trimmed, WORD_GAP))


def _lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sums(text: Column) -> list[Column]:
    """The counts that can be added up over slices of a text."""
    return [
        F.length(F.translate(text, WORD_SPACE, "")).cast("long").alias("word_chars"),
        *[_number_of(text, letters).cast("long").alias(n) for n, letters in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_lower", UPPER.lower()), ("n_marks", "!?"))],
    ]


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_marks")


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the struct ``name`` of what the rules look at."""
    long_text = F.coalesce(F.octet_length("text") > LONG_BYTES, F.lit(False))
    row = fresh(docs, f"{name}_row")
    found = materialise(docs.filter(long_text).withColumn(row, F.monotonically_increasing_id()))
    short = _counts_in_row(docs.filter(~long_text), name)
    if found.isEmpty():
        return short
    counts = _counts_of_slices(found.select(F.col(row).alias("row"), "text")).select(F.col("row").alias(row), F.struct(*FIELDS).alias(name))
    return short.unionByName(found.join(counts, row).drop(row))


def _counts_of_slices(texts: DataFrame) -> DataFrame:
    """The counts of each row of ``texts`` (row, text): a row for every slice, window and line."""
    gap = r"\x20\x09-\x0D"
    # A slice ends where a word ends; the two words that follow come with it, for windows over its end.
    pattern = rf"(?s)(.{{1,{SLICE_CHARS}}}+[^{gap}]*+)(?=((?:[{gap}]*+[^{gap}]++){{0,2}}))"
    cut = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)).alias("own"), F.regexp_extract_all("text", F.lit(pattern), F.lit(2)).alias("next"))
    slices = texts.select("row", F.posexplode(cut).alias("k", "x")).select("row", "k", "x.own", "x.next")
    slices = materialise(slices.withColumn("n", F.size(_words(F.col("own"))).cast("long")))
    sums = slices.select("row", "n", *_sums(F.col("own"))).groupBy("row").agg(F.sum("n").alias("n_words"), *[F.sum(c).alias(c) for c in ("word_chars", "n_symbols", "n_upper", "n_lower", "n_marks")])
    before = F.coalesce(F.sum("n").over(Window.partitionBy("row").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = slices.select("row", "k", before.alias("start"))
    spelled = slices.join(starts, ["row", "k"]).select("row", "start", _words(F.concat("own", "next")).alias("w"))
    windows = F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
    places = spelled.filter(F.size("w") >= 3).select("row", "start", F.posexplode(windows).alias("i", "h")).select("row", "h", (F.col("start") + F.col("i")).alias("at"))
    twice = places.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("row", "h"))).filter("c > 1")
    step = F.lead("at").over(Window.partitionBy("row").orderBy("at")) - F.col("at")
    repeated = twice.select("row", F.least(F.lit(3).cast("long"), F.coalesce(step, F.lit(3).cast("long"))).alias("c")).groupBy("row").agg(F.sum("c").alias("n_repeat_words"))
    blocks = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{SLICE_CHARS}}}+[^\n]*+"), F.lit(0))
    # A block after the first begins with the line end that closed the one before.
    lines = texts.select("row", F.explode(blocks).alias("own")).select("row", F.explode(_lines(F.col("own"))).alias("line"))
    lines = lines.groupBy("row", "line").agg(F.count(F.lit(1)).alias("c")).groupBy("row").agg(F.sum("c").alias("n_lines"), F.sum(F.col("c") - 1).alias("n_dup_lines"))
    out = sums.join(repeated, "row", "left").join(lines, "row", "left")
    return out.select("row", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in FIELDS])


def _counts_in_row(docs: DataFrame, name: str) -> DataFrame:
    text, words, order, spots = (fresh(docs, f"{name}_{x}") for x in ("text", "words", "order", "spots"))
    df = docs.withColumn(text, whole())
    df = df.withColumn(words, _words(F.col(text)))
    w = F.col(words)
    # Windows of three words by hash and place, in the order of the hashes; equal ones are neighbours.
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    df = df.withColumn(order, F.when(F.size(w) >= 3, F.sort_array(windows)))
    o = F.col(order)
    twice = F.filter(o, lambda x, k: F.coalesce(F.get(o, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(o, k + 1)["h"] == x["h"], F.lit(False)))
    df = df.withColumn(spots, F.sort_array(F.transform(twice, lambda x: x["i"])))
    s = F.col(spots)
    covered = F.aggregate(F.transform(s, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - p, F.lit(3)))), F.lit(0), lambda a, b: a + b)
    line_list = fresh(docs, f"{name}_lines")
    df = df.withColumn(line_list, _lines(F.col(text)))
    counts = {
        "n_words": F.size(w), "n_dup_lines": F.size(line_list) - F.size(F.array_distinct(line_list)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)), "n_lines": F.size(line_list),
    }
    sums = dict(zip(("word_chars", "n_symbols", "n_upper", "n_lower", "n_marks"), _sums(F.col(text))))
    # One row from one row: behind a generator the struct is made once, however often it is looked at.
    return df.withColumn(name, F.explode(F.array(F.struct(*[(sums[c] if c in sums else counts[c].cast("long")).alias(c) for c in FIELDS])))).drop(text, words, order, spots, line_list)


def votes(counts: str) -> Column:
    """The array of votes from the struct of counts."""
    return F.array(*[F.expr(f"CASE WHEN {yes.format(counts)} THEN 1 WHEN {no.format(counts)} THEN -1 ELSE 0 END") for _, yes, no in RULES])


def base_failed(counts: str) -> Column:
    return F.expr(f"{counts}.n_words < {LEAST_WORDS} OR 100 * {counts}.n_repeat_words > 50 * {counts}.n_words")


def _clamp(value: Column, limits: tuple[float, float]) -> Column:
    return F.least(F.lit(limits[1]), F.greatest(F.lit(limits[0]), value))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _posterior(pattern: Column, model: Column) -> Column:
    weights = F.zip_with(pattern, model["accuracy"], lambda v, a: v * F.log(a / (1 - a)))
    return 1 / (1 + F.exp(-(F.log(model["prior"] / (1 - model["prior"])) + _total(weights))))


def fit(voted: DataFrame, column: str = "votes") -> DataFrame:
    """(votes, posterior) for every pattern of votes in ``voted``, estimated from all its rows."""
    patterns = voted.groupBy(F.col(column).alias("votes")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    listed = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))

    def improve(model: Column, _: Column) -> Column:
        scored = F.transform("patterns", lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), _posterior(p["votes"], model).alias("q")))

        def accuracy(j: Column) -> Column:
            vote = lambda p: F.get(p["votes"], j)
            right = _total(F.transform(scored, lambda p: p["n"] * F.when(vote(p) == 1, p["q"]).when(vote(p) == -1, 1 - p["q"]).otherwise(0.0)))
            voted_n = _total(F.transform(scored, lambda p: p["n"] * F.abs(vote(p))))
            return _clamp((right + PSEUDO[0]) / (voted_n + PSEUDO[1]), ACCURACY_RANGE)

        prior = _total(F.transform(scored, lambda p: p["n"] * p["q"])) / _total(F.transform(scored, lambda p: p["n"]))
        return F.struct(
            _clamp(prior, PRIOR_RANGE).alias("prior"),
            F.transform(F.sequence(F.lit(0), F.lit(len(RULES) - 1)), accuracy).alias("accuracy"),
        )

    start = F.struct(F.lit(START_PRIOR).alias("prior"), F.array(*[F.lit(START_ACCURACY)] * len(RULES)).alias("accuracy"))
    fitted = listed.filter(F.size("patterns") > 0).withColumn("model", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, improve))
    return fitted.select(F.explode("patterns").alias("p"), "model").select("p.votes", _posterior(F.col("p.votes"), F.col("model")).alias("posterior"))


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the five counts, base_failed, posterior, kept.

    A null or empty text has no words, so it fails the base and is not kept. Repeated rows are judged
    alike, each on its own. An empty table gives an empty result. Only doc_id and text are read.
    """
    counted = materialise(with_counts(docs.select("doc_id", "text"), "counts").select("doc_id", "counts", votes("counts").alias("votes")))
    return (
        counted.join(F.broadcast(fit(counted)), "votes")  # at most 3 ** len(RULES) patterns
        .select("doc_id", *[f"counts.{c}" for c in COUNTS], base_failed("counts").alias("base_failed"), "posterior")
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``judge`` rejects, same columns.

    Every text is counted once: rows are stored with their votes, and read again when the model is known.
    """
    counts, pattern, chance, failed = (fresh(docs, x) for x in ("counts", "pattern", "chance", "failed"))
    counted = with_counts(docs, counts).withColumns({pattern: votes(counts), failed: base_failed(counts)}).drop(counts)
    counted = materialise(counted)
    model = fit(counted.select(F.col(pattern).alias("votes")))
    judged = counted.filter(~F.col(failed)).join(F.broadcast(model.select(F.col("votes").alias(pattern), F.col("posterior").alias(chance))), pattern)
    return judged.filter(F.col(chance) >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def judge_sql() -> str:
    """``judge`` as DuckDB SQL, the rounds of the estimation spelled out."""
    rules = range(len(RULES))
    letters = lambda chars: f"length(t) - length(translate(t, '{chars}', ''))"
    parts = [
        "d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents)",
        r"w AS MATERIALIZED (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d)",
        "win AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w))",
        "twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1)",
        "spots AS (SELECT rid, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS v(o) GROUP BY rid)",
        f"""c AS MATERIALIZED (SELECT w.rid, doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
            {letters(SYMBOLS)} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(spots.n, 0) AS n_repeat_words, len(lines) AS n_lines,
            {letters("ABCDEFGHIJKLMNOPQRSTUVWXYZ")} AS n_upper, {letters("abcdefghijklmnopqrstuvwxyz")} AS n_lower, {letters("!?")} AS n_marks
            FROM w LEFT JOIN spots USING (rid))""",
        "v AS MATERIALIZED (SELECT c.*, " + ", ".join(f"CASE WHEN {yes.format('c')} THEN 1 WHEN {no.format('c')} THEN -1 ELSE 0 END AS v{j}" for j, (_, yes, no) in enumerate(RULES)) + " FROM c)",
        "pat AS MATERIALIZED (SELECT " + ", ".join(f"v{j}" for j in rules) + ", count(*)::DOUBLE AS n FROM v GROUP BY ALL)",
        f"par0 AS (SELECT {START_PRIOR}::DOUBLE AS prior, " + ", ".join(f"{START_ACCURACY}::DOUBLE AS a{j}" for j in rules) + ")",
    ]
    score = "1 / (1 + exp(-(ln(prior / (1 - prior)) + " + " + ".join(f"v{j} * ln(a{j} / (1 - a{j}))" for j in rules) + ")))"
    for k in range(1, ROUNDS + 1):
        right = [f"least({ACCURACY_RANGE[1]}, greatest({ACCURACY_RANGE[0]}, (sum(n * CASE v{j} WHEN 1 THEN q WHEN -1 THEN 1 - q ELSE 0 END) + {PSEUDO[0]}) / (sum(n * abs(v{j})) + {PSEUDO[1]}))) AS a{j}" for j in rules]
        parts.append(f"q{k} AS MATERIALIZED (SELECT pat.*, {score} AS q FROM pat, par{k - 1})")
        parts.append(f"par{k} AS MATERIALIZED (SELECT least({PRIOR_RANGE[1]}, greatest({PRIOR_RANGE[0]}, sum(n * q) / sum(n))) AS prior, {', '.join(right)} FROM q{k})")
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words"
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, {', '.join(COUNTS)}, {failed} AS base_failed, {score} AS posterior, "
        f"NOT ({failed}) AND {score} >= 0.5 AS kept FROM v, par{ROUNDS}"
    )
