"""Phrase collocation mining with counting quotient filters.

Texts become shards of word numbers. The n-grams of a shard are packed word numbers, permuted by a Feistel
network, so that nothing is lost: the leading bits of the permuted number are the quotient, all others the
remainder. A shard's counts are a filter: the lengths of the runs of each quotient, the remainders in
order and a counter each. Filters are cut by the first bits of the quotient, and the parts of all shards
are merged, sorted as they are, into the exact counts of the corpus.

Phrases grow level by level: an n-gram can be frequent only if both (n-1)-grams in it are, so the merge
sends back to each shard which of its n-grams are frequent, and only those grow at the next level.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.tables import materialise
from .common import ranked

LEAST, LONGEST, TOP, COVERED, NO_LANG = 30, 4, 2000, 80, "und"
# Sizes of work at a time; results do not depend on them.
SHARD_WORDS, OPEN_WORDS, PART_ENTRIES, SHARDS_A_FILE, SALT = 1 << 20, 1 << 22, 1 << 22, 8, 64
# The end of a piece; a full stop is no part of any word.
STOP = b"."
_PIECES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + STOP * 10)
U64 = np.uint64


# Packed word numbers and their permutation. A key is two halves of ``half`` bits.


def half_bits(n: int, bits: int) -> int:
    """Bits of half a key of ``n`` words; ``bits``, even, are those of a word."""
    return n * bits // 2


def pack(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The halves of each row of word numbers."""
    n = words.shape[1]
    w, b, mid = words.astype(U64).T, U64(bits), U64(bits // 2)
    if n == 2:
        return w[0].copy(), w[1].copy()
    if n == 3:
        return (w[0] << mid) | (w[1] >> mid), ((w[1] & ((U64(1) << mid) - U64(1))) << b) | w[2]
    return (w[0] << b) | w[1], (w[2] << b) | w[3]


def unpack(hi: np.ndarray, lo: np.ndarray, n: int, bits: int) -> np.ndarray:
    b, mid, mask = U64(bits), U64(bits // 2), U64((1 << bits) - 1)
    if n == 2:
        columns = [hi, lo]
    elif n == 3:
        columns = [hi >> mid, ((hi << mid) | (lo >> b)) & mask, lo & mask]
    else:
        columns = [hi >> b, hi & mask, lo >> b, lo & mask]
    return np.stack(columns, 1).astype(np.int64)


def _mixed(x: np.ndarray, turn: int, half: int) -> np.ndarray:
    x = (x + U64(turn)) * U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(29)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(32)
    return x & U64((1 << half) - 1)


def permute(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for turn in range(1, 5):
        hi, lo = lo, hi ^ _mixed(lo, turn, half)
    return hi, lo


def restore(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for turn in range(4, 0, -1):
        hi, lo = lo ^ _mixed(hi, turn, half), hi
    return hi, lo


def _sorted(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of keys, and where in it a new key begins."""
    if 2 * half <= 64:
        key = (hi << U64(half)) | lo
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    else:
        order = np.lexsort((lo, hi))
        h, l = hi[order], lo[order]
        head = np.concatenate([[True], (h[1:] != h[:-1]) | (l[1:] != l[:-1])]) if len(h) else np.zeros(0, bool)
    return order, head


def summed(hi: np.ndarray, lo: np.ndarray, n: np.ndarray | None, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    order, head = _sorted(hi, lo, half)
    at = np.flatnonzero(head)
    if n is None:
        totals = np.diff(np.append(at, len(order)))
    else:
        totals = np.add.reduceat(n[order], at) if len(at) else n[:0]
    first = order[at]
    return hi[first], lo[first], totals.astype(np.int64)


def member(hi: np.ndarray, lo: np.ndarray, known_hi: np.ndarray, known_lo: np.ndarray, half: int) -> np.ndarray:
    """Which keys are among the known ones."""
    order, head = _sorted(np.concatenate([known_hi, hi]), np.concatenate([known_lo, lo]), half)
    out = np.zeros(len(order), bool)
    if len(order):
        group = np.cumsum(head) - 1
        out[order] = np.logical_or.reduceat(order < len(known_hi), np.flatnonzero(head))[group]
    return out[len(known_hi):]


# Counting quotient filters as bytes.


def _narrow(values: np.ndarray, bits: int) -> bytes:
    """The lower ``bits`` of each number, in whole bytes."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)]).tobytes()


def _widen(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.view("<u8").reshape(n).astype(U64), n * width


def store_filter(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, half: int, part_bits: int = 0, part: int = 0) -> bytes:
    """Sorted, distinct permuted keys of one part and their counts as a counting quotient filter.

    The quotient has about as many values as there are keys. Counts of 255 and more follow in full.
    """
    q = min(half, part_bits + max(0, len(hi).bit_length() - 1))
    bucket = (hi >> U64(half - q)).astype(np.int64) - (part << (q - part_bits))
    runs = np.bincount(bucket, minlength=1 << (q - part_bits))
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if runs.max(initial=0) <= np.iinfo(k).max)
    large = n >= 255
    head = np.array([half, q, part_bits, part, len(hi), np.dtype(kind).itemsize, large.sum()], "<i8")
    rest = hi & U64((1 << (half - q)) - 1)
    return b"".join([
        head.tobytes(), runs.astype(kind).tobytes(), _narrow(rest, half - q), _narrow(lo, half),
        np.where(large, 255, n).astype("<u1").tobytes(), n[large].astype("<i8").tobytes(),
    ])


def load_filter(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys, in order, and counts of a stored filter."""
    half, q, part_bits, part, m, width, n_large = np.frombuffer(data, "<i8", 7).tolist()
    view, at = memoryview(data), 56
    runs = np.frombuffer(view[at:], f"<u{width}", 1 << (q - part_bits)).astype(np.int64)
    at += len(runs) * width
    rest, used = _widen(view[at:], m, half - q)
    at += used
    lo, used = _widen(view[at:], m, half)
    at += used
    n = np.frombuffer(view[at:], "<u1", m).astype(np.int64)
    n[n == 255] = np.frombuffer(view[at + m:], "<i8", n_large)
    quotient = np.repeat(np.arange(len(runs)) + (part << (q - part_bits)), runs).astype(U64)
    return ((quotient << U64(half - q)) | rest if half - q < 64 else rest), lo, n


def _load_all(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [load_filter(f) for f in filters] or [(np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64))]
    return tuple(np.concatenate(x) for x in zip(*parts))


# Shards of texts.


def _store_numbers(values: np.ndarray) -> bytes:
    """32-bit numbers byte by byte: all lowest bytes, then all next ones; high ones compress to nothing."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _load_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts of one language, up to about SHARD_WORDS words: words, their counts, and the texts as
    numbers of these words from 1, with 0 at the end of each piece. All shards of a task are closed when
    they hold OPEN_WORDS, however many languages there are."""
    base, number = TaskContext.get().partitionId() << 32, count()
    open_: dict[str, list] = {}

    def closed(lang: str) -> pa.RecordBatch | None:
        vocabulary, parts, _ = open_.pop(lang)
        ids = np.concatenate(parts)
        n = np.bincount(ids, minlength=len(vocabulary))
        if n[1:].sum() == 0:
            return None
        words = [w.decode() for w in vocabulary]
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([lang]), "shard": pa.array([base + next(number)], pa.int64()), "n": pa.array([int(n[1:].sum())], pa.int64()),
            "words": pa.array([words[1:]], pa.list_(pa.string())), "counts": pa.array([n[1:]], pa.list_(pa.int64())), "ids": pa.array([_store_numbers(ids)], pa.binary()),
        })

    held = 0
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for k, text in enumerate(batch.column("text")):
            found = text.as_py().translate(_PIECES).replace(STOP, b" . ").split()
            if not found:
                continue
            if langs[k] not in open_:
                vocabulary = defaultdict(count().__next__)
                vocabulary[STOP]
                open_[langs[k]] = [vocabulary, [], 0]
            vocabulary, parts, own = open_[langs[k]]
            parts += [np.fromiter(map(vocabulary.__getitem__, found), np.uint32, len(found)), np.zeros(1, np.uint32)]
            open_[langs[k]][2] = own + len(found)
            held += len(found)
            full = list(open_) if held >= OPEN_WORDS else [langs[k]] if own + len(found) >= SHARD_WORDS else []
            for lang in full:
                held -= open_[lang][2]
                if (row := closed(lang)) is not None:
                    yield row
    for lang in list(open_):
        if (row := closed(lang)) is not None:
            yield row


def _grow(n: int, bits: int, last: bool):
    """A level on one shard: its tokens, and a filter of its n-grams for each part."""
    schema = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("part", pa.int64()), ("data", pa.binary())])

    def starts(tokens: np.ndarray, size: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(allowed)
        return at, tokens[at[:, None] + np.arange(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in _rows(batch)):
            tokens = _load_numbers(row["ids"])
            if n == 2:
                known = np.zeros(max(int(tokens.max(initial=0)), 1) + 1, np.int64)
                known[row["local"]] = row["word_id"]
                tokens = known[tokens]
            if len(tokens) < n:
                continue
            ok = tokens > 0
            for _ in range(1, n - 1):
                ok = ok[:-1] & (tokens[len(tokens) - len(ok) + 1 :] > 0)
            if n > 2:  # (n-1)-grams that the merge found frequent
                at, grams = starts(tokens, n - 1, ok)
                half = half_bits(n - 1, bits)
                known_hi, known_lo, _ = _load_all(row["kept"])
                ok[at] = member(*permute(*pack(grams, bits), half), known_hi, known_lo, half)
            ok = ok[:-1] & ok[1:]
            at, grams = starts(tokens, n, ok)
            if not len(at):
                continue
            half, p = half_bits(n, bits), min(int(row["part_bits"]), half_bits(n, bits))
            hi, lo, counts = summed(*permute(*pack(grams, bits), half), None, half)
            part = (hi >> U64(half - p)).astype(np.int64) if p else np.zeros(len(hi), np.int64)
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            parts, data = [], []
            for a, b in zip(edges, edges[1:]):
                parts.append(int(part[a]))
                data.append(store_filter(hi[a:b], lo[a:b], counts[a:b], half, p, int(part[a])))
            if not last:
                held = np.zeros(len(tokens) + 1, np.int64)
                np.add.at(held, at, 1)
                np.add.at(held, at + n, -1)
                tokens = np.where(np.cumsum(held)[:-1] > 0, tokens, 0)
                tokens = tokens[(tokens > 0) | np.concatenate([[True], tokens[:-1] > 0])]
                parts.append(-1)
                data.append(_store_numbers(tokens))
            yield pa.RecordBatch.from_arrays([
                pa.array([row["lang"]] * len(parts), pa.string()), pa.array([row["shard"]] * len(parts), pa.int64()), pa.array(parts, pa.int64()), pa.array(data, pa.binary()),
            ], schema=schema)

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        out = {}
        for name in batch.schema.names:
            cell = batch.column(name)[k]
            out[name] = cell.values.to_numpy(zero_copy_only=False) if name in ("local", "word_id") else cell.as_py()
        yield out


def _merge(n: int, bits: int, least: int, last: bool):
    """The filters of one part from all shards as one, cut to the frequent; and what of it each shard has."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, part = key[0].as_py(), key[1].as_py()
        filters = [load_filter(x) for x in table["data"].to_pylist()]
        half, _, part_bits = np.frombuffer(table["data"][0].as_py(), "<i8", 3).tolist()
        hi, lo, counts = (np.concatenate(x) for x in zip(*filters))
        order, head = _sorted(hi, lo, half)
        at = np.flatnonzero(head)
        totals = np.add.reduceat(counts[order], at)
        often = totals >= least
        first = order[at[often]]
        shards, data = [], []
        if len(first):
            shards.append(-1)
            data.append(store_filter(hi[first], lo[first], totals[often], half, part_bits, part))
        if not last and len(first):
            stays = np.zeros(len(order), bool)
            stays[order] = often[np.cumsum(head) - 1]
            ends = np.cumsum([len(f[0]) for f in filters])
            for shard, (a, b, c), own in zip(table["shard"].to_pylist(), filters, np.split(stays, ends[:-1])):
                if own.any():
                    shards.append(shard)
                    data.append(store_filter(a[own], b[own], c[own], half, part_bits, part))
        m = len(shards)
        return pa.table({"lang": pa.array([lang] * m, pa.string()), "shard": pa.array(shards, pa.int64()), "data": pa.array(data, pa.binary())})

    return run


def _decode(n: int, bits: int):
    half = half_bits(n, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data").to_pylist()):
                hi, lo, counts = load_filter(data)
                words = unpack(*restore(hi, lo, half), n, bits)
                offsets = np.arange(0, len(words) * n + 1, n, dtype=np.int32)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(words), pa.string()), "f": pa.array(counts, pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.ravel(), pa.int64())),
                })

    return run


def _stored(df: DataFrame) -> DataFrame:
    """``df``, whose rows are large, stored with a few rows a file, as files are read by thousands of rows."""
    path = shared_dir(df.sparkSession)
    df.write.option("maxRecordsPerFile", SHARDS_A_FILE).parquet(path)
    return df.sparkSession.read.parquet(path)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of every phrase of 1 to 4 words found ``least`` times or more, and (lang, n) of all words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    shards = _stored(texts.mapInArrow(_shards, "lang string, shard long, n long, words array<string>, counts array<long>, ids binary"))
    totals = materialise(shards.groupBy("lang").agg(F.sum("n").alias("n")))
    seen = shards.select("lang", "shard", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "x")).select("lang", "shard", (F.col("local") + 1).alias("local"), "x.words", "x.counts")
    often = materialise(seen.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")).filter(F.col("f") >= least).withColumn("one", F.lit(1)))
    words = materialise(ranked(often, "one", ["lang", "word"], "place", "of").select("lang", "word", "f", (F.col("place") + 1).alias("id")))
    largest = words.agg(F.max("id")).first()[0] or 0
    bits = max(2, largest.bit_length() + largest.bit_length() % 2)
    if bits > 32:
        raise OverflowError("more frequent words than 32 bits can number")
    part_bits = totals.select("lang", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / PART_ENTRIES))).alias("part_bits"))
    own = seen.join(words.select("lang", F.col("word").alias("words"), "id"), ["lang", "words"]).groupBy("shard").agg(F.collect_list(F.struct("local", "id")).alias("x"))
    level = shards.select("lang", "shard", "ids").join(own.select("shard", F.col("x.local").alias("local"), F.col("x.id").alias("word_id")), "shard")
    phrases = words.select("lang", F.array("word").alias("words"), "f")
    for n in range(2, LONGEST + 1):
        last = n == LONGEST
        out = level.join(part_bits, "lang").mapInArrow(_grow(n, bits, last), "lang string, shard long, part long, data binary")
        grown = _stored(out)
        merged = grown.filter("part >= 0").groupBy("lang", "part").applyInArrow(_merge(n, bits, least, last), "lang string, shard long, data binary")
        merged = _stored(merged)
        grams = materialise(merged.filter("shard < 0").select("lang", "data").mapInArrow(_decode(n, bits), "lang string, f long, ids array<long>").withColumn("gram", F.monotonically_increasing_id()))
        spelled = grams.select("gram", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
        spelled = spelled.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("x"))
        phrases = phrases.unionByName(grams.join(spelled, "gram").select("lang", F.col("x.word").alias("words"), "f"))
        kept = merged.filter("shard >= 0").groupBy("shard").agg(F.collect_list("data").alias("kept"))
        level = grown.filter("part < 0").select("lang", "shard", F.col("data").alias("ids")).join(kept, "shard")
    return materialise(phrases), totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the first ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends; a phrase lies within one
    piece. Candidates have 2 to 4 words and a >= ``least`` occurrences, overlapping ones included. The
    score is that of the lowest-scoring cut into two parts with l and r occurrences, floor(2,000,000 a /
    (l + r)), ties to the shorter first part. Candidates that stand inside a longer one with 80 % of their
    occurrences or more are dropped. Order: score and a descending, phrase by its bytes. Counts are exact.

    A null text has no words, a null lang is ``und`` and one with a language of that name. Repeated rows
    count again. An empty table gives no rows. Only lang and text are read.
    """
    phrases, totals = frequent_phrases(docs, least)
    phrases = phrases.select("lang", "words", "f", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size"))
    counts = phrases.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("f").alias("count"))
    candidates = phrases.filter("size > 1")

    def looked_up(rows: DataFrame, part: str, name: str) -> DataFrame:
        return rows.join(counts.withColumnRenamed("count", name), (F.col("lang") == F.col("of")) & (F.col(part) == F.col("part"))).drop("of", "part")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"first": F.array_join(F.expr("slice(words, 1, k)"), " "), "rest": F.array_join(F.expr("slice(words, k + 1, size - k)"), " ")})
    cuts = looked_up(looked_up(cuts.select("lang", "phrase", "f", "k", "first", "rest"), "first", "l"), "rest", "r")
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(18,0)) * CAST(f AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    scored = cuts.groupBy("lang", "phrase").agg(F.max("f").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = candidates.filter("size > 2").select("lang", "f", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("len"))
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, size - len + 1)"))).select("lang", "f", F.array_join(F.expr("slice(words, at, len)"), " ").alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    covered = F.expr(f"CAST(100 AS DECIMAL(18,0)) * CAST(longer AS DECIMAL(19,0)) >= CAST({COVERED} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(19,0))")
    left = scored.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    left = left.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    # A language's candidates are cut down in salted groups before they meet in one.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order)
    few = left.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    placed = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return placed.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, top: int = TOP) -> str:
    """``collocations`` as DuckDB SQL."""
    phrase = lambda a, n: "list_aggregate(list_slice(w, {0}, {0} + {1} - 1), 'string_agg', ' ')".format(a, n)
    return rf"""
WITH p AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
t AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM t GROUP BY lang HAVING sum(len(w)) > 0),
g AS (SELECT lang, {phrase("i", "m")} AS phrase, m FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM t, (VALUES (1), (2), (3), (4)) AS s(m))),
f AS MATERIALIZED (SELECT lang, phrase, m, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {least}),
c AS MATERIALIZED (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cut AS (
  SELECT c.lang, c.phrase, c.a, c.m, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c JOIN f x ON x.lang = c.lang AND x.phrase = {phrase("1", "k").replace("w,", "c.w,")} JOIN f y ON y.lang = c.lang AND y.phrase = {phrase("k + 1", "c.m - k").replace("w,", "c.w,")}
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, {phrase("i", "s")} AS phrase, max(a) AS longer FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM c, (VALUES (2), (3)) AS v(s) WHERE s < m) GROUP BY ALL),
kept AS (SELECT cut.* FROM cut LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < {COVERED} * a::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= {top}"""
