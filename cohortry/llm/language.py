"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts become buckets of their letter bigrams and trigrams. Counts by language are summed on Spark; the
matrix of log probabilities (languages x buckets, so of fixed size) is broadcast, and numpy adds up the
rows of a batch's buckets, whole texts at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 15
SEGMENT = 1 << 20
UNDETERMINED = "und"
SMOOTHING = 0.5
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def codes(text: str) -> np.ndarray:
    """Lower-case code points, 0 for everything that is no letter, two zeros at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points) + 4, np.uint64)
    out[2:-2] = np.where(letters()[points], points, 0)
    return out


def buckets(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and start of every bigram and trigram with a letter in it."""
    first, second, third = points[:-2], points[1:-1], points[2:]
    pair = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = pair + third * np.uint64(0x165667B19E3779F9) + np.uint64(1)
    starts = np.arange(len(first))
    has_two = (first | second) != 0
    has_three = has_two | (third != 0)
    found = np.concatenate([pair[has_two], triple[has_three]])
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.concatenate([starts[has_two], starts[has_three]])


def bundles(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of all n-grams of a batch, a bounded number at a time; long texts come in segments
    that overlap by two code points, so no n-gram is lost or counted twice."""
    waiting, rows, size = [], [], 0
    for row, text in enumerate(texts):
        if not text:
            continue
        points = codes(text)
        for at in range(0, len(points) - 2, SEGMENT):
            piece = points[at : at + SEGMENT + 2]
            waiting.append(piece)
            rows.append(row)
            size += len(piece)
            if size >= SEGMENT:
                yield _bundle(waiting, rows)
                waiting, rows, size = [], [], 0
    if waiting:
        yield _bundle(waiting, rows)


def _bundle(pieces: list[np.ndarray], rows: list[int]) -> tuple[np.ndarray, np.ndarray]:
    out = [(b, np.full(len(b), r)) for p, r in zip(pieces, rows) if len(p) > 2 for b, _ in [buckets(p)]]
    return (np.concatenate([b for b, _ in out]), np.concatenate([r for _, r in out])) if out else (np.empty(0, np.int64), np.empty(0, np.int64))


def may_learn(doc_id: Column) -> Column:
    """Documents outside the held-out fold; a null id is never learned from."""
    return F.crc32(doc_id.cast("string")) % 4 != 2


def train(docs: DataFrame, rows_per_language: int = 5_000) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities (languages x (buckets + 1), the prior last).

    Learns from rows with a lang that ``may_learn`` admits; of a language with more of them, from a sample
    by a hash of the id that has ``rows_per_language`` rows on average. Priors count all admitted rows. What
    comes to the driver is bounded by languages x buckets.
    """
    admitted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(F.col("lang").isNotNull() & F.coalesce(may_learn(F.col("doc_id")), F.lit(False)))
    totals = {r["lang"]: r["n"] for r in admitted.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(totals)
    if not names:
        return [], np.zeros((0, (1 << BUCKET_BITS) + 1), np.float32)
    grain = 1 << 20
    share = F.create_map(*[F.lit(x) for name in names for x in (name, min(grain, int(rows_per_language / totals[name] * grain) + 1))])
    sample = admitted.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(names), 1 << BUCKET_BITS), np.int64)
        index = {n: k for k, n in enumerate(names)}
        for batch in batches:
            of = np.array([index[x] for x in batch.column("lang").to_pylist()], np.int64)
            for bucket, row in bundles(batch.column("text").to_pylist()):
                counts += np.bincount((of[row] << BUCKET_BITS) + bucket, minlength=counts.size).reshape(counts.shape)
        at = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], names=["cell", "n"])

    cells = sample.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(names) << BUCKET_BITS)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    counts = counts.reshape(len(names), -1) + SMOOTHING
    prior = np.array([totals[n] for n in names], float)
    logs = np.concatenate([np.log(counts / counts.sum(1, keepdims=True)), np.log(prior / prior.sum())[:, None]], 1)
    return names, logs.astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score: the likeliest language and its probability, from the text alone.

    A text that is null or has no letter, or a model without languages, gives ``und`` and 0.
    Ids are whole numbers, of any width.
    """
    names, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs.T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 1024):
                batch = whole_batch.slice(at, 1024)
                total = np.zeros((batch.num_rows, max(1, len(names))))
                seen = np.zeros(batch.num_rows, bool)
                if names:
                    for bucket, row in bundles(batch.column("text").to_pylist()):
                        if len(row):
                            starts = np.flatnonzero(np.diff(row, prepend=-1))
                            total[row[starts]] += np.add.reduceat(table[bucket], starts, axis=0, dtype=np.float64)
                            seen[row] = True
                    total += table[-1]
                best = total.argmax(1)
                score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                said = [names[b] if s else UNDETERMINED for b, s in zip(best, seen)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(said, pa.string()), pa.array(np.where(seen, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, rows_per_language: int = 5_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model learned from the rows not held out."""
    return predict(docs, train(docs, rows_per_language)).select("doc_id", F.coalesce(~may_learn(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
