"""Repeated passages by level-wise doubling.

A window of 13 words can only be repeated where its windows of 7 words are, two of which, sharing one
word, make it up. Level one therefore looks for repeated windows of 7, and of those in every window of 13
only at the one with the least hash, which equal windows of 13 have in common. Only windows of 13 around
a survivor are extended to, hashed in full and compared; with none surviving, nothing more is done.

Both levels deal rows out by hash. Copies that meet in one piece of input are settled there: a piece sends
one row for a hash on, so that no passage, however common, fills a task. Of documents with the same words only
the first has its windows judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .common import joined_words, whole

WINDOW = 13
# Bytes of text that a task takes at a time; texts are never cut.
PIECE = 4 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
# Two independent hashes: an odd base each, and the seed of the numbers that stand for bytes.
HASHES = ((0x9E3779B97F4A7C15, 11), (0xD6E8FEB86659FD93, 12))
WORD_BASES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2 ** 64."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())

        def run(b):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            return np.cumprod(steps)

        known = _POWERS[base] = run(base), run(pow(base, -1, 1 << 64))
    return known[0][:n], known[1][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of every values[start:end], the same wherever it stands."""
    power, inverse = _powers(base, len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[:-1])])
    return _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a piece's texts, one after the other: place in its row, and hashes."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts)
        self.bytes = np.frombuffer(joined, np.uint8)
        gap = np.ones(len(self.bytes) + 2, bool)
        gap[1:-1] = (self.bytes == 32) | ((self.bytes >= 9) & (self.bytes <= 13))
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        self.starts, self.ends = edge[::2], edge[1::2]
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1]
        self.row = np.searchsorted(begins, self.starts, "right") - 1
        self.n = np.bincount(self.row, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def hashes(self, which: int = 0) -> np.ndarray:
        base, seed = HASHES[which]
        letters = np.random.default_rng(seed).integers(0, 2**64, 256, np.uint64)
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):  # a piece of one long text is hashed in parts that end between words
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + PIECE, "right")))
            begin, end = self.starts[at], self.ends[to - 1]
            out[at:to] = _rolling(letters[self.bytes[begin:end]], self.starts[at:to] - begin, self.ends[at:to] - begin, base)
            at = to
        return out

    def windows(self, length: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window that lies within one text."""
        starts = np.arange(max(0, len(self.starts) - length + 1))
        starts = starts[self.row[starts] == self.row[starts + length - 1]] if len(starts) else starts
        return starts, _rolling(self.hashes(which), starts, starts + length, WORD_BASES[which])

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, least hash of the half windows in it) of every window."""
        half = (window + 1) // 2
        starts, hashes = self.windows(half)
        by_start = np.zeros(len(self.starts) + window, np.uint64)
        by_start[starts] = hashes
        full = np.arange(max(0, len(self.starts) - window + 1))
        full = full[self.row[full] == self.row[full + window - 1]] if len(full) else full
        least = by_start[full]
        for k in range(1, window - half + 1):
            least = np.minimum(least, by_start[full + k])
        return full, least


def _pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Whole rows, as many as make up a piece."""
    for batch in batches:
        sizes = np.array([0 if t is None else t for t in pc.binary_length(batch.column(batch.schema.get_field_index(text))).to_pylist()], np.int64)
        total, at = np.cumsum(sizes), 0
        while at < len(sizes):
            sofar = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, sofar + PIECE, "right")))
            yield batch.slice(at, to - at)
            at = to


def _texts(piece: pa.RecordBatch) -> list[bytes]:
    return piece.column(piece.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _send_anchors(window: int):
    """Rows (key, doc, hash): with hash 0 a question, dealt by the anchor's hash; else an anchor found
    twice in the piece, dealt anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            words = Words(_texts(piece))
            full, least = words.anchors(window)
            if not len(full):
                continue
            doc = piece.column("doc_id").to_numpy()[words.row[full]]
            new = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
            least, doc = least[new], doc[new]
            order = np.lexsort((doc, least))
            least, doc = least[order], doc[order]
            new = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
            least, doc = least[new], doc[new]
            head = np.concatenate([[True], least[1:] != least[:-1]])
            group = np.cumsum(head) - 1
            known = np.bincount(group)[group] > 1
            spread = _mix(least ^ doc.view(np.uint64))
            key = np.concatenate([least[head], spread[known]])
            said = np.concatenate([np.zeros(head.sum(), np.uint64), least[known]])
            yield pa.RecordBatch.from_arrays([_signed(key), pa.array(np.concatenate([doc[head], doc[known]])), _signed(said)], names=["key", "doc", "hash"])

    return run


def _answer_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, hash) of anchors that two documents have; rows come sorted by key, answers (hash not 0) apart."""
    last: np.ndarray | None = None
    last_out = True

    def batch_of(doc, found):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(found)], names=["doc", "hash"])

    for batch in batches:
        key, doc, said = (c.to_numpy() for c in batch.columns)
        known = said != 0
        if known.any():
            yield batch_of(doc[known], said[known])
        key, doc = key[~known], doc[~known]
        if not len(key):
            continue
        if last is not None:
            key, doc = np.concatenate([last[:1], key]), np.concatenate([last[1:], doc])
        same = key[1:] == key[:-1]
        out = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        fresh = out.copy()
        if last is not None and last_out:
            fresh[0] = False  # told with the batch before
        yield batch_of(doc[fresh], key[fresh])
        last, last_out = np.array([key[-1], doc[-1]]), bool(out[-1])


def _send_windows(window: int):
    """Rows (key, key2, doc, tag, at, n): n = 0 asks about the window at word ``at``; n > 0 are windows known
    to start in a smaller document of the same piece, as runs, dealt anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            words = Words(_texts(piece))
            full, least = words.anchors(window)
            lists = piece.column("anchors").combine_chunks() if isinstance(piece.column("anchors"), pa.ChunkedArray) else piece.column("anchors")
            chosen = np.flatnonzero(np.isin(least.view(np.int64), lists.flatten().to_numpy()))
            if not len(chosen):
                continue
            doc, tag = (piece.column(c).to_numpy() for c in ("doc_id", "tag"))
            one = words.windows(window)[1][chosen]
            two = (words.windows(window, 1)[1][chosen] >> np.uint64(32)).astype(np.int64)
            row = words.row[full[chosen]]
            at = full[chosen] - words.first[row]
            order = np.lexsort((doc[row], two, one))
            s1, s2, sd = one[order], two[order], doc[row][order]
            head = np.concatenate([[True], (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])])
            least_doc = sd[head][np.cumsum(head) - 1]
            later = np.empty(len(order), bool)
            later[order] = sd > least_doc
            ask = ~later
            yield _window_rows(one[ask].view(np.int64), two[ask], doc[row[ask]], tag[row[ask]], at[ask], np.zeros(ask.sum(), np.int64))
            if later.any():
                # Windows came in order of row and place: neighbours make up runs.
                r, a = row[later], at[later]
                start = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (a[1:] != a[:-1] + 1)]))
                sizes = np.diff(np.concatenate([start, [len(r)]]))
                r, a = r[start], a[start]
                spread = _mix(doc[r].view(np.uint64) ^ a.astype(np.uint64)).view(np.int64)
                yield _window_rows(spread, np.zeros(len(r), np.int64), doc[r], tag[r], a, sizes)

    return run


def _window_rows(key, key2, doc, tag, at, n) -> pa.RecordBatch:
    columns = [pa.array(key), pa.array(key2), pa.array(doc), *[pa.array(np.asarray(x).astype(np.int32)) for x in (tag, at, n)]]
    return pa.RecordBatch.from_arrays(columns, names=["key", "key2", "doc", "tag", "at", "n"])


def _answer_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs (doc, tag, at, n) of windows that start in a smaller document; rows sorted by keys and doc."""
    last: tuple[int, int, int] | None = None  # keys and least document of the group that may go on
    for batch in batches:
        key, key2, doc, tag, at, n = (c.to_numpy() for c in batch.columns)
        asked = n == 0
        out = ~asked
        if asked.any():
            k1, k2, d = key[asked], key2[asked], doc[asked]
            head = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            least = d[head]
            if last is not None and (k1[0], k2[0]) == last[:2]:
                least[0] = last[2]
            group = np.cumsum(head) - 1
            out[np.flatnonzero(asked)[d > least[group]]] = True
            last = k1[-1], k2[-1], least[-1]
        yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(tag[out]), pa.array(at[out]), pa.array(np.maximum(n[out], 1))], names=["doc", "tag", "at", "n"])


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, runs in zip(_texts(batch), batch.column("runs").to_pylist()):
                words = text.split()
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    change[r["at"]] += 1
                    change[r["at"] + r["n"] + window - 1] -= 1
                gone = np.cumsum(change[:-1]) > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "tag", "n_removed", "kept"]
            )

    return run


def repeated_windows(docs: DataFrame, leaders: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs (doc, tag, at, n): the n windows from word ``at`` on also start in a document with a smaller id.

    ``docs`` has doc_id (not null), text (not null) and tag, which tells texts of one id apart. Only windows
    of ``leaders`` (doc_id, tag) are judged; of documents with equal words the one with the least id must be
    among them, as the others' windows then add nothing.
    """
    sent = docs.select("doc_id", "text").mapInArrow(_send_anchors(window), "key long, doc long, hash long")
    found = sent.repartition("key").sortWithinPartitions("key").mapInArrow(_answer_anchors, "doc long, hash long")
    lists = found.groupBy("doc").agg(F.collect_set("hash").alias("anchors")).withColumnRenamed("doc", "doc_id")
    longer = docs.join(lists.join(leaders, "doc_id"), ["doc_id", "tag"]).select("doc_id", "text", "tag", "anchors")
    asked = longer.mapInArrow(_send_windows(window), "key long, key2 long, doc long, tag int, at int, n int")
    # Known runs have their own keys; what is asked about one window meets in one partition.
    return asked.repartition("key").sortWithinPartitions("key", "key2", "doc").mapInArrow(_answer_windows, "doc long, tag int, at int, n int")


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, one space between).

    Each word is removed that a window of ``window`` words covers which also starts in a document with a
    smaller doc_id, judged on the input. A null text has no words. A null doc_id is neither smaller nor
    larger than any: its text stays whole and cuts no other. Rows that share a doc_id don't cut each other;
    rows equal in id and text are cut alike. An empty table gives no rows. Only doc_id and text are read;
    ids are whole numbers, of any width.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    base = base.withColumn("tag", (F.xxhash64("text").bitwiseAND(F.lit(0x3FFFFFFF))).cast("int"))
    words = joined_words(F.col("text"))
    count = F.when(words == "", 0).otherwise(F.length(words) - F.length(F.translate(words, " ", "")) + 1)
    plain = materialise(base.select("doc_id", "tag", count.cast("long").alias("n_words"), F.unhex(F.sha2(words, 256)).alias("sha")))
    # Of documents with the same words, those after the first are covered by it as a whole.
    first = plain.filter("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("first_id"))
    plain = plain.join(first, "sha", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)))
    leaders = plain.filter("doc_id IS NOT NULL AND NOT copy").select("doc_id", "tag").distinct()
    sound = base.filter("doc_id IS NOT NULL")
    # Both joins with the texts deal them out alike, so that they are sent once.
    runs = repeated_windows(sound, leaders, window).groupBy(F.col("doc").alias("doc_id"), "tag").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    cut = sound.join(runs, ["doc_id", "tag"]).select("doc_id", "text", "tag", "runs").mapInArrow(_cut(window), "doc_id long, tag int, n_removed long, kept binary")
    cut = cut.groupBy("doc_id", "tag").agg(F.first("n_removed").alias("n_removed"), F.first(F.sha2("kept", 256)).alias("cut_sha256"))
    gone = F.col("copy") & (F.col("n_words") >= window)
    return plain.join(cut, ["doc_id", "tag"], "left").select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )
