"""Near duplicates by SimHash fingerprints and a self-join of binary tries.

Fingerprints that differ in at most four of 64 bits agree on one of five blocks of bits, so distinct
fingerprints are dealt out by block and its value. Within a bucket the sorted fingerprints are a binary
trie: a node is a range, its halves are the ranges with the next bit 0 and 1. Pairs of nodes are
traversed together, level by level, adding up the bits in which they differ, and a pair is pruned as soon
as the budget is exceeded. Of what is linked only a spanning star leaves the task; components of all
fingerprints come from alternating star steps on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .common import first_rows, fresh

WORDS, BITS, BUDGET, SEED = 4, 64, 4, 42
BLOCKS = tuple((start, min(start + 13, BITS)) for start in range(0, BITS, 13))
# Sizes of work at a time; results do not depend on them.
SHINGLES, GROUP_ROWS, CHUNK_ROWS, FRONTIER, SMALL_PAIR = 1 << 18, 50_000, 100_000, 250_000, 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The bits that are set in over half the hashes of a text's shingles; 0 for a text without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    take = min(words, len(found))
    first, last = starts[: len(found) - take + 1], ends[take - 1 :] - 1
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_digest
    for at in range(0, len(first), SHINGLES):
        pairs = zip(first[at : at + SHINGLES].tolist(), last[at : at + SHINGLES].tolist())
        hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in pairs]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (as a signed 64-bit number) and text_hash, which tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found), part.column("text_hash")], names=["doc_id", "fp", "text_hash"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, "doc_id long, fp long, text_hash long")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return shift + np.arange(len(shift))


def linked(fps: np.ndarray, roots: np.ndarray, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``fps`` within the budget. ``roots``: rows (a from, a to, b from, b to) of pairs of
    sorted ranges, a range with itself meaning its own pairs."""
    stack = [(BITS - 1, np.column_stack([roots, np.zeros(len(roots), np.int64)]))]
    while stack:
        bit, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            stack += [(bit, pairs[k : k + FRONTIER]) for k in range(0, len(pairs), FRONTIER)]
            continue
        a_size, b_size = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        small = (a_size * b_size <= SMALL_PAIR) | (bit < 0)
        if small.any():
            yield from _compare(fps, pairs[small], budget)
        pairs = pairs[~small]
        if not len(pairs):
            continue
        before = np.concatenate([[0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        a0, a1, b0, b1, differ = pairs.T
        a_mid, b_mid = a1 - (before[a1] - before[a0]), b1 - (before[b1] - before[b0])
        own = (a0 == b0) & (a1 == b1)
        halves = [
            np.column_stack([a0, a_mid, b0, b_mid, differ]), np.column_stack([a_mid, a1, b_mid, b1, differ]),
            np.column_stack([a0, a_mid, b_mid, b1, differ + 1]), np.column_stack([a_mid, a1, b0, b_mid, differ + 1])[~own],
        ]
        below = np.concatenate(halves)
        below = below[(below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3]) & (below[:, 4] <= budget)]
        stack.append((bit - 1, below))


def _compare(fps: np.ndarray, pairs: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The last few leaves of node pairs, each with each."""
    sizes = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
    left = _ranges(pairs[:, 0], sizes[0])
    own = np.repeat(np.arange(len(pairs)), sizes[0])
    right = _ranges(pairs[own, 2], sizes[1][own])
    left = np.repeat(left, sizes[1][own])
    near = (left != right) & (np.bitwise_count(fps[left] ^ fps[right]) <= budget)
    if near.any():
        yield left[near], right[near]


def _unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Lower the labels of linked rows to the least of their component."""
    while True:
        a, b = label[left], label[right]
        if (a == b).all():
            return
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label != label[label]).any():
            label[:] = label[label]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) that span the links of whole groups; rows come sorted by group, side and fp."""

    def solve(rows: np.ndarray) -> pa.RecordBatch | None:
        fps = rows[:, 4].view(np.uint64)
        heads = np.flatnonzero(np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(1)]))
        ends = np.concatenate([heads[1:], [len(rows)]])
        both = rows[heads, 1] != rows[heads, 2]
        # In a group of two parts of a bucket, the second begins where the side changes.
        turn = np.concatenate([[0], np.cumsum(rows[:, 3] != rows[:, 1])])
        middle = np.where(both, ends - (turn[ends] - turn[heads]), heads)
        roots = np.column_stack([heads, np.where(both, middle, ends), middle, ends])
        label = np.arange(len(rows))
        for left, right in linked(fps, roots[(roots[:, 0] < roots[:, 1]) & (roots[:, 2] < roots[:, 3])]):
            _unite(label, left, right)
        moved = np.flatnonzero(label != np.arange(len(rows)))
        if not len(moved):
            return None
        signed = rows[:, 4]
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], names=["a", "b"])

    waiting: list[np.ndarray] = []
    for batch in batches:
        waiting.append(np.column_stack([c.to_numpy() for c in batch.columns]))
        if sum(map(len, waiting)) < CHUNK_ROWS:
            continue
        rows = np.concatenate(waiting)
        whole = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1))
        if not len(whole):
            waiting = [rows]
            continue
        waiting = [rows[whole[-1] + 1 :]]
        if (found := solve(rows[: whole[-1] + 1])) is not None:
            yield found
    if waiting and len(rows := np.concatenate(waiting)) and (found := solve(rows)) is not None:
        yield found


def near_edges(distinct: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of all links between the rows of ``distinct`` (fp).

    A bucket of more than ``group_rows`` fingerprints is dealt into parts by a hash, and each pair of
    parts is a group of its own, so no group grows with the data.
    """
    blocks = F.array(*[
        F.struct((F.lit(k << 16) + F.expr(f"shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}")).cast("long").alias("bucket"))
        for k, (a, b) in enumerate(BLOCKS)
    ])
    dealt = distinct.select("fp", F.explode(blocks).alias("x")).select("fp", "x.bucket")
    sizes = dealt.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("long").alias("parts")).filter("parts > 1")
    parted = dealt.join(sizes, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    parted = parted.withColumn("side", F.pmod(F.xxhash64("fp"), "parts")).withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    groups = parted.select("bucket", F.least("side", "other").alias("first"), F.greatest("side", "other").alias("second"), "side", "fp")
    order = ["bucket", "first", "second"]
    # The order of fp as an unsigned number, so that its ranges are nodes of the trie.
    sorted_groups = groups.repartition(*order).sortWithinPartitions(*order, "side", F.expr("fp < 0"), "fp")
    return sorted_groups.mapInArrow(_stars, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least number in its component.

    Alternating large-star and small-star steps; each step's edges are stored in the shared folder.
    """
    edges = materialise(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a <> b").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        large = both.join(least, "a").filter("b > a").selectExpr("b AS a", "m AS b").filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").selectExpr("inline(array(struct(b AS a, m AS b), struct(a, m AS b)))").filter("a <> b").distinct()
        edges = materialise(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.selectExpr("a AS node", "b AS root")
        state = now


def near_groups(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, component_id, keeper (doc_id, text_hash).

    ``component_id`` is the smallest doc_id of those reachable over links of fingerprints, the row's own
    included; null ids come after all others. Null, empty and wordless texts have fingerprint 0 and are
    linked like any other. Repeated rows and equal fingerprints are one node. An empty table gives no
    rows. Only doc_id and text are read; ids are whole numbers, of any width.
    """
    marked = materialise(fingerprints(docs))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = materialise(marked.groupBy("fp").agg(F.min(rank).alias("first")))
    stars = components(near_edges(distinct.select("fp"), group_rows))
    rooted = distinct.join(stars, distinct["fp"] == stars["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    keepers = rooted.groupBy("root").agg(F.min("first").alias("keeper"))
    of_fp = rooted.select("fp", "root").join(keepers, "root").select("fp", "keeper")
    return marked.join(of_fp, "fp").select("doc_id", "text_hash", "fp", F.col("keeper.doc_id").alias("component_id"), "keeper")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id; same columns.

    Of rows with that doc_id the one with the smallest 64-bit hash of its text stays, and of rows equal in
    both the one whose columns come first, compared in turn.
    """
    key, hashed = fresh(docs, "near_key"), fresh(docs, "near_hash")
    id_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    kept = near_groups(docs).select("keeper.doc_id", "keeper.text_hash").distinct().select(F.coalesce("doc_id", F.lit(-(2**63))).alias(key), F.col("text_hash").alias(hashed))
    marked = docs.withColumns({key: id_key, hashed: F.xxhash64("text")})
    return first_rows(marked.join(kept, [key, hashed], "left_semi"), [key, hashed])
