"""Exact top-k search by columnar branch-and-bound.

Queries and candidates meet in groups of one block of queries and one slice of the rows. Within a group
the candidates stand in vertical layout, a row of numbers for each dimension, and scores are accumulated
block of dimensions by block. What the dimensions still to come can add is at most the product of the
remaining masses (the norms of the rest) of query and candidate. Pairs whose score cannot reach the
query's k-th best any more are dropped, survivors compacted: first whole candidates that no query of the
tile needs, then, when few are left, single pairs. Each group sends k rows a query at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise

SCALE, K, EVERY = 256, 5, 50
# Sizes of work at a time; results do not depend on them.
BLOCK_DIMS, QUERY_ROWS, SLICE_ROWS, LEAST_SLICE, QUERY_TILE, ROW_TILE = 16, 65_536, 131_072, 4096, 128, 4096
EXACT = 2.0**53


def whole_numbers(lists: pa.ChunkedArray) -> np.ndarray:
    """A row for each list: floor(SCALE * x), shorter lists filled up with zeros."""
    lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(SCALE * values)
    return out


class Best:
    """The k best (score, place) seen of each query; ties go to the smaller place."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score, self.place = np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, query: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        """Take in scores of pairs; queries may repeat."""
        hit = np.unique(query)
        pool = (
            np.concatenate([np.repeat(hit, self.k), query]), np.concatenate([self.place[hit].ravel(), place]),
            np.concatenate([self.score[hit].ravel(), score]),
        )
        order = np.lexsort((pool[1], -pool[2], pool[0]))
        owner = pool[0][order]
        first = np.searchsorted(owner, hit)
        rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        order, rank, owner = order[rank < self.k], rank[rank < self.k], owner[rank < self.k]
        self.score[owner, rank], self.place[owner, rank] = pool[2][order], pool[1][order]


def _rest(rows: np.ndarray, cuts: list[int]) -> np.ndarray:
    """The norm of what stands behind each cut, a row for each cut; a little larger, never smaller."""
    squares = np.stack([np.square(rows[:, c:]).sum(1) for c in cuts])
    return np.sqrt(squares) * (1 + 1e-9)


def search(queries: np.ndarray, columns: np.ndarray, own: np.ndarray, k: int = K) -> Best:
    """The best of ``columns`` (dimension by candidate) for each row of ``queries``.

    ``own`` is the candidate that is the query itself, -1 where it is not among them. All numbers are
    whole; sums up to 2 ** 53 are exact as doubles, others are added up as Python's integers.
    """
    dims = queries.shape[1]
    mass = float(np.abs(queries).max(initial=0)) * float(np.abs(columns).max(initial=0)) * max(dims, 1)
    best = Best(len(queries), k)
    if mass >= EXACT:
        return _search_large(queries, columns, own, best)
    cuts = [*range(0, dims, BLOCK_DIMS), dims] if dims else [0, 0]
    rest_q, rest_c = _rest(queries, cuts[1:]), _rest(columns.T, cuts[1:])
    for q in range(0, len(queries), QUERY_TILE):
        tile = queries[q : q + QUERY_TILE]
        for c in range(0, columns.shape[1], ROW_TILE):
            _tile(tile, columns[:, c : c + ROW_TILE], own[q : q + QUERY_TILE] - c, cuts, rest_q[:, q : q + QUERY_TILE], rest_c[:, c : c + ROW_TILE], q, c, best)
    return best


def _tile(queries, columns, own, cuts, rest_q, rest_c, q_at, c_at, best: Best) -> None:
    least = best.least()[q_at : q_at + len(queries)]
    alive = np.arange(columns.shape[1])
    score = np.zeros((len(queries), len(alive)))
    for b, (start, end) in enumerate(zip(cuts, cuts[1:])):
        score += queries[:, start:end] @ columns[start:end, alive]
        keep = score + np.outer(rest_q[b], rest_c[b, alive]) >= least[:, None]
        held = (own >= 0) & (own < columns.shape[1])
        if held.any():  # the query's own row
            at = np.searchsorted(alive, own[held])
            inside = (at < len(alive)) & (alive[np.minimum(at, len(alive) - 1)] == own[held])
            keep[np.flatnonzero(held)[inside], at[inside]] = False
        share = keep.mean() if keep.size else 0.0
        if share <= 0.1 or b == len(cuts) - 2:  # few pairs are left: they are finished one by one
            row, at = np.nonzero(keep)
            found, place = score[row, at], alive[at]
            for n, (s, e) in enumerate(zip(cuts[b + 1 :], cuts[b + 2 :]), b + 1):
                found = found + np.einsum("ij,ji->i", queries[row, s:e], columns[s:e, place])
                near = found + rest_q[n, row] * rest_c[n, place] >= least[row]
                row, place, found = row[near], place[near], found[near]
            if len(row):
                best.add(row + q_at, place + c_at, found)
            return
        needed = keep.any(0)
        if needed.mean() < 0.75:
            alive, score = alive[needed], score[:, needed]


def _search_large(queries, columns, own, best: Best) -> Best:
    whole = [[int(x) for x in row] for row in columns.T]
    for q, row in enumerate(queries):
        mine = [int(x) for x in row]
        scores = sorted((-sum(a * b for a, b in zip(mine, c)), place) for place, c in enumerate(whole) if place != own[q])[: best.k]
        best.score, best.place = best.score.astype(object), best.place
        for rank, (score, place) in enumerate(scores):
            if not -(2**63) <= -score < 2**63:
                raise OverflowError("a score does not fit into 64 bits")
            best.score[q, rank], best.place[q, rank] = -score, place
    return best


def _group(k: int):
    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        # The order of the rows is the order of ties.
        rows = rows.sort_by([("none", "ascending"), ("vec_id", "ascending"), ("row", "ascending")])
        q, c = whole_numbers(queries["vector"]), whole_numbers(rows["vector"])
        dims = max(q.shape[1], c.shape[1])
        q, c = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, c))
        q_row, c_row = queries["row"].to_numpy(), rows["row"].to_numpy()
        by_row = np.argsort(c_row)
        at = np.searchsorted(c_row[by_row], q_row)
        at = np.minimum(at, len(c_row) - 1)
        own = np.where(c_row[by_row[at]] == q_row, by_row[at], -1) if len(c_row) else np.full(len(q_row), -1)
        # Large scores first would find good bounds sooner; the order of ties is kept by places instead.
        best = search(q, np.ascontiguousarray(c.T), own, k)
        query, rank = np.nonzero(best.place < len(c_row))
        place = best.place[query, rank]
        return pa.table({
            "q_row": q_row[query], "query_id": queries["vec_id"].take(pa.array(query)), "vec_id": rows["vec_id"].take(pa.array(place)),
            "row": c_row[place], "score": pa.array([int(x) for x in best.score[query, rank]], pa.int64()),
        })

    return run


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows with the highest inner product of each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all other rows, those with
    the same vec_id too: every row of a repeated id is a query and a candidate of its own. Components
    count as floor(256 * x). Ties go to the smaller vec_id, a null id after all others; of rows with one
    id the order is that of the scan, which the result does not show. Vectors that are null or
    hold a null or non-finite component take no part. A shorter vector counts as filled up with zeros. A
    score beyond 64 bits is an error. An empty table gives no rows. Only vec_id and embedding are read.
    """
    x = F.col("embedding").cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), fine.alias("fine")).filter("fine").drop("fine")
    rows = materialise(rows.withColumns({"row": F.monotonically_increasing_id(), "none": F.col("vec_id").isNull()}))
    asked = F.coalesce(F.pmod("vec_id", F.lit(every)) == 0, F.lit(False))
    n, n_asked = rows.agg(F.count(F.lit(1)), F.count_if(asked)).first()
    wanted = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    slices = max(min(-(-n // LEAST_SLICE), wanted), -(-n // SLICE_ROWS), 1)
    blocks = max(-(-n_asked // QUERY_ROWS), 1)
    # Only the smaller of both sides is copied often: a query once for each slice, a row once for each block.
    dealt = F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int")
    candidates = rows.select("*", dealt.alias("slice"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    queries = rows.filter(asked).select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    keys = ["block", "slice"]
    found = queries.repartition(slices * blocks, *keys).groupBy(*keys).cogroup(candidates.repartition(slices * blocks, *keys).groupBy(*keys))
    found = found.applyInArrow(_group(k), "q_row long, query_id long, vec_id long, row long, score long")
    best = Window.partitionBy("q_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_sql(k: int = K, every: int = EVERY) -> str:
    """``top_k`` as DuckDB SQL, for vectors of one length."""
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(q.v, lambda x, i: x * c.v[i])), 0)::BIGINT AS score FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % {every} = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= {k}"""
