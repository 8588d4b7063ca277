"""Mixing sources to target weights by Pfair scheduling.

The rows of a source, in the order of a hash of their ids, form blocks. With the share a/W of the total
weight, block i of a source is released at slot floor(i W / a) and due by slot ceil((i + 1) W / a); one block
is served a slot, the earliest deadline first. Shares are exact fractions, so at any slot each source is
less than one block from its target, however long the mixture is and whatever the weights.

Slots are scheduled in segments, each by itself on an executor. What every source has had before a segment
follows from the slot's number alone (``served``), so no segment waits for another; segments that hold no
block with rows are passed over, and one ends when its last such block has a slot. A segment is at least
as long as the wait between two blocks of the rarest source, so each block meets one border at most. A
source that has run out leaves its later slots empty; no row is dropped or repeated.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh

# SEGMENT: least number of slots scheduled at a time.
BLOCK_ROWS, CELL_ROWS, SEGMENT, BATCH = 16, 20_000, 1 << 16, 1 << 16
NO_SOURCE = "(none)"


def shares(weights: Mapping[str, float | Fraction]) -> dict[str, int]:
    """Whole numbers in exact proportion to the weights, by name; sources of weight 0 are left out.

    Weights count as the decimals or fractions they are written as.
    """
    exact = {s: Fraction(str(w)) for s, w in sorted(weights.items())}
    if any(w < 0 for w in exact.values()):
        raise ValueError("a weight is below 0")
    common = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * common) for s, w in exact.items() if w > 0}
    least = math.gcd(*whole.values())
    return {s: a // least for s, a in whole.items()}


def segment_slots(parts: list[int], least: int = SEGMENT) -> int:
    """Slots of a segment: no block's window, from release to deadline, holds two borders."""
    return max(least, -(-sum(parts) // min(parts)) + 2)


def served(parts: list[int], t: int) -> list[int]:
    """Blocks of each source in the slots before ``t``: its exact share, rounded down or up.

    Of the sources in the middle of a block some have had it, the others wait. Both sides of ``t`` have to
    be schedulable. Before ``t``: of the sources whose block was released before a slot s, no more may wait
    than waited at s, which is at least the sum of what these sources still lack of their blocks. These bounds
    on nested sets are a matroid. After ``t``: the fewer early deadlines wait, the better. Letting the latest
    deadlines wait first, as far as the bounds allow, is best for every deadline at once; the exact shares
    keep to both kinds of bounds, so it is enough.
    """
    total = sum(parts)
    done = [a * t // total for a in parts]
    rest = {k: a * t % total for k, a in enumerate(parts) if a * t % total}
    release = {k: done[k] * total // parts[k] for k in rest}
    ends = sorted(set(release.values()))
    lack = dict.fromkeys(ends, 0)
    for k, r in rest.items():
        lack[release[k]] += total - r
    room, so_far = [], 0
    for s in ends:
        so_far += lack[s]
        room.append(-(-so_far // total))
    place = {s: j for j, s in enumerate(ends)}
    for k in sorted(rest, key=lambda k: (-(-(done[k] + 1) * total // parts[k]), k), reverse=True):
        j = place[release[k]]
        if min(room[j:]) > 0:
            room[j:] = [n - 1 for n in room[j:]]
        else:
            done[k] += 1
    assert sum(done) == t
    return done


def schedule(parts: list[int], start: int, end: int, last: bool = False) -> Iterator[tuple[int, int, int]]:
    """(source, block, slot) of the slots from ``start`` to ``end``, earliest deadline first among the released.

    What is served before ``start`` and, unless this is the ``last`` segment, before ``end`` is that of ``served``.
    """
    total = sum(parts)
    first, bound = served(parts, start), None if last else served(parts, end)
    waiting = [(i * total // parts[k], k, i) for k, i in enumerate(first) if bound is None or i < bound[k]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    for slot in range(start, end):
        while waiting and waiting[0][0] <= slot:
            _, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // parts[k]), k, i))
        due, k, i = heapq.heappop(ready)
        assert slot < due
        yield k, i, slot
        if bound is None or i + 1 < bound[k]:
            heapq.heappush(waiting, ((i + 1) * total // parts[k], k, i + 1))


def planned(spark: SparkSession, parts: dict[str, int], blocks: Mapping[str, int], segment: int = SEGMENT) -> DataFrame:
    """(source, block, slot) of the first ``blocks`` blocks of each source, scheduled on executors."""
    names, shared = list(parts), list(parts.values())
    total, held = sum(shared), [blocks.get(s, 0) for s in names]
    end = max([-(-n * total // a) for n, a in zip(held, shared)], default=0)
    segment = segment_slots(shared, segment) if shared else segment
    segments = -(-end // segment)
    schema = pa.schema([("source", pa.string()), ("block", pa.int64()), ("slot", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column("id").to_pylist():
                start, last = n * segment, n + 1 == segments
                before = served(shared, start)
                after = held if last else served(shared, start + segment)
                left = sum(max(0, min(b, h) - a) for a, b, h in zip(before, after, held))
                found: list[tuple[int, int, int]] = []
                for k, i, slot in schedule(shared, start, start + segment, last) if left else ():
                    if i < held[k]:
                        found.append((k, i, slot))
                        left -= 1
                    if len(found) >= BATCH or not left:
                        yield pa.RecordBatch.from_arrays([pa.array([names[k] for k, _, _ in found], pa.string()), *(pa.array([f[c] for f in found], pa.int64()) for c in (1, 2))], schema=schema)
                        found = []
                    if not left:
                        break

    tasks = max(1, min(segments, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, segments, 1, tasks).mapInArrow(run, "source string, block long, slot long")


def even_weights(counts: Mapping[str, int]) -> dict[str, int]:
    """Target weights in proportion to the square root of the sources' row counts, in whole thousandths."""
    return {s: math.floor(1000 * math.sqrt(n)) for s, n in counts.items()}


RESULTS = ("block", "release", "due", "slot", "place")


def mix(docs: DataFrame, weights: Mapping[str, float | Fraction] | None = None, block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS, segment: int = SEGMENT) -> DataFrame:
    """``docs`` with block, release, due, slot and place (its row's number in the block).

    Sorted by (slot, place) the rows are the mixture. ``weights`` names the sources (a configuration, or one
    number a source in the table); a source without a weight is an error. Rows of a source of weight 0 have
    no slot: release, due and slot are null. A null source is the source ``(none)``, a null id comes
    first. Rows that are equal in id are interchangeable. An empty table gives an empty result. Columns of
    ``docs`` with a result's name are replaced; ``in_mixed_order`` keeps them.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULTS])
    rows = {r["source"]: r["n"] for r in docs.groupBy(F.coalesce("source", F.lit(NO_SOURCE)).alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = even_weights(rows) if weights is None else weights
    if missing := sorted(set(rows) - set(weights)):
        raise ValueError(f"no weight for source {missing[0]}")
    if not rows:
        return docs.withColumns({c: F.lit(None).cast("long") for c in RESULTS}).filter(F.lit(False))
    parts = shares(weights)
    name, hashed, cell, before, inside, slots = (fresh(docs, x) for x in ("mix_source", "mix_hash", "mix_cell", "mix_before", "mix_rank", "mix_slots"))
    cells = max(1, math.ceil(sum(rows.values()) / cell_rows))
    marked = docs.withColumn(name, F.coalesce("source", F.lit(NO_SOURCE))).withColumn(hashed, F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    marked = marked.withColumn(cell, F.floor(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long") * cells / F.lit(2**32)))
    # Ranks: rows before a cell from one count per cell, and the rank within the cell.
    sooner = Window.partitionBy(name).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy(name, cell).agg(F.count(F.lit(1)).alias("n")).withColumn(before, F.coalesce(F.sum("n").over(sooner), F.lit(0)))
    # The slots of a cell's blocks, which follow one another, travel with its count.
    plan = planned(spark, parts, {s: -(-n // block_rows) for s, n in rows.items()}, segment)
    spread = counts.withColumn("block", F.explode(F.expr(f"sequence({before} div {block_rows}, ({before} + n - 1) div {block_rows})")))
    spread = spread.join(plan.withColumnRenamed("source", name), [name, "block"], "left")
    of_cell = spread.groupBy(name, cell).agg(F.max(before).alias(before), F.sort_array(F.collect_list(F.struct("block", "slot"))).alias(slots))
    ranked = marked.withColumn(inside, F.row_number().over(Window.partitionBy(name, cell).orderBy(hashed, "doc_id")) - 1)
    ranked = ranked.join(of_cell, [name, cell]).withColumn(inside, F.col(inside) + F.col(before))
    placed = ranked.withColumn("block", F.floor(F.col(inside) / block_rows))
    total = sum(parts.values())
    share = F.create_map(*[F.lit(x) for s, a in parts.items() for x in (s, a)]) if parts else F.expr("CAST(map() AS map<string,bigint>)")
    own, number = share[F.col(name)].cast("decimal(38,0)"), F.col("block").cast("decimal(19,0)")
    exact = {"block": F.col("block"), "own": own, "number": number, "total": F.lit(str(total)).cast("decimal(19,0)")}
    held = placed.withColumns({f"{slots}_{k}": v for k, v in exact.items() if k != "block"})
    return held.select(
        *[F.col(f"`{c}`") for c in docs.columns], "block",
        F.expr(f"CAST(({slots}_number * {slots}_total) DIV {slots}_own AS BIGINT)").alias("release"),
        F.expr(f"CAST((({slots}_number + 1) * {slots}_total + {slots}_own - 1) DIV {slots}_own AS BIGINT)").alias("due"),
        F.get(slots, (F.col("block") - F.get(slots, F.lit(0))["block"]).cast("int"))["slot"].alias("slot"),
        F.pmod(inside, F.lit(block_rows)).cast("long").alias("place"),
    )


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float | Fraction] | None = None, places: bool = False) -> DataFrame:
    """``docs`` laid out in the order of the mixture, over ranges of slots; same columns, every row.

    Columns of any name are kept as they are. Rows of a source of weight 0 come last. Files that Spark reads
    again come in the order of their sizes. With ``places`` slot and place come before the columns, so that
    stored rows can be put back into the order.
    """
    rows = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    order = [F.col("slot").asc_nulls_last(), F.col("place")]
    ordered = mix(rows, weights).select("slot", "place", "row").repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select(*(("slot", "place") if places else ()), "row.*")


def mix_sql(block_rows: int = BLOCK_ROWS) -> str:
    """``mix`` with its own weights as DuckDB SQL, for mixtures of one segment: the schedule slot by slot."""
    return f"""
WITH RECURSIVE n AS MATERIALIZED (SELECT coalesce(source, '{NO_SOURCE}') AS source, count(*) AS n, floor(1000 * sqrt(count(*)))::BIGINT AS a FROM documents GROUP BY 1),
total AS MATERIALIZED (SELECT sum(a)::BIGINT AS w FROM n),
span AS MATERIALIZED (SELECT max(((n + {block_rows - 1}) // {block_rows} * w + a - 1) // a) AS slots FROM n, total),
quota AS MATERIALIZED (SELECT list(source ORDER BY source) AS names, list(a ORDER BY source) AS a, any_value(w) AS w, any_value(slots) AS slots FROM n, total, span),
edf(t, done, pick, a, w, slots) AS (
  SELECT -1::BIGINT, list_transform(a, lambda x: 0::BIGINT), 0::BIGINT, a, w, slots FROM quota
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, i: CASE WHEN i = p THEN x + 1 ELSE x END), p, a, w, slots FROM (
    SELECT t, done, a, w, slots, list_position(due, list_min(due))::BIGINT AS p FROM (
      SELECT t, done, a, w, slots, list_transform(a, lambda x, i: CASE WHEN done[i] * w // x <= t + 1 THEN ((done[i] + 1) * w + x - 1) // x ELSE 9000000000000000000 END) AS due
      FROM edf WHERE t + 1 < slots))),
plan AS (SELECT names[pick] AS source, done[pick] - 1 AS block, t FROM edf, (SELECT names FROM quota) WHERE t >= 0),
r AS (SELECT doc_id, source AS given, coalesce(source, '{NO_SOURCE}') AS source, row_number() OVER (PARTITION BY coalesce(source, '{NO_SOURCE}') ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1 AS r FROM documents),
b AS (SELECT r.*, r.r // {block_rows} AS block, n.a, w FROM r JOIN n USING (source), total)
SELECT doc_id, given AS source, b.block, b.block * w // a AS release, ((b.block + 1) * w + a - 1) // a AS due, t AS slot, r % {block_rows} AS place
FROM b JOIN plan ON plan.source = b.source AND plan.block = b.block"""
