"""A Merkle manifest of a dataset, and proofs climbed by a recursive query.

Every row is a leaf, the leaves of a language are a tree of runs of eight, and the roots of the languages
are a tree again. The built levels are stored as rows, one for each run, with the digests of its children
and the link to its parent. A recursive query ascends from each leaf: a step joins the run above, appends
the digests of the siblings as the proof's next piece and folds the leaf's digest, which may be that of a
tampered row, into the digest of the run.

Digests are kept as 32 bytes and hashed as lower-case hexadecimal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .common import ascii_lower, ranked

FANOUT_BITS, DIGEST = 3, 32
# The copies of a run high up are dealt by blocks of 8 ** 4 leaves, so that no key of a join has more.
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**fields: Column) -> Column:
    """The digest of a row: its fields, each ``-`` if null, else the number of bytes, a colon and the value."""
    return F.unhex(F.sha2(F.concat(*[_framed(fields.get(f, F.col(f))) for f in FIELDS]), 256))


def digest_of(joined: Column) -> Column:
    """The digest over digests that stand one after the other."""
    return F.unhex(F.sha2(F.lower(F.hex(joined)), 256))


def _joined(parts: Column, field: str) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x[field]))


def _levels(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The runs above ``nodes`` (tree, pos, digest, size), level by level: tree, pos, children, digest, size.

    ``size`` is the number of nodes of the tree on the row's own level; a tree ends where it is 1.
    """
    out = []
    while largest > 1:
        largest = -(-largest >> FANOUT_BITS)
        grouped = nodes.filter("size > 1").groupBy("tree", F.shiftright("pos", FANOUT_BITS).alias("pos"))
        runs = grouped.agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("run"), F.max("size").alias("size"))
        runs = runs.select("tree", "pos", _joined(F.col("run"), "digest").alias("children"), F.shiftright(F.col("size") + 7, FANOUT_BITS).alias("size"))
        nodes = materialise(runs.withColumn("digest", digest_of(F.col("children"))))
        out.append(nodes)
    return out


def _linked(levels: list[DataFrame], forest: DataFrame, top: list[DataFrame]) -> DataFrame:
    """The stored runs with links: tree, block, step and pos name a run, up and ord its parent and place in it.

    ``block`` numbers the leaves below by ``8 ** BLOCK_LEVELS``; a run with more leaves has a row for each block.
    """
    up, own = F.shiftright("pos", FANOUT_BITS), F.col("pos").bitwiseAND(7)
    parts = []
    for level, runs in enumerate(levels, 1):
        runs = runs.join(forest.select("tree", "blocks"), "tree")
        wide = FANOUT_BITS * (level - BLOCK_LEVELS)
        if wide <= 0:
            runs = runs.withColumn("block", F.shiftright("pos", -wide))
        else:
            last = F.least((F.col("pos") + 1) * (1 << wide), "blocks") - 1
            runs = runs.withColumn("block", F.explode(F.sequence(F.col("pos") * (1 << wide), last)))
        inside = F.col("size") > 1
        parts.append(runs.select(
            "tree", "block", F.lit(level).alias("step"), "pos", "children",
            F.when(inside, up).otherwise(F.shiftright("tree", FANOUT_BITS)).alias("up"),
            F.when(inside, own).otherwise(F.col("tree").bitwiseAND(7)).cast("int").alias("ord"),
        ))
    for level, runs in enumerate(top, 1):
        below = forest.select(F.col("tree").alias("of"), "height", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        runs = below.join(runs, F.shiftright("of", FANOUT_BITS * level) == F.col("pos"))
        parts.append(runs.select(F.col("of").alias("tree"), "block", (F.col("height") + level).alias("step"), "pos", "children", up.alias("up"), own.cast("int").alias("ord")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialise(out)


CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT tree, pos, doc_id, shiftright(pos, {FANOUT_BITS * BLOCK_LEVELS}) AS block, 0 AS step, up, ord, coalesce(changed, leaf) AS folded, leaf AS piece
  FROM {{leaves}}
  UNION ALL
  SELECT c.tree, c.pos, c.doc_id, c.block, r.step, r.up, r.ord,
         unhex(sha2(lower(hex(concat(substring(r.children, 1, {DIGEST} * c.ord), c.folded, substring(r.children, {DIGEST} * c.ord + {DIGEST + 1})))), 256)),
         concat(substring(r.children, 1, {DIGEST} * c.ord), substring(r.children, {DIGEST} * c.ord + {DIGEST + 1}))
  FROM climb AS c JOIN {{runs}} AS r ON r.tree = c.tree AND r.block = c.block AND r.step = c.step + 1 AND r.pos = c.up)
SELECT tree, pos, doc_id, step, folded, piece FROM climb LIMIT ALL"""


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` gives fields of the rows as they are found now (null or left out: as they were); the proof
    is folded with the digest of what is found. Leaves ascend by doc_id within a language, null ids
    first; rows with the same id are ordered by their digests, and equal rows are leaves of their own. A
    null lang is a language, the first. Null fields are told apart from empty ones. An empty table gives no
    rows. Only the five fields are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    leaf = leaf_digest()
    found = leaf_digest(**tampered) if tampered else F.lit(None).cast("binary")
    rows = docs.select(*FIELDS).select("doc_id", "lang", leaf.alias("leaf"), found.alias("changed"))
    hashed = materialise(rows.withColumn("changed", F.when(F.col("changed") != F.col("leaf"), F.col("changed"))))
    placed = ranked(hashed, "lang", ["doc_id", "leaf"], "pos", "size")
    langs = materialise(placed.groupBy("lang").agg(F.max("size").alias("size")).withColumn("one", F.lit(1)))
    blocks = F.shiftright(F.col("size") + ((1 << FANOUT_BITS * BLOCK_LEVELS) - 1), FANOUT_BITS * BLOCK_LEVELS)
    height = F.expr(f"size(filter(sequence(0, 20), k -> shiftleft(1L, {FANOUT_BITS} * k) < size))")
    forest = materialise(ranked(langs, "one", ["lang"], "tree", "trees").select("lang", "tree", "trees", "size", blocks.alias("blocks"), height.alias("height")))
    largest, trees = forest.agg(F.max("size"), F.max("trees")).first()
    empty = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if largest is None:
        return spark.createDataFrame([], empty)
    of = forest.select(F.col("lang").alias("of_lang"), "tree")
    inside = F.col("size") > 1
    leaves = materialise(placed.join(of, F.col("lang").eqNullSafe(F.col("of_lang"))).select(
        "tree", "pos", "size", "doc_id", "leaf", "changed",
        F.when(inside, F.shiftright("pos", FANOUT_BITS)).otherwise(F.shiftright("tree", FANOUT_BITS)).alias("up"),
        F.when(inside, F.col("pos").bitwiseAND(7)).otherwise(F.col("tree").bitwiseAND(7)).cast("int").alias("ord"),
    ))
    nodes = leaves.select("tree", "pos", F.col("leaf").alias("digest"), "size")
    levels = _levels(nodes, largest)
    roots = nodes.filter("size = 1").select("tree", "digest")
    for level in levels:
        roots = roots.unionByName(level.filter("size = 1").select("tree", "digest"))
    roots = materialise(roots)
    top = _levels(roots.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(trees).alias("size")), trees)
    root = (top[-1] if top else roots).first()["digest"]
    if levels or top:
        climbed = spark.sql(CLIMB, leaves=leaves, runs=_linked(levels, forest, top))
    else:  # a single row: its leaf is the root
        climbed = leaves.selectExpr("tree", "pos", "doc_id", "0 AS step", "coalesce(changed, leaf) AS folded", "leaf AS piece")
    proofs = climbed.groupBy("tree", "pos").agg(
        F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("step", "piece"))).alias("pieces"), F.max_by("folded", "step").alias("folded"),
    )
    text = lambda digest: F.lower(F.hex(digest))
    above = F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0)))
    return proofs.join(roots.withColumnRenamed("digest", "subroot"), "tree").select(
        "doc_id", text(F.get("pieces", F.lit(0))["piece"]).alias("leaf"), text(F.col("subroot")).alias("subroot"), text(F.lit(bytes(root))).alias("root"),
        F.sha2(text(_joined(above, "piece")), 256).alias("proof_sha256"), text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.lit(bytes(root))).alias("verified"),
    )


def tampered_thirds(docs: DataFrame) -> dict[str, Column]:
    """The text with A-Z in lower case where 3 divides the CRC-32 of the id's digits."""
    return {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))}


def manifest_sql() -> str:
    """``manifest`` with ``tampered_thirds`` as DuckDB SQL."""
    frame = lambda x: f"coalesce(strlen({x}) || ':' || {x}, '-')"
    row = lambda text: "sha256(" + " || ".join(frame(text if f == "text" else f"{f}::VARCHAR") for f in FIELDS) + ")"
    shift = "list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: {shift}), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE h AS MATERIALIZED (
  SELECT doc_id, lang, {row("text")} AS leaf, {row(f"CASE WHEN {crc} % 3 = 0 THEN {lower} ELSE text END")} AS found FROM documents),
l AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS size FROM h),
node AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, size FROM l
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(size) + 7) // 8 FROM node WHERE size > 1 GROUP BY tree, level, pos // 8),
sub AS MATERIALIZED (SELECT tree, level AS height, digest, count(*) OVER () AS trees FROM node WHERE size = 1),
upper AS (
  SELECT 0 AS level, tree AS pos, digest, trees AS size FROM sub
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(size) + 7) // 8 FROM upper WHERE size > 1 GROUP BY level, pos // 8),
root AS (SELECT digest FROM upper WHERE size = 1),
step AS MATERIALIZED (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS before, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS after
  FROM node a JOIN node b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.size > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), ''), coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '')
  FROM upper a JOIN upper b ON a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.size > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, leaf, tree AS own, pos AS row, tree, 0 AS level, pos, found AS folded, '' AS proof FROM l
  UNION ALL
  SELECT doc_id, leaf, own, row, n.tree, n.level, n.pos, sha256(before || folded || after), proof || before || after
  FROM (SELECT c.*, sub.height FROM climb c JOIN sub ON sub.tree = c.own) c
  JOIN step s ON s.tree = CASE WHEN c.tree >= 0 AND c.level = c.height THEN -1 ELSE c.tree END
             AND s.level = CASE WHEN c.tree >= 0 AND c.level = c.height THEN 0 ELSE c.level END AND s.pos = CASE WHEN c.tree >= 0 AND c.level = c.height THEN c.tree ELSE c.pos END,
  LATERAL (SELECT s.tree AS tree, s.level + 1 AS level, s.pos // 8 AS pos) n),
last AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY own, row ORDER BY tree >= 0, level DESC) = 1)
SELECT doc_id, leaf, sub.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.digest AS verified
FROM last JOIN sub ON sub.tree = last.own, root"""
