"""Secret scans through a ledger of blobs.

Every version of a text is addressed by its content. The ledger, a stored table that only grows, has a
row for each blob and the rule versions it was scanned with, and the spans found. A scan reads one copy
of each blob that lacks a rule version of today, applies only what it lacks, appends to the ledger, and
joins the findings of today's rule versions back to every path that has the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import whole


@dataclass(frozen=True)
class Rule:
    """A pattern; matches whose ``group`` is shorter than ``least`` characters are dropped after matching."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The base patterns and their least lengths.
BASE = (
    Rule("assign", 1, "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, "[0-9a-f]+", 0, 24),
)
# Published shapes of further credentials.
ADDED = (
    Rule("github", 1, "gh[opsur]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = (*BASE, *ADDED)
LEDGER = "blob binary, tags array<string>, spans array<struct<tag:string,kind:string,start:int,end:int>>"


def find(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost matches that don't overlap, in code points; short ones are dropped after matching."""
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scanner(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(r, re.compile(_quick(r))) for r in rules]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                spans = []
                for text, due in zip(part.column("text").to_pylist(), part.column("tags").to_pylist()):
                    spans.append([
                        {"tag": r.tag, "kind": r.kind, "start": a, "end": b}
                        for r, p in compiled if r.tag in due for a, b in find(r, p, text)
                    ])
                yield pa.RecordBatch.from_arrays(
                    [part.column("blob"), part.column("tags"), pa.array(spans, pa.list_(pa.struct([("tag", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))],
                    names=["blob", "tags", "spans"],
                )

    return run


def _quick(rule: Rule) -> str:
    """A rule that is one run of characters may state its least length: runs are maximal either way."""
    run = re.fullmatch(r"([A-Za-z0-9]*)(\[[^\]]+\])\+", rule.pattern)
    return f"{run[1]}{run[2]}{{{max(1, rule.least - len(run[1]))},}}" if run and rule.group == 0 else rule.pattern


def blob_of(text) -> F.Column:
    return F.unhex(F.sha2(whole(text), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; a folder that holds none yet is an empty ledger."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks and return its findings for every path: path, blob, spans.

    ``versions`` has the columns path (any type) and text. A null text counts as empty. Paths that repeat
    give a row each. An empty table scans nothing and gives no rows. Spans are sorted by start, then in
    the order of ``rules``.
    """
    spark, tags = versions.sparkSession, [r.tag for r in rules]
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("tags")).alias("known"))
    blobs = versions.select(blob_of("text").alias("blob"), whole().alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*map(F.lit, tags))
    due = F.array_except(wanted, F.coalesce("known", F.expr("array()")))
    lacking = blobs.join(known, "blob", "left").select("blob", "text", due.alias("tags")).filter(F.size("tags") > 0)
    lacking.mapInArrow(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)

    order = F.create_map(*[x for k, t in enumerate(tags) for x in (F.lit(t), F.lit(k))])
    found = read_ledger(spark, ledger).filter(F.size("spans") > 0).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("all"))
    today = F.filter("all", lambda s: F.array_contains(wanted, s["tag"]))
    sortable = F.array_sort(F.transform(today, lambda s: F.struct(s["start"].alias("start"), order[s["tag"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))))
    found = found.select("blob", sortable.alias("spans"))
    paths = versions.select("path", blob_of("text").alias("blob"))
    return paths.join(found, "blob", "left").select("path", "blob", F.coalesce("spans", F.expr("array()").cast(found.schema["spans"].dataType)).alias("spans"))


def secret_digests(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = scan(docs.select(F.col("doc_id").alias("path"), "text"), ledger or f"{shared_dir(docs.sparkSession)}/ledger")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("path").alias("doc_id"), *[number(r.kind) for r in BASE], F.sha2(said(base), 256).alias("base_sha256"), said("spans").alias("spans"))
