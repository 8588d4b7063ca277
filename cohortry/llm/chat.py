"""Chat formatting over a prefix tree.

Each turn is a node, named by a digest of all turns up to it, so conversations that begin alike share
nodes. Distinct conversations are sorted by their path of nodes; each node belongs to the first path that
has it. Emitting, path by path, the nodes that belong to it is the depth-first order of the tree, and every
shared turn comes once. A node knows where it starts in that order (offset), which position its first
character has in any conversation through it (position), and the intervals of the order that hold its
ancestors, which its characters attend to besides those before them in the node itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise

# The template: a mark, the role, the escaped text, an end mark. No mark's first character can come out of
# ``escape``, so no text can hold a control string.
HEAD, END, LEARNED = "### ", "</turn>\n", "assistant"
LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {v: k for k, v in LABELS.items()}
_CODES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
_PLAIN = {v: k for k, v in _CODES.items()}
_TURN = re.compile(r"### ([^:#<]*): ([^#<]*)</turn>\n")
ODD_CONVERSATION = -7
ODD_TEXT = "\\### Assistant: </turn> ok"


def escape(text: str, chars: str = "\\#<") -> str:
    return re.sub(f"[{re.escape(chars)}]", lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: _PLAIN[m[0]], text)


def format_turn(role: str | None, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text starts and ends in it. Roles without a label of their own are
    marked by ``=``, a null role by ``-``."""
    label = "-" if role is None else LABELS.get(role) or "=" + escape(role, "\\#<:")
    head, body = f"{HEAD}{label}: ", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str | None, str, int, int]]:
    """(role, text, start, end of the text) of every turn; what isn't made of whole turns is an error."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        label = m[1]
        role = None if label == "-" else _ROLES.get(label) or unescape(label[1:])
        out.append((role, unescape(m[2]), *m.span(2)))
        at = m.end()
    return out


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of a sorted stream as tuples, some at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield list(zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns)))


_NODE = {
    "conv_id": pa.int64(), "depth": pa.int64(), "node": pa.binary(), "parent": pa.binary(), "formatted": pa.string(), "length": pa.int64(),
    "position": pa.int64(), "loss_start": pa.int64(), "loss_end": pa.int64(),
}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns, sorted by conversation, as nodes: the name is a digest of the one before, the role and the text.

    Only the digest and the position of the turn before are held, however long a conversation is.
    """
    last, name, depth, position = (), b"", 0, 0
    for part in _cells(batches):
        rows = []
        for conv_id, role, text in part:
            if last != (conv_id,):
                last, name, depth, position = (conv_id,), b"", 0, 0
            marked = b"-" if role is None else b"=" + role.encode()
            parent, name = name or None, hashlib.sha256(name + len(marked).to_bytes(8, "big") + marked + text.encode()).digest()[:16]
            said, start, end = format_turn(role, text)
            if role != LEARNED:
                start = end = 0
            rows.append((conv_id, depth, name, parent, said, len(said), position, start, end))
            depth, position = depth + 1, position + len(said)
        yield _batch(rows, _NODE)


_ATTENDS = {"node": pa.binary(), "attends": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The attention intervals of the nodes that belong to a path, neighbours joined; nodes sorted by path."""
    last, above = None, []
    for part in _cells(batches):
        rows = []
        for rank, node, owner, offset, length in part:
            if rank != last:
                last, above = rank, []
            if owner == rank:
                rows.append((node, [{"start": a, "end": b} for a, b in above]))
            if above and above[-1][1] == offset:
                above[-1] = (above[-1][0], offset + length)
            else:
                above.append((offset, offset + length))
        if rows:
            yield _batch(rows, _ATTENDS)


@dataclass
class Formatted:
    """``nodes``: node, parent, depth, offset, length, position, formatted, loss_start, loss_end (under the
    loss mask, within the node), attends. ``conversations``: conv_id, leaf. ``paths``: leaf, path."""

    nodes: DataFrame
    conversations: DataFrame
    paths: DataFrame


def format_conversations(rows: DataFrame) -> Formatted:
    """Format all conversations of ``rows`` (conv_id, turn, role, text).

    Turns are in the order of ``turn``, null first, equal numbers by role and text. A null text counts as
    empty, a null role is kept apart from every other, a null conv_id is a conversation of its own, repeated
    rows are repeated turns. Turns are read as a sorted stream, so that a conversation of any length passes
    through a task without being held; of a path only the nodes' names (16 bytes a turn) stand in one row.
    Other columns are ignored.
    """
    order = ["conv_id", "turn", "role", "text"]
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    made = materialise(turns.mapInArrow(
        _nodes, "conv_id long, depth long, node binary, parent binary, formatted string, length long, position long, loss_start long, loss_end long"
    ))
    talks = materialise(made.groupBy("conv_id").agg(F.max_by("node", "depth").alias("leaf")))
    # Of equal conversations one goes on.
    one = talks.groupBy("leaf").agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("first"))
    chosen = made.join(one.select("leaf", F.col("first.conv_id").alias("of")), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of", "conv_id")
    paths = chosen.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("path"))
    # The number of a row in sorted parts grows along them; stored, it is the same whenever it is read.
    sorted_paths = materialise(paths.select("leaf", F.col("path.node").alias("path")).orderBy("path").withColumn("rank", F.monotonically_increasing_id()))
    ranks = sorted_paths.select("leaf", "rank")
    payload = ("parent", "depth", "formatted", "length", "position", "loss_start", "loss_end")
    owned = materialise(chosen.join(ranks, "leaf").groupBy("node").agg(F.min("rank").alias("owner"), *[F.first(c).alias(c) for c in payload]))
    # Offsets: running lengths within a sorted part, after the lengths of the parts before.
    owned = owned.withColumn("part", F.expr("shiftright(owner, 33)"))
    parts = owned.groupBy("part").agg(F.sum("length").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("owner", "depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = owned.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(parts, "part")
    placed = materialise(placed.withColumn("offset", F.col("base") + F.col("inside")).drop("part", "base", "inside"))
    chains = chosen.select("leaf", "node").join(ranks, "leaf").join(placed.select("node", "owner", "depth", "offset", "length"), "node")
    chains = chains.repartition("rank").sortWithinPartitions("rank", "depth").select("rank", "node", "owner", "offset", "length")
    attends = chains.mapInArrow(_intervals, "node binary, attends array<struct<start:long,end:long>>")
    nodes = placed.drop("owner").join(attends, "node")
    return Formatted(nodes, talks, sorted_paths.select("leaf", "path"))


_READ = {"leaf": pa.binary(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted nodes, sorted by conversation and position, read turn by turn; digests are kept, texts not."""
    last, n, chars, learned = None, 0, 0, 0
    said, loss = hashlib.sha256(), hashlib.sha256()

    def ended() -> list[tuple]:
        return [(last, n, said.hexdigest(), learned, loss.hexdigest(), chars)] if last is not None else []

    for part in _cells(batches):
        rows = []
        for leaf, formatted, start, end in part:
            if leaf != last:
                rows += ended()
                last, n, chars, learned = leaf, 0, 0, 0
                said, loss = hashlib.sha256(), hashlib.sha256()
            for role, text, _, _ in parse(formatted):
                said.update(f"{'' if role is None else role}\n{text}\n".encode())
                n += 1
            taught = unescape(formatted[start:end])
            loss.update(taught.encode())
            learned += len(taught)
            chars += len(formatted)
        if rows:
            yield _batch(rows, _READ)
    if rows := ended():
        yield _batch(rows, _READ)


def read_back(out: Formatted) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from the formatted output;
    a null role reads as an empty one in the digest. Equal conversations are read once."""
    pieces = out.paths.select("leaf", F.explode("path").alias("node")).join(out.nodes.select("node", "position", "formatted", "loss_start", "loss_end"), "node")
    pieces = pieces.repartition("leaf").sortWithinPartitions("leaf", "position").select("leaf", "formatted", "loss_start", "loss_end")
    read = pieces.mapInArrow(_read, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.conversations.join(read, "leaf").drop("leaf")


def with_odd_conversation(rows: DataFrame) -> DataFrame:
    """``rows`` and a conversation whose texts are control strings."""
    odd = [(ODD_CONVERSATION, k, role, ODD_TEXT) for k, role in enumerate(("user", "assistant"))]
    return rows.select("conv_id", "turn", "role", "text").unionByName(rows.sparkSession.createDataFrame(odd, "conv_id long, turn long, role string, text string"))
