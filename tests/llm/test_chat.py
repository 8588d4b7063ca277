import hashlib

from hypothesis import given
from hypothesis import strategies as st

from cohortry.llm.chat import ODD_TEXT, escape, format_conversations, format_turn, parse, read_back, unescape
from cohortry.llm.queries import QUERIES

from ..conftest import SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string"
ROWS = [
    (1, 0, "user", "Hi"), (1, 1, "assistant", "Hello"), (1, 2, "user", "Bye"),
    (2, 1, "assistant", "Hello"), (2, 0, "user", "Hi"), (2, 2, "user", "More"), (2, 3, "assistant", "é"),
    (3, 0, "user", "Hi"), (4, 0, "user", "Hi"), (5, 0, "tool: x", None), (5, 0, "tool: x", None), (6, None, None, "a"), (6, 0, "", ODD_TEXT), (None, 0, "assistant", "x" * 100_000),
    (7, 0, "user", "Hi"), (7, 1, "assistant", "Hello"), (7, 2, "user", "Bye"),
]


def plain(rows):
    talks = {}
    for c, t, r, x, *_ in rows:
        talks.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x or ""))
    out = []
    for c, turns in talks.items():
        turns.sort()
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=str)


def read(df):
    return sorted([(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()], key=str)


@given(st.text("ab\\#<:/turn> \nhlcAssistant", max_size=60), st.one_of(st.none(), st.sampled_from(["user", "assistant", "system", "", "a: b", "-", "=", "User"])))
def test_round_trip(text, role):
    said, start, end = format_turn(role, text)
    assert unescape(escape(text)) == text and "###" not in escape(text) and "</turn>" not in escape(text)
    assert [(r, t) for r, t, _, _ in parse(said * 3)] == [(role, text)] * 3
    assert unescape(said[start:end]) == text


def test_tree(spark):
    out = format_conversations(spark.createDataFrame([(*r, "extra") for r in ROWS], SCHEMA))
    nodes = sorted(out.nodes.collect(), key=lambda n: n.offset)
    by_name = {bytes(n.node): n for n in nodes}
    assert len(by_name) == len(nodes) == 10
    assert sum("Hi" in n.formatted for n in nodes) == 1
    text = "".join(n.formatted for n in nodes)
    at, seen = 0, []
    for n in nodes:
        assert n.offset == at
        at += n.length
        while seen and (n.parent is None or bytes(seen[-1].node) != bytes(n.parent)):
            seen.pop()  # depth first: the parent is on the way back
        assert (n.parent is None) == (not seen)
        seen.append(n)
        above, p = "", n.parent
        while p is not None:
            above = by_name[bytes(p)].formatted + above
            p = by_name[bytes(p)].parent
        assert "".join(text[s.start : s.end] for s in n.attends) == above and n.position == len(above)
    assert read(read_back(out)) == plain(ROWS)


def test_empty(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op9_chat_format"](spark, SMALL)
    assert read(got) == plain([*rows, (-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)])
    odd = got.filter("conv_id = -7").first()
    assert odd.formatted_chars == sum(len(format_turn(r, ODD_TEXT)[0]) for r in ("user", "assistant"))


def test_long_conversations_in_small_batches(spark):
    rows = [(c, k, ("user", "assistant")[k % 2], f"t{k // 3 if k < 40 else k * (c or 7)}") for c in (1, 2, None) for k in range(120)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert read(read_back(format_conversations(df))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
