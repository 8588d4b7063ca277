"""Byte-pair encoding by an automaton, decoding by its arc labels.

The merge list of a tokenizer file is compiled once, on the driver. The automaton starts with one arc for
each base symbol, allowed after each other one. Every merge (u, v) -> w then applies its gadget, in order:

* the state reached by u loses its arc v (that sequence is spelled w from now on),
* an arc w appears wherever an arc u is allowed now,
* the state reached by w gets the arcs which the state reached by v had before the cut.

A state is named by the label of the arc that reaches it. Copies are held by reference: a new row or
column of the arc table is its origin as it stood at that step, so the compiled tables grow with the
merges and not with their square. What the automaton accepts is exactly one label sequence for each
word, the one that applying the merges in order gives. A word is read from left to right; each prefix has
one accepted sequence, so one state per position is all there is.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import fresh, whole

# Bounds of the caches of one Python worker; a full one starts anew, results do not depend on them. Of words
# the ones before are kept until it is full again.
CACHED_WORDS, CACHED_PREFIXES, CACHED_STEPS = 175_000, 100_000, 100_000
# Only words up to so many letters are kept beyond their slice, and their prefixes up to so many bytes.
SHARED = 48
# A text is encoded in slices of so many letters that end at white space, so that a long one is never held as words.
SLICE = 1 << 18
# Texts below this code point (Latin letters) take a shorter pattern.
NARROW = 0x250
_GAP = re.compile(r"[ \t-\r]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the others get the code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


def _code_points() -> list[str]:
    return [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]


def class_members(name: str) -> list[tuple[int, int]]:
    """The code points of a class in the pattern language of tokenizer files, as ranges.

    Editions of Unicode differ in the newest letters, so the library that the files are made for is asked.
    """
    cut = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True)
    return [(ord(piece[0]), ord(piece[-1])) for piece, _ in cut.pre_tokenize_str("".join(_code_points()))]


def lower_differences() -> dict[int, str]:
    """Letters whose lower case in tokenizers, which look at one letter at a time, is not Python's."""
    letters = [c for c in _code_points() if c != "\n"]
    low = normalizers.Lowercase().normalize_str("\n".join(letters)).split("\n")
    return {ord(c): to for c, to in zip(letters, low) if c.lower() != to} | {ord("Σ"): "σ"}


def word_pattern(pattern: str, classes: dict[str, list[tuple[int, int]]], end: int) -> re.Pattern:
    """A tokenizer's pattern for texts of code points below ``end``, its classes spelled out."""
    for name, members in classes.items():
        pattern = pattern.replace(name, "".join(f"\\U{a:08x}-\\U{min(b, end):08x}" for a, b in members if a < end))
    return re.compile(pattern)


class _Coded(dict):
    """Ids of words as they are packed, read when first met."""

    def __init__(self, read):
        super().__init__()
        self.read, self.before, self.long = read, {}, {}

    def __missing__(self, word: str) -> bytes:
        code = self.before.get(word) or self.long.get(word)
        if code is None:
            ids = self.read(word.encode())
            code = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) > SHARED:
            self.long[word] = code
            return code
        if len(self) >= CACHED_WORDS:
            self.before = dict(self)
            self.clear()
        self[word] = code
        return code


class Automaton:
    """Compiled merges; see the head of this file. Instances travel to the tasks without their caches."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str, special: dict[str, int], pattern: str):
        self.special, self.pattern = special, pattern
        # What all special strings begin with; None without any. Empty: any text may hold one.
        self.mark = os.path.commonprefix(list(special)) if special else None
        self.classes = {name: class_members(name) for name in (r"\p{L}", r"\p{N}", r"\s")}
        self.lower = lower_differences()
        size = max([*vocab.values(), *special.values()]) + 1
        self.labels = [""] * size
        for label, i in [*vocab.items(), *special.items()]:
            self.labels[i] = label
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.cut: dict[int, int] = {}
        for step, (u, v) in enumerate(merges):
            self._gadget(step, vocab[u], vocab[v], vocab[u + v])
        self._spell(vocab, suffix)
        self._fresh_caches()

    def _gadget(self, step: int, u: int, v: int, w: int) -> None:
        if max(self.born[u], self.born[v]) >= step or self.born[w] >= 0:
            raise ValueError(f"merge {step}: its parts must come before it, and its result only once")
        self.cut[u << 32 | v] = step
        self.born[w], self.left[w], self.right[w] = step, u, v

    def _spell(self, vocab: dict[str, int], suffix: str) -> None:
        """Labels by the bytes they spell, within a word and at its end."""
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.size = [0] * len(self.labels)
        for label, i in vocab.items():
            last = bool(suffix) and label.endswith(suffix) and label != suffix
            spelled = bytes(byte_of[c] for c in (label[: -len(suffix)] if last else label))
            (self.final if last else self.inner)[spelled] = i
            self.size[i] = len(spelled)
        self.longest = max(self.size)

    def _fresh_caches(self) -> None:
        self.steps: dict[int, bool] = {}
        self.states: dict[bytes, int] = {}
        self.coded = _Coded(self.read)
        self.narrow, self.wide = word_pattern(self.pattern, self.classes, NARROW), None
        # Letters that need the long way: beyond the short pattern, or once they are in lower case, or lowered apart.
        apart = [chr(c) for c in range(128, NARROW) if c in self.lower or max(chr(c).lower()) >= chr(NARROW)]
        self.beyond = re.compile(f"[{''.join(apart)}{chr(NARROW)}-{chr(sys.maxunicode)}]")
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("steps", "states", "coded", "narrow", "wide", "beyond", "marks")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._fresh_caches()

    def allows(self, state: int, arc: int) -> bool:
        """Whether the arc leaves the state: follow row and column to their origins, each as it stood."""
        before = len(self.cut)
        while True:
            if self.cut.get(state << 32 | arc, before) < before:
                return False
            if self.born[state] < 0 and self.born[arc] < 0:
                return True
            if self.born[state] >= self.born[arc]:
                before, state = min(before, self.born[state]), self.right[state]
            else:
                before, arc = min(before, self.born[arc] + 1), self.left[arc]

    def read(self, word: bytes) -> list[int]:
        """The label ids of one pre-split word. Exactly one label that ends at a position may follow the
        state at its start, so the first one found, from the shortest, is the one."""
        end, longest, steps, spelled = len(word), self.longest, self.steps, self.inner
        if len(steps) >= CACHED_STEPS:
            steps.clear()
        # Short words share the states of their prefixes, which are known by their bytes.
        at = [word[:i] for i in range(end + 1)] if end <= SHARED else range(end + 1)
        states = self.states if end <= SHARED else {}
        if len(states) >= CACHED_PREFIXES:
            states.clear()
        known = end - 1
        while known and at[known] not in states:
            known -= 1
        for i in range(known + 1, end + 1):
            if i == end:
                spelled = self.final
            for start in range(i - 1, i - longest - 1 if i > longest else -1, -1):
                label = spelled.get(word[start:i])
                if label is None:
                    continue
                if not start:
                    break
                key = states[at[start]] << 32 | label
                allowed = steps.get(key)
                if allowed is None:
                    allowed = steps[key] = self.allows(key >> 32, label)
                if allowed:
                    break
            else:
                raise ValueError(f"no label ends at byte {i} of {word[:80]!r}")
            if i < end:
                states[at[i]] = label
        ids = [label]
        end -= self.size[label]
        while end:
            label = states[at[end]]
            ids.append(label)
            end -= self.size[label]
        return ids[::-1]

    def split(self, text: str) -> list[str]:
        """Normalised words of a text without special strings: composed, lower case, cut by the pattern."""
        if text.isascii():
            return self.narrow.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        if not self.beyond.search(text):
            return self.narrow.findall(text.lower())
        if self.wide is None:
            self.wide = word_pattern(self.pattern, self.classes, sys.maxunicode + 1)
        return self.wide.findall(text.translate(self.lower).lower())

    def encode(self, text: bytes) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, their labels joined by a space)."""
        found, said = [], []
        for part in slices(text.decode()):
            self.coded.long.clear()
            ids = self._ids(part)
            if ids:
                found.append(ids)
                said.append(self.decode(struct.unpack(f"<{len(ids) // 4}I", ids)))
        return b"".join(found), " ".join(said)

    def _ids(self, text: str) -> bytes:
        code = self.coded.__getitem__
        # None: no special string in the file; an empty mark may stand anywhere.
        if self.mark is None or self.mark and self.mark not in text:
            return b"".join(map(code, self.split(text)))
        return b"".join(
            struct.pack("<I", self.special[part]) if part in self.special else b"".join(map(code, self.split(part)))
            for part in self.marks.split(text)
        )

    def decode(self, ids) -> str:
        """The labels of the arcs, joined by a space: what a tokenizer file without a decoder asks for."""
        return " ".join(map(self.labels.__getitem__, ids))


def slices(text: str) -> Iterator[str]:
    """The text in pieces of about ``SLICE`` letters. A piece ends before ASCII white space, over which nothing is composed or joined."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + SLICE)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def load_automaton(path: str) -> Automaton:
    """Compile a tokenizer file of the kind: NFC, lower case, a splitting pattern, byte-level letters,
    merges with a word-end suffix, no decoder. Read on the driver; the tables are bounded by the file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if model["type"] != "BPE" or spec["decoder"] is not None or steps != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{path}: not a tokenizer of this kind")
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {a["content"]: a["id"] for a in spec["added_tokens"]}
    vocab = {k: i for k, i in model["vocab"].items() if k not in special}
    return Automaton(vocab, merges, model["end_of_word_suffix"] or "", special, pattern)


def encode_texts(docs: DataFrame, path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the column ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` (text).

    One pass without a shuffle. A null text counts as empty and gives no ids. Words of any length are
    read whole. Other columns are kept as they are, whatever their names, unless they have the name of a
    result, which then takes their place.
    """
    kept = [c for c in docs.columns if c.lower() not in (ids.lower(), decoded.lower())]
    text = fresh(docs, "whole_text")
    plain = docs.select(*[F.col(f"`{c}`") for c in kept], whole().alias(text))
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())])
    compiled = docs.sparkSession.sparkContext.broadcast(load_automaton(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled.value
        gc.disable()  # nothing here makes cycles, and going through the caches again and again is dear
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    found = [automaton.encode(t) for t in part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()]
                    new = [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=[*part.schema.names[:-1], ids, decoded])
        finally:  # a worker that waits for its next task holds no caches
            automaton._fresh_caches()
            gc.enable()

    return plain.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that each row's ``ids`` spell; null ids give a null text."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name.lower() != decoded.lower()], T.StructField(decoded, T.StringType())])
    compiled = df.sparkSession.sparkContext.broadcast(load_automaton(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            said = [None if b is None else compiled.value.decode(memoryview(b).cast("I")) for b in column]
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n.lower() != decoded.lower()]
            yield pa.RecordBatch.from_arrays([*[c for _, c in kept], pa.array(said, pa.string())], names=[*[n for n, _ in kept], decoded])

    return df.mapInArrow(run, schema)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    return encode_texts(docs.select("doc_id", "text"), path).select(
        "doc_id", F.expr("octet_length(token_ids) div 4").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
