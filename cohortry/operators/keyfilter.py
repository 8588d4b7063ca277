"""Early reduction of events to the patients and codes that can matter, by semi joins and Bloom filters of their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import joins

# A stored word takes as much as ``joins.fits`` counts for a row of two numbers.
WORD_BYTES = 32
BITS_PER_KEY, LEAST_BITS_PER_KEY, HASHES = 16, 4, 4
_WORD, _MASK, _BITS = "_filter_word", "_filter_mask", "_filter_bits"


def _spot(key: Column, words: int) -> tuple[Column, Column]:
    """The word of 64 bits a key belongs to, and its bits there."""
    second = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(HASHES):
        bit = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(F.xxhash64(key), F.lit(words)), mask


def filter_words(keys: int, max_bytes: int | None = None) -> int | None:
    """Number of words for so many keys: 16 bits a key, fewer where the limit asks for it, none below 4 bits a key.

    About one key in a hundred passes wrongly at 16 bits a key, and less than half of them at 4.
    """
    limit = joins.MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    words = max(1, min(-(-keys * BITS_PER_KEY // 64), limit // WORD_BYTES))
    return words if words * 64 >= keys * LEAST_BITS_PER_KEY and words * WORD_BYTES <= limit else None


def early_filter(events: DataFrame, patients: DataFrame, key: str = "patid", max_bytes: int | None = None) -> DataFrame:
    """``events`` without most rows of other patients; no row of the given ones is lost, rows without a key are.

    The filter is a table of words, built by one aggregate of the distinct keys and broadcast; its size follows
    from their exact number and never exceeds ``max_bytes``. Where so small a filter would not help, events
    come back whole. A join with the patients still has to follow. ``patients`` is read twice, so it
    should be a stored table. Whole numbers of two widths are compared as numbers; for any other two types events
    come back whole, too, as only the join says what is equal then.
    """
    kinds = [df.schema[key].dataType for df in (events, patients)]
    whole = all(isinstance(t, T.IntegralType) for t in kinds)
    if not whole and kinds[0] != kinds[1]:
        return events
    unique = patients.select(F.col(key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    words = filter_words(unique.count(), max_bytes)
    if words is None:
        return events
    word, mask = _spot(F.col(key).cast("long") if whole else F.col(key), words)
    bits = unique.select(word.alias(_WORD), mask.alias(_MASK)).groupBy(_WORD).agg(F.bit_or(_MASK).alias(_BITS))
    # A semi join: where events are a join themselves, Spark moves it to the side that holds the key, before any shuffle.
    hit = (word == F.col(_WORD)) & (F.col(_BITS).bitwiseAND(mask) == mask)
    return events.filter(F.col(key).isNotNull()).join(F.broadcast(bits), hit, "left_semi")


def early_codes(events: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """``events`` without most rows whose code is not in the list; no listed row is lost. The join with the list still has to follow.

    Being a semi join, this is moved below the joins that events are made of, so that other rows are never shuffled. Distinct
    codes are broadcast where they fit, else a filter of them; codes of two types meet as text, as in ``join_codes``.
    """
    codes = codes.select("code")
    if joins.fits(codes) or joins.fits(codes.distinct()):
        return joins.join_codes(events, F.broadcast(codes.distinct()), code, "left_semi").select(*events.columns)
    return early_filter(events, codes.withColumnRenamed("code", code), code)


def early_semi(events: DataFrame, patients: DataFrame, key: str = "patid", max_bytes: int | None = None) -> DataFrame:
    """Events of the given patients, like ``patient_semi``: broadcast where the keys fit, else reduced by the filter
    before the shuffle that the exact join then needs."""
    keys = patients.select(key)
    if joins.fits(keys, max_bytes):
        return events.join(F.broadcast(keys), key, "left_semi").select(*events.columns)
    # A semi join would be moved below the filter, so the exact join is an inner one with distinct keys.
    return early_filter(events, keys, key).join(keys.distinct(), key).select(*events.columns)
