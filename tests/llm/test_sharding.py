import hashlib

from cohortry.llm.sharding import HASH_BITS, shards

from .data import documents


def brute(items, limit):
    """Split a bucket on one bit after the other."""
    out = {}

    def split(bucket, bits):
        total = sum(len(t) for _, _, t in bucket)
        if total <= limit or len({h for h, _, _ in bucket}) == 1:
            for h, i, _ in bucket:
                out[(h, i)] = (bits, total, len(bucket), total <= limit)
            return
        for bit in "01":
            part = [x for x in bucket if format(x[0], f"0{HASH_BITS}b")[len(bits)] == bit]
            if part:
                split(part, bits + bit)

    split(items, "")
    return out


def test_as_splitting_one_by_one(spark):
    pairs = [(i, "x" * (i * 37 % 90)) for i in range(400)] + [(None, None), (5, "y"), (5, "y"), (6, "z" * 5000), (7, "")]
    items = []
    for i, t in pairs:
        text = (t or "").encode()
        key = ":".join([*([str(i)] if i is not None else []), hashlib.md5(text).hexdigest()])
        items.append((int(hashlib.md5(key.encode()).hexdigest()[:15], 16), i, text))
    for limit in (10**9, 2000, 150):
        want = brute(items, limit)
        got = shards(documents(spark, *pairs), limit).collect()
        assert len(got) == len(pairs)
        by_id = sorted((str(r.doc_id), r.shard, r.shard_bytes, r.shard_rows, r.fits) for r in got)
        assert by_id == sorted((str(i), *want[(h, i)]) for h, i, _ in items)
        assert all(r.depth == len(r.shard) for r in got)


def test_equal_rows_share_a_shard(spark):
    got = shards(documents(spark, *[(1, "a" * 100)] * 5), 200).collect()
    assert len(got) == 5 and {(r.shard, r.fits) for r in got} == {("", False)}
    assert shards(documents(spark, (1, "a")).limit(0)).collect() == []
