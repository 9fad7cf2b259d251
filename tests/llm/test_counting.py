import collections

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import counting
from tessera.llm.hashing import mix


def keys_of(data, offsets):
    """Two tables: a hash of each byte value, and one of each pair of neighbours, whatever text they are in."""
    one = mix(data.astype(np.uint64))
    return [one, mix(data[:-1].astype(np.uint64) * np.uint64(256) + data[1:]) if len(data) else one]


def finish(ids, data, offsets, tables):
    found = [totals[np.searchsorted(own, k)] for (own, totals), k in zip(tables, keys_of(data, offsets), strict=True)]
    out = [[int(n) for n in found[0][a:b]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return [ids, out, [int(found[1].sum())] * len(ids)]


@pytest.mark.parametrize(("buckets", "limit"), [(2, 10**6), (64, 7), (None, 10**6), (1 << 16, 10**6), (1 << 17, 10**6), (1 << 20, 1)])
def test_against_a_plain_count(spark, tmp_path, buckets, limit):
    draw = np.random.default_rng(3)
    texts = [bytes(draw.integers(0, 250, draw.integers(0, 60)).astype(np.uint8)) for _ in range(60)] + [None, b"", b"\x00" * 700]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, data binary").repartition(3)
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    types = [pa.int64(), pa.list_(pa.int64()), pa.int64()]
    got = counting.count_and_finish(rows, keys_of, finish, "id long, often array<bigint>, pairs long", types, buckets, block_bytes=500, bucket_keys=limit).collect()
    count = collections.Counter(b for t in texts for b in t or b"")
    assert sorted((r["id"], r["often"]) for r in got) == [(i, [count[b] for b in t or b""]) for i, t in enumerate(texts)]


def test_a_bucket_on_disk_answers_as_in_memory():
    draw = np.random.default_rng(5)
    packets = [counting.distinct(draw.integers(0, 400, draw.integers(0, 90)).astype(np.uint64) << np.uint64(55)) for _ in range(50)]
    packets += [counting.distinct(np.array([0, 2**64 - 1], np.uint64))]
    count = collections.Counter()
    for keys, counts in packets:
        count.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    for limit in (1, 50, 333, 10**6):
        bucket = counting.Bucket(limit)
        for keys, counts in packets:
            bucket.add(keys, counts)
        got = [a.tolist() for a in bucket.answers(3)]
        assert got == [[count[k] if count[k] >= 3 else 0 for k in keys.tolist()] for keys, _ in packets]


def test_keys_keep_all_their_bits():
    for bits in (1, 6, 10, 16, 20):
        base = np.uint64(3 % (1 << bits)) << np.uint64(64 - bits)
        keys = np.sort(np.random.default_rng(bits).integers(0, 1 << (64 - bits), 1000, dtype=np.uint64)) + base
        keys[0], keys[-1] = base, base + np.uint64((1 << (64 - bits)) - 1)
        assert (counting._unpack_keys(counting._pack_keys(keys, base), base) == keys).all()


def test_packets_hold_some_kb_at_any_size():
    for size in (1, 1 << 30, 1 << 36, 1 << 40, 10**14):
        buckets = counting.buckets_for(size)
        assert buckets & (buckets - 1) == 0
        assert size < 1 << 30 or 8 * (counting.BLOCK_BYTES // 10) // buckets > 4_000  # a block of 8 MB has some 800,000 keys of an order
        assert size < counting.TASK_BYTES * 16 or counting.tasks_for(size) <= size // counting.TASK_BYTES
    assert counting.tasks_for(10**14) < 10**6


def test_blocks_without_keys(spark):
    rows = spark.createDataFrame([(1, b""), (2, None), (None, b"")], "id long, data binary").repartition(3)
    types = [pa.int64(), pa.list_(pa.int64()), pa.int64()]
    got = counting.count_and_finish(rows, keys_of, finish, "id long, often array<bigint>, pairs long", types).collect()
    assert sorted((r["id"] or 0, r["often"]) for r in got) == [(0, []), (1, []), (2, [])]
