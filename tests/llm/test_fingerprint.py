import hashlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import fingerprint
from tests.llm.tables import documents, empty


def test_edits_against_a_plain_loop(spark, tmp_path):
    docs = documents(spark, tmp_path)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
    want = []
    for k, (known, i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][2]
        half = len(t) // 2
        new = t[: len(t) - half] + following[:half]
        d, e, n = (fingerprint.digest(x.encode()) for x in (t, new, following))
        want.append((str(i if known else None), len(t), hashlib.sha256(new.encode()).hexdigest(), d.hex(), e.hex(), fingerprint.likeness(d, e), fingerprint.likeness(d, n)))
    for partitions in (1, 7):
        got = [tuple(r) for r in fingerprint.compare_edits(docs, partitions=partitions).collect()]
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_likeness_is_bounded_and_orders_edits():
    draw = np.random.default_rng(2)
    words = ["".join(draw.choice(list("abcdefgh"), 5)) for _ in range(400)]
    a, b = (" ".join(draw.choice(words, 300)) for _ in range(2))
    da, db, mixed = (fingerprint.digest(x.encode()) for x in (a, b, a[:900] + b[:900]))
    assert fingerprint.likeness(da, da) == 1
    assert 0 <= fingerprint.likeness(da, db) < fingerprint.likeness(da, mixed) < 1
    assert fingerprint.likeness(fingerprint.digest(b""), fingerprint.digest(b"abc")) < 1
    long = (a * 800).encode()
    assert len(long) > 1 << 20 and fingerprint.digest(long) == fingerprint.digest(long)


def test_columns_and_empty_table(spark, tmp_path):
    docs = fingerprint.fingerprint(documents(spark, tmp_path))
    assert docs.where(F.col("fingerprint").isNull()).count() == 0
    assert docs.select(fingerprint.likeness_of(F.col("fingerprint"), F.col("fingerprint")).alias("x")).where("x != 1").count() == 0
    assert fingerprint.compare_edits(empty(spark, tmp_path / "e")).collect() == []
