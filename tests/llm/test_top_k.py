import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import queries, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, id long, row string, g int, block string, kth double"


def table(spark, tmp_path, rows):
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame([(i, v, 1, 5, "r", 2, "b", 0.5) for i, v in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def expected(rows, k=10, every=100):
    """(query_id, rank, vec_id, score); rows: (vec_id, vector) as the table has them."""
    use = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, qv) in enumerate(use):
        if q is None or q % every:
            continue
        scored = [(-max(top_k.LEAST, min(top_k.MOST, sum(a * b for a, b in zip(qv, v, strict=False)))), i is None, i or 0, i) for m, (i, v) in enumerate(use) if m != n]
        out += [(q, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def vectors(seed, n, dims=6):
    draw = random.Random(seed)
    near = [draw.gauss(0, 1) for _ in range(dims)]
    rows = []
    for i in range(n):
        kind = draw.randrange(6)
        v = [draw.gauss(0, 1) for _ in range(dims)] if kind < 3 else near if kind == 3 else [x + draw.gauss(0, 0.01) for x in near] if kind == 4 else [draw.choice([-1.0, 0.0, 0.5]) for _ in range(dims)]
        rows.append((i, v))
    rows += [(None, near), (None, [1.0] * dims), (300, None), (400, [None, *near[1:]]), (500, [math.nan, *near[1:]]), (600, [math.inf] * dims), (700, []), (800, near[:3]), (900, near), (900, near), (-100, near), (3, near)]
    return rows


@pytest.mark.parametrize(("block", "group", "stripe"), [(512, 1024, 32), (16, 3, 2), (1, 1, 1)])
def test_against_brute_force(spark, tmp_path, monkeypatch, block, group, stripe):
    for name, value in (("BLOCK", block), ("GROUP", group), ("CHUNK", 5), ("STRIPE_BLOCKS", stripe), ("RANGE", 100)):
        monkeypatch.setattr(top_k, name, value)
    docs = table(spark, tmp_path, vectors(block, 450))
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect()]
    got = top_k.top_k(docs, every=20)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, every=20)


def test_fewer_rows_than_k_and_the_query(spark, tmp_path):
    docs = table(spark, tmp_path, [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (100, [-1.0, 3.0])])
    want = expected([(r["vec_id"], r["embedding"]) for r in docs.collect()])
    assert len(want) == 4
    assert sorted((tuple(r) for r in queries.op11_top_k_search(spark, str(tmp_path)).collect()), key=str) == want


def test_values_beyond_doubles_and_longs_are_exact_or_the_longs_ends(spark, tmp_path):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 0.001]), (2, [3e7, 0.0]), (100, [3e38, 1.0]), (4, [-3e38, 1.0]), (5, [1e5, 7.0])]
    docs = table(spark, tmp_path, rows)
    assert sorted((tuple(r) for r in top_k.top_k(docs).collect()), key=str) == expected([(r["vec_id"], r["embedding"]) for r in docs.collect()])


def test_bounds_hold_and_leave_out_blocks(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(0)
    for _ in range(50):
        v = np.floor(draw.standard_normal((20, 5)) * 100)
        q = np.floor(draw.standard_normal((4, 5)) * 100)
        assert (top_k.bounds(q, v.min(axis=0)[None], v.max(axis=0)[None])[:, 0] >= top_k.scores(q, v).max(axis=1)).all()
    monkeypatch.setattr(top_k, "BLOCK", 20)
    centres = draw.standard_normal((10, 8)) * 5
    rows = [(i, [float(x) for x in centres[i % 10] + draw.standard_normal(8) * 0.01]) for i in range(1000)]
    index = top_k._blocks(table(spark, tmp_path, rows), "vec_id", "embedding", 1024.0)
    groups = top_k._groups(index, 100, 5)
    monkeypatch.setattr(top_k, "GROUP", 1)
    pairs = top_k._groups(index, 100, 5).count() * index.count()
    assert groups.count() and top_k._wanted(index, top_k._groups(index, 100, 5), index.count()).count() < pairs / 2


def test_forward_index_keeps_its_numbers():
    for most in (5, 40_000, 3e9, 1e300):
        v = np.floor(np.random.default_rng(1).standard_normal((7, 3)) * most)
        assert (top_k.unpacked(top_k.packed(v), 7) == v).all()
    use, out = top_k.whole_vectors(pa.array([[1.0], None, [], [0.5, -0.0005]], pa.list_(pa.float64())).slice(1), 1024.0)
    assert use.tolist() == [1, 2] and out.tolist() == [[0, 0], [512, -1]]


def test_empty_table(spark, tmp_path):
    table(spark, tmp_path, [])
    assert queries.op11_top_k_search(spark, str(tmp_path)).collect() == []
