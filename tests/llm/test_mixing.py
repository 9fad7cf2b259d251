import re

import pytest

from tessera.llm import mixing
from tests.llm.tables import documents, empty


def heap_free(targets, limits, seats):
    got = [0] * len(targets)
    for _ in range(min(seats, sum(n for n, t in zip(limits, targets, strict=True) if t > 0))):
        best = max((i for i in range(len(targets)) if got[i] < limits[i] and targets[i] > 0), key=lambda i: (targets[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def test_apportionment_seat_by_seat(spark):
    import random

    draw = random.Random(1)
    for _ in range(6):
        n = draw.randint(1, 9)
        targets = [float(draw.choice([0, 1, 2, 3, 5, 10, 33])) for _ in range(n)]
        limits = [draw.randint(0, 12) for _ in range(n)]
        goals = sorted(draw.randint(0, 40) for _ in range(3))
        table = spark.createDataFrame(list(zip(range(n), targets, limits, strict=True)), "pos long, target double, seats long")
        got = {r["pos"]: r["quotas"] for r in mixing.with_quotas(table, goals).collect()}
        assert [[got[i][k] for i in range(n)] for k in range(3)] == [heap_free(targets, limits, g) for g in goals]


def test_water_level_shares_excess_by_weight(spark):
    def level(caps, weights, total):
        return mixing.water_level(spark.createDataFrame(list(zip(map(float, caps), map(float, weights), strict=True)), "cap double, weight double"), total)

    assert level([10, 100, 100], [3, 1, 2], 66) == pytest.approx(56 / 3)
    assert level([1, 1], [1, 1], 10) == float("inf")
    assert level([0, 4], [1, 1], 3) == 3


def test_plan_of_many_sources(spark):
    """More sources than a driver table should hold; many have the same size, so quotients tie."""
    n = 12_000
    totals = spark.range(n).selectExpr("concat('site', lpad(id, 6, '0')) as source", "100 + (id % 5) * 300 as source_size")
    rows = mixing.plan_mix(totals, (3, 1, 2), 1.5, 2, 128, 16, 7).orderBy("source").collect()
    total = sum(r["source_size"] for r in rows)
    assert len(rows) == n and sum(r["target"] for r in rows) == pytest.approx(1.5 * total)
    seats = int(1.5 * total / 128 + 0.5)
    for k in (0, 7, 15):
        assert sum(r["quotas"][k] for r in rows) == seats * (k + 1) // 16
    level = max(r["target"] / w for r, w in zip(rows, [3, 1, 2] * (n // 3), strict=True))
    for r, w in zip(rows, [3, 1, 2] * (n // 3), strict=True):
        assert r["target"] == pytest.approx(min(2 * r["source_size"], level * w))
        assert r["quotas"] == sorted(r["quotas"]) and abs(r["quotas"][-1] - r["target"] / 128) <= 1


def test_mix_comes_near_targets_and_reruns_agree(spark, tmp_path):
    docs = documents(spark, tmp_path)
    first = mixing.mix_sources(docs, block_words=16).collect()
    again = mixing.mix_sources(docs.repartition(5), block_words=16).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert len(first) == docs.count()
    sizes = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect())
    assert sorted(r["size"] for r in first) == sizes
    by: dict = {}
    for r in first:
        assert 0 <= r["taken"] <= 2 * r["size"]
        own = by.setdefault(r["source"], [r["target"], 0, r["source_size"], 0])
        own[1] += r["taken"]
        own[3] += r["size"]
    for target, taken, size, total in by.values():
        assert size == total and abs(taken - target) <= 3 * 16
    assert sum(t for t, *_ in by.values()) == pytest.approx(1.5 * sum(sizes))


def test_shards_hold_their_quotas(spark, tmp_path):
    """What the rows give each shard of each source is the plan's quota of blocks, less what the last block of a source lacks."""
    docs = documents(spark, tmp_path)
    rows = mixing.mix_sources(docs, block_words=16).collect()
    sizes: dict = {}
    taken: dict = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        for spans in r["passes"]:
            for x in spans:
                taken[r["source"], x["shard"]] = taken.get((r["source"], x["shard"]), 0) + x["end"] - x["start"]
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for r in mixing.plan_mix(totals, (3, 1, 2), 1.5, 2, 16, 16, 7).collect():
        quotas = [b - a for a, b in zip([0, *r["quotas"]], r["quotas"], strict=False)]
        for k, quota in enumerate(quotas):
            assert 0 <= 16 * quota - taken.get((r["source"], k), 0) < 2 * 16


def test_hot_keys_and_any_names(spark):
    """A third of the rows have one key, others none; the operator's own names are taken by the table's columns."""
    rows = [("row" if i % 3 else None, f"w{i} " * (i % 50), f"s{i % 2}", i) for i in range(300)]
    docs = spark.createDataFrame(rows, "k string, t string, size string, row int")
    first = mixing.mix_sources(docs, "t", "size", "k", block_words=16)
    assert first.count() == 300
    out = mixing.mixed_rows(docs.repartition(7), "t", "size", "k", block_words=16)
    assert out.columns == docs.columns
    assert sum(len(r["t"].split()) for r in out.collect()) == first.agg({"taken": "sum"}).first()[0]


def test_rows_of_the_mix(spark, tmp_path):
    docs = documents(spark, tmp_path)
    taken = sum(r["taken"] for r in mixing.mix_sources(docs, block_words=16).collect())
    rows = mixing.mixed_rows(docs, block_words=16)
    assert rows.columns == docs.columns
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows.collect()]
    assert sum(words) == taken


def test_empty_table(spark, tmp_path):
    assert mixing.mix_sources(empty(spark, tmp_path)).collect() == []
