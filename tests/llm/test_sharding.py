import collections

from pyspark.sql import functions as F

from tessera.llm import queries, sharding
from tests.llm.tables import documents, empty


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_are_the_published_ones(spark):
    keys = [0, 1, 2, 7, -1, -(2**63), 2**63 - 1, *range(1000, 60000, 37)]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for r in rows.select("doc_id", sharding.jump_walk(F.col("doc_id"), 1, 16, 17, 100)["shards"].alias("s")).collect():
        assert r["s"] == [jump(r["doc_id"] % 2**64, n) for n in (1, 16, 17, 100)]


def test_slots_are_gapless_and_growth_moves_only_into_the_new_shard(spark, tmp_path):
    docs = documents(spark, tmp_path)
    out = sharding.assign_shards(docs, "doc_id", 16, order=("text",)).collect()
    assert len(out) == docs.count()
    slots = collections.defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
        assert r["shard"] == jump((r["doc_id"] or 0) % 2**64, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table(spark, tmp_path):
    assert sharding.assign_shards(empty(spark, tmp_path), "doc_id", 16).collect() == []


def test_query_has_no_python_in_its_plan(spark):
    plan = queries.op4_sharding(spark, "/root/testdata/sf0.01")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
