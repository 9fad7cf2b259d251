import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup
from tests.llm.tables import documents, empty


def test_groups_and_survivors(spark, tmp_path):
    docs = documents(spark, tmp_path)
    out = exact_dedup.dedup(docs).collect()
    rows = docs.collect()
    assert len(out) == len(rows)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    kept = collections.Counter()
    for r in out:
        own = groups[r["text"] or ""]
        known = [i for i in own if i is not None]
        assert r["group_size"] == len(own)
        assert r["keep_id"] == (max(known) if known else None)
        assert r["text_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            kept[r["text"] or ""] += 1
    assert kept == {t: 1 for t in groups}


def test_bytes_are_checked_on_hits(spark, tmp_path):
    docs = documents(spark, tmp_path)
    weak = exact_dedup.dedup(docs, digest=F.substring(F.coalesce(F.col("text"), F.lit("")), 1, 1).cast("binary"))
    with pytest.raises(Exception, match="share a digest"):
        weak.collect()


def test_state_carries_over_micro_batches(spark, tmp_path):
    rows = spark.range(200).selectExpr("cast(cast(id % 17 as string) as binary) as digest", "id as key", "id as locator").repartition(6)
    groups = {bytes(r["digest"]): (r["keep"]["key"], r["n"]) for r in exact_dedup.stream_groups(rows, files_per_trigger=1).collect()}
    want = {str(d).encode(): (max(i for i in range(200) if i % 17 == d), len(range(d, 200, 17))) for d in range(17)}
    assert groups == want


def test_empty_table(spark, tmp_path):
    assert exact_dedup.dedup(empty(spark, tmp_path)).collect() == []
    assert exact_dedup.distinct_texts(documents(spark, tmp_path / "x")).columns == documents(spark, tmp_path / "y").columns
