import zlib

import numpy as np
import pytest

from tessera.llm import quality
from tests.llm.tables import documents, empty

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels.where(~quality.held_out(labels["doc_id"])))
    got = quality.score(docs, model).join(labels, "doc_id").where(quality.held_out(labels["doc_id"])).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    score, label = np.array([r["score"] for r in got]), np.array([r["quality"] for r in got])
    good, bad = score[label == 1], score[label == 0]
    assert (good[:, None] > bad).mean() > 0.98
    assert ((score >= 0.7) == label).mean() > 0.95
    again = quality.fit(docs, labels.where(~quality.held_out(labels["doc_id"])))
    assert np.allclose(again.layers[2], model.layers[2])


def test_awkward_rows_and_labels(spark, tmp_path):
    docs = documents(spark, tmp_path)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (7, None, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    assert model.constant is not None  # too few to train on
    many = spark.createDataFrame([(i * 3 + 1, int(i % 3 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out = quality.score(docs, quality.fit(docs, many))
    assert out.columns == [*[c for c in docs.columns if c != "score"], "score"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "")}) == 1


def test_empty_table(spark, tmp_path):
    none = empty(spark, tmp_path)
    model = quality.fit(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert model.constant == 0.5
    assert quality.score(none, model).collect() == []


@pytest.mark.parametrize("text", [b"", b"   ", b"a", b"ab12 ###\n\nx"])
def test_tokens_are_runs_of_a_class(text):
    ids, at = quality.tokens(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert at.tolist() == [0, {b"": 0, b"   ": 0, b"a": 1, b"ab12 ###\n\nx": 5}[text]]
