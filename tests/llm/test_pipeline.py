import os

import pytest

import corpus_pipeline
from tessera.llm import common, queries
from tessera.llm.common import written
from tests.llm.tables import documents, empty

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
        yield name, docs


def test_stages_keep_columns_and_add_up(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for n, (_, out) in enumerate(stages(spark, docs, SF)):
        if n < 4:
            assert out.columns == columns
        if n < 3:
            assert out.count() <= before
            before = out.count()
        if n == 1:
            assert out.select("text").distinct().count() == before
    assert out.agg({"length": "max"}).first()[0] <= 1024


@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_awkward_and_empty_documents(spark, tmp_path, rows):
    docs = documents(spark, tmp_path) if rows == "awkward" else empty(spark, tmp_path)
    spark.createDataFrame([(1, 1, 0), (None, 0, None), (4, None, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for n, (_, out) in enumerate(stages(spark, docs, str(tmp_path))):
        if n < 4:
            assert out.columns == docs.columns
            assert out.where("not kept or shard != 5 or score != 0.5").count() == 0
        if rows == "none":
            assert out.count() == 0
        elif n == 0:
            assert out.count() == docs.count()  # nothing to learn from: all documents pass
    assert rows == "none" or out.count() > 0


def test_run_gives_the_last_stage(spark):
    common.drop_written(spark)
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "ids_crc32", "sequence_id"} <= set(out.columns) and out.count() > 0
    folder = common._own_folder(spark).removeprefix("file:").replace("//", "/")
    assert [n[-2:] for n in os.listdir(folder)] == ["-3"]  # earlier stages' tables went when the next one's were written


def test_registered_names():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x[: x.index("_") + 1] for x in names if x.startswith("op")}
    assert "pipeline" in names and set(queries.ORACLES) <= names
    assert set(__spark_entry__.oracle_sql()) <= names
