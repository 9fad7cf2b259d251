"""The corpus pipeline: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, jaccard, mixing, quality, queries
from tessera.llm.common import drop_written, part_of_run, written

#: Documents under this probability of being good are rejected: unsure ones stay.
REJECT_BELOW = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (operator 9).

    A null or empty text is scored as a document without words; rows with null keys are
    scored like others, repeated rows alike. Without labels of both kinds all rows have one score,
    the share of good ones (0.5 without labels), so all stay or all go. Columns stay as they are.
    """
    model = queries.quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, name="_quality").where(F.col("_quality") >= REJECT_BELOW).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of equal texts stays, the one with the largest doc_id (operator 10).

    Null keys lose, of rows with the same key one stays; null and empty texts are equal. Columns stay as they are.
    """
    return exact_dedup.distinct_texts(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id (operator 5).

    Null keys lose, of rows with the same key the first stays; texts without words all stay. Columns stay as they are.
    """
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a row per pass, cut to what the mix takes (operator 7).

    Rows without words go, null sources are one source; n_chars is that of the text as cut. Other columns stay as they are.
    """
    return mixing.mixed_rows(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token sequences (operator 1).

    A null or empty text is its closing id alone; null keys pass through, repeated rows are packed as often as they occur.
    """
    return queries.packed_pieces(docs)


STAGES = [("quality classifier", keep_quality), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies), ("mixing sources", mix), ("packing", pack)]

#: SQL expresses neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    A stage's tables are deleted once the next stage's result is written; the last ones stay
    until ``drop_written``, because the result still reads them.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, this = None, uuid.uuid4().hex
    for n, (name, stage) in enumerate(STAGES):
        part = f"run-{this}-{n}"
        with part_of_run(spark, part):
            docs = stage(spark, docs, sf_dir)
            if n + 1 < len(STAGES):
                docs = written(docs, name.replace(" ", "-"))
                if before:
                    drop_written(spark, before)
                before = part
    return docs
