"""The registered ``opN_*`` queries: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, fingerprint, jaccard, lm_scoring, mixing, packing, quality, repair, repeats, sharding, top_k, url_filter, variants
from tessera.llm.sql import ORACLES  # noqa: F401  registered beside the queries

#: Rules of the URL query as (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(documents(spark, sf_dir))


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_documents(documents(spark, sf_dir))
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return fingerprint.compare_edits(docs, partitions=fingerprint.runs_for(docs))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.assign_shards(rows, "doc_id", 16, order=("size", "text_crc32"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(documents(spark, sf_dir))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).drop("url")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(documents(spark, sf_dir))
    return mix.select("doc_id", "size", "source_size", "target", "taken", mixing.shard_words(F.col("passes")).alias("shard_words"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    return quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs.select("doc_id", F.col("text").alias("whole")), model, "whole")
    return scored.select("doc_id", F.coalesce(quality.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.count_words(documents(spark, sf_dir)))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with every way to break them: by the checksum of a row's key it goes, loses its text, its stops or its role, or stands twice."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    what = F.crc32(F.concat_ws(":", *spaced).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), what.alias("what")).where("what != 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies)).drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair.repair(damaged(rows))
    every = rows.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    joined = repair.joined_on_conv(repair.joined_on_conv(every, found.summary), repair.repaired_digests(found.turns, found.audits))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_lm_scoring, op3_fingerprint, op4_sharding, op5_jaccard_join, op6_url_filter, op7_mixing, op8_suffix_dedup, op9_quality, op10_exact_dedup, op11_top_k_search, op12_spelling_variants, op13_conversation_repair)
}
