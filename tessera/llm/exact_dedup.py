"""Exact dedup as a stateful stream.

Digests flow through a streaming query whose keyed state (RocksDB, on disk, never
expired) retains per digest the largest stable identifier with its content
locator and the number of rows. Every row whose digest was hit is then compared,
byte by byte, with the row that stays.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh_path, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of one digest that one keeper's copy is compared with in a task.
SALT_ROWS = 2_000


#: The state lives in RocksDB on the executors' disks; its caches and write buffers share one bounded pool.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a store's memory goes with its task, not with a maintenance run while later stages are at work
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


@contextmanager
def _state_on_disk(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_groups(keyed: DataFrame, files_per_trigger: int = 1000) -> DataFrame:
    """Run the stateful stream over written rows (``digest``, ``key``, ``locator``).

    Returns ``digest``, ``keep`` (key and locator of the row that stays) and ``n``.
    Map tasks combine the rows of a digest before the shuffle, so a digest
    with a third of all rows reaches its state as one row per map task. The
    state's updates of each batch go to a table, under the batch's number, so a
    replayed batch replaces its own; counts only grow, so the maximum is final.
    """
    spark = keyed.sparkSession
    source, sink, state = fresh_path(spark, "dedup-rows"), fresh_path(spark, "dedup-groups"), fresh_path(spark, "dedup-state")
    keyed.write.parquet(source)
    stream = spark.readStream.schema(keyed.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    groups = stream.groupBy("digest").agg(F.max(F.struct("key", "locator")).alias("keep"), F.count("*").alias("n"))

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    with _state_on_disk(spark):
        query = groups.writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(save).trigger(availableNow=True).start()
        query.awaitTermination()
    schema = groups.schema
    written_any = spark.read.schema(schema).option("basePath", sink).parquet(f"{sink}/batch=*") if query.lastProgress else spark.createDataFrame([], schema)
    return written_any.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("n").alias("n"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Column | None = None) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` added.

    Null texts count as empty; texts are compared as they are. Of equal texts
    the row with the largest key stays (null keys lose; of rows with the same
    key one stays). ``digest`` (of the columns of ``docs``) may replace SHA-256 as the
    state's key; the byte comparison fails the job if different texts ever share it. An
    empty table gives an empty table; columns named like the added ones are replaced,
    others may have any names. ``docs`` must list its rows in the same order each time
    it is read, as files do; the job fails if it does not.
    """
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    marked = _marked(docs, key, text, digest)
    sha = F.lower(F.hex("digest")) if digest is None else F.sha2(F.coalesce("t", F.lit("")), 256)
    added = [F.col("keep_id"), F.col("group_size").cast("long").alias("group_size"), F.col("kept"), sha.alias("text_sha256")]
    return marked.select(*_unpacked(docs, text), *added)


def _unpacked(docs: DataFrame, text: str) -> list[Column]:
    return [F.col("t").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]


def _marked(docs: DataFrame, key: str, text: str, digest: Column | None = None) -> DataFrame:
    """``k``, ``t``, ``row`` (the other columns), ``digest``, ``locator`` and what the state says of each row."""
    rest = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c != text])
    sha = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)) if digest is None else digest
    located = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), rest.alias("row"), sha.alias("digest"), F.monotonically_increasing_id().alias("locator"))
    groups = stream_groups(located.select("digest", F.col("k").alias("key"), "locator"))
    groups = written(groups.select(F.col("digest").alias("of"), F.col("keep.key").alias("keep_id"), F.col("keep.locator").alias("kept_at"), F.col("n").alias("group_size")), "dedup-final")
    marked = located.join(groups, F.col("digest") == F.col("of")).drop("of").withColumn("kept", F.col("locator") == F.col("kept_at"))
    return _compared(marked)


def _compared(marked: DataFrame) -> DataFrame:
    """Check every hit's bytes against the row that stays; fail on a difference.

    Only rows with copies are compared; they are written first, so the whole
    table's texts are shuffled once. The keeper's row is repeated once per
    ``SALT_ROWS`` rows of its group, so the hottest group spreads over many tasks.
    """
    whole = F.coalesce("t", F.lit(""))
    salts = F.expr(f"group_size div {SALT_ROWS} + 1")
    hit = written(marked.where("group_size > 1"), "dedup-hits")
    keepers = hit.where("kept").select(F.col("kept_at").alias("keeper"), whole.alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("part"))
    salted = hit.withColumn("salt", F.pmod(F.col("locator"), salts))
    checked = salted.join(keepers, (F.col("kept_at") == F.col("keeper")) & (F.col("salt") == F.col("part")), "left")
    problem = F.when(F.col("other").isNull(), "docs changed its order between two reads").otherwise("two different texts share a digest")
    same = F.when(whole == F.col("other"), F.col("kept")).otherwise(F.raise_error(problem).cast("boolean"))
    return marked.where("group_size = 1").withColumn("kept", F.lit(True)).unionByName(checked.withColumn("kept", same).select(*marked.columns))


def distinct_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the rows that stay, with the columns of ``docs`` as they are, whatever their names; else as ``dedup``."""
    return _marked(docs, key, text).where("kept").select(*_unpacked(docs, text))
