"""Volumes landing in a folder, as a stream (an extension; batch runs need none of it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.session import ship


def landing_stream(spark: SparkSession, folder: str, pattern: str = "*.tif*") -> DataFrame:
    """File names and sizes as they land; contents are read by the batch that handles them."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")


def on_landing(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[str], None], pattern: str = "*.tif*", once: bool = True) -> StreamingQuery:
    """Call ``handle(path)`` for every file that lands, each once; the checkpoint survives restarts.

    A batch's file names come to the driver, which starts a distributed run for each.
    """
    ship(spark)

    def batch(found: DataFrame, _: int) -> None:
        for row in found.select("path").orderBy("path").toLocalIterator():
            handle(row["path"])

    writer = landing_stream(spark, folder, pattern).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
