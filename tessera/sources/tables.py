"""Volumes over the driver's Parquet tables, in voxel form (z, y, x, v)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of the embedding volume's planes.
PLANE_ROWS = 25
WIDTH = 64
#: Voxels of a grid that one task makes.
RUN = 1 << 24


def embedding_volume(spark: SparkSession, sf_dir: str, raw: bool = False, planes: tuple[int, int] | None = None) -> DataFrame:
    """Vectors as image rows: z, y from the id, x the position; v scaled to counts, or raw.

    ``planes`` = (from, to) reads those planes only: the range is one of the stored
    ids, so it prunes row groups, which a filter on the computed z can't.
    """
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    if planes is not None:
        rows = rows.where((F.col("vec_id") >= planes[0] * PLANE_ROWS) & (F.col("vec_id") < planes[1] * PLANE_ROWS))
    rows = rows.select("vec_id", F.posexplode("embedding").alias("x", "e"))
    value = F.col("e").cast("double")
    return rows.select(
        F.expr(f"vec_id div {PLANE_ROWS}").alias("z"), (F.col("vec_id") % PLANE_ROWS).alias("y"), F.col("x").cast("long").alias("x"),
        (value if raw else F.rint((value + 1) * 10000)).alias("v"),
    )


def embedding_lines(spark: SparkSession, sf_dir: str, step: int = 1) -> DataFrame:
    """The lines of the embedding volume that there are (z, y, known), at every ``step``-th voxel of y and x."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("embedding IS NOT NULL")
    known = F.filter(F.transform("embedding", lambda e: F.struct(F.when(e.isNotNull(), True).alias("there"))), lambda _, i: i % step == 0)["there"]
    rows = rows.select(F.expr(f"vec_id div {PLANE_ROWS}").alias("z"), (F.col("vec_id") % PLANE_ROWS).alias("y"), known.alias("known"))
    return rows.where(F.col("y") % step == 0).withColumn("y", F.expr(f"y div {step}"))


def candidate_volume(volume: DataFrame) -> DataFrame:
    """A slightly different volume to compare with."""
    return volume.select("z", "y", "x", (F.col("v") + (F.col("z") + F.col("y") + F.col("x")) % 3).alias("v"))


def embedding_shape(spark: SparkSession, sf_dir: str) -> tuple[int, int, int]:
    """Shape from the ids' maximum, a metadata-sized scan of one column."""
    top = spark.read.parquet(f"{sf_dir}/embeddings.parquet").agg(F.max("vec_id")).first()[0]
    return int(top) // PLANE_ROWS + 1, PLANE_ROWS, WIDTH


def label_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One volume per label: volume_id, and z numbers the label's vectors."""
    from pyspark.sql import Window

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    z = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    rows = rows.select(F.format_string("volume_%02d.tif", F.col("label")).alias("volume_id"), z.cast("long").alias("z"), "embedding")
    return rows.select("volume_id", "z", F.lit(0).cast("long").alias("y"), F.posexplode("embedding").alias("x", "e")).select("volume_id", "z", "y", F.col("x").cast("long").alias("x"), F.rint((F.col("e").cast("double") + 1) * 10000).alias("v"))


def lineitem_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines rastered into (7, 64, 64), summed and densified with zeros."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cells = rows.groupBy((F.col("l_linenumber") - 1).cast("long").alias("z"), (F.col("l_orderkey") % 64).alias("y"), (F.col("l_partkey") % 64).alias("x")).agg(F.sum("l_quantity").alias("v"))
    return dense(cells, (7, 64, 64))


def synthetic_volume(spark: SparkSession, shape: tuple[int, int, int]) -> DataFrame:
    z, y, x = shape
    i = F.col("id")
    grid = spark.range(z * y * x).select(F.expr(f"id div {y * x}").alias("z"), F.expr(f"id div {x} % {y}").alias("y"), (i % x).alias("x"))
    return grid.withColumn("v", ((F.col("z") * 7919 + F.col("y") * 104729 + F.col("x") * 1299709) % 65536).cast("double"))


def grid(spark: SparkSession, shape: tuple[int, int, int]) -> DataFrame:
    """All coordinates of a shape, at most ``RUN`` to a task."""
    z, y, x = shape
    return spark.range(0, z * y * x, 1, max(spark.sparkContext.defaultParallelism, -(-z * y * x // RUN))).select(F.expr(f"id div {y * x}").alias("z"), F.expr(f"id div {x} % {y}").alias("y"), (F.col("id") % x).alias("x"))


def dense(cells: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Every voxel of the shape, 0 where the table has none."""
    return grid(cells.sparkSession, shape).join(cells, ["z", "y", "x"], "left").select("z", "y", "x", F.coalesce("v", F.lit(0.0)).alias("v"))
