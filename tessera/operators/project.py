"""Projections and selections on voxel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXES = ("z", "y", "x")


def plane(volume: DataFrame, axis: str, index: int) -> DataFrame:
    """The page at one index of an axis; the other axes stay."""
    return volume.where(F.col(axis) == index).drop(axis)


def trim(volume: DataFrame, shape: tuple[int, int, int], edges: tuple[int, int, int]) -> DataFrame:
    """Voxels at least ``edges`` away from either end of each axis; coordinates stay absolute."""
    for name, n, t in zip(AXES, shape, edges, strict=True):
        if t < 0 or t >= n - t:
            raise ValueError(f"trimming {t} leaves nothing of axis {name} with {n}")
        volume = volume.where(F.col(name).between(t, n - t - 1)) if t else volume
    return volume


def stride(volume: DataFrame, factor: int, axes: tuple[str, ...] = ("y", "x")) -> DataFrame:
    """Every ``factor``-th voxel of the axes, from the first."""
    if factor < 1:
        raise ValueError("a stride is at least 1")
    for name in axes if factor > 1 else ():
        volume = volume.where(F.col(name) % factor == 0).withColumn(name, F.expr(f"{name} div {factor}"))
    return volume


def permute(volume: DataFrame, order: tuple[str, str, str]) -> DataFrame:
    """Axes renamed so that ``order`` becomes (z, y, x); no data moves."""
    rest = [c for c in volume.columns if c not in AXES]
    return volume.select(*[F.col(old).alias(new) for old, new in zip(order, AXES, strict=True)], *rest)


def component(volume: DataFrame, t: int, p: int, c: int) -> DataFrame:
    """The 3-D view of a six-axis array at one (t, p, c)."""
    return volume.where((F.col("t") == t) & (F.col("p") == p) & (F.col("c") == c)).drop("t", "p", "c")


def concat_depth(volumes: DataFrame) -> DataFrame:
    """Volumes (``volume_id``) stacked along z in name order.

    A volume's first plane follows the last of the one before; the running sum
    goes over one row per volume.
    """
    from pyspark.sql import Window

    depth = volumes.groupBy("volume_id").agg((F.max("z") + 1).alias("n"))
    before = Window.orderBy("volume_id").rowsBetween(Window.unboundedPreceding, -1)
    first = depth.select("volume_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return volumes.join(first, "volume_id").select("volume_id", (F.col("z") + F.col("first")).alias("z"), "y", "x", "v")


def plane_shapes(volumes: DataFrame) -> DataFrame:
    """Distinct (y, x) sizes of the volumes; stacking needs exactly one."""
    sizes = volumes.groupBy("volume_id").agg((F.max("y") + 1).alias("ny"), (F.max("x") + 1).alias("nx"))
    return sizes.groupBy("ny", "nx").agg(F.count("*").alias("volumes"))
