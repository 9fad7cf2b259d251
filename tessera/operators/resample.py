"""Resampling of voxel tables: shear, depth interpolation, rotation, top view, affine, pyramid."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import SUPPORT, snapped, to_range
from tessera.functions.geometry import Affine, TopView, level_size
from tessera.sources.tables import grid


def offset_table(spark: SparkSession, view: TopView) -> DataFrame:
    """Shift of every plane: one row per plane, so it may be broadcast."""
    return spark.createDataFrame(pd.DataFrame({"z": range(view.z), "o": view.offsets}), "z long, o long")


def sheared(volume: DataFrame, view: TopView) -> DataFrame:
    """The volume in the sheared frame: each plane moves along y; only voxels with a source are listed."""
    offsets = offset_table(volume.sparkSession, view)
    return volume.join(F.broadcast(offsets), "z").select("z", (F.col("y") + F.col("o") + view.margin).alias("y"), "x", "v")


def neighbour_mean(volume: DataFrame, saturated: bool = False) -> DataFrame:
    """Mean of each voxel with the next deeper one at its place; one without any below it stays, as in the last plane.

    ``saturated``: in unsigned 16-bit numbers, whose sum stops at 65535 and whose halves go up.
    """
    deeper = F.lead("v").over(Window.partitionBy("y", "x").orderBy("z"))
    both = F.col("v") + deeper
    mean = to_range(F.least(both, F.lit(65535.0)) / 2, "half_up") if saturated else 0.5 * both
    return volume.withColumn("v", F.when(deeper.isNull(), F.col("v")).otherwise(mean))


def depth_map(spark: SparkSession, view: TopView) -> DataFrame:
    """Source planes and weight of each output plane."""
    rows = [(k, *view.depth(k)) for k in range(view.scaled_z)]
    return spark.createDataFrame(rows, "z long, z0 long, z1 long, w double")


def depth_resized(volume: DataFrame, view: TopView, antialias: bool = False) -> DataFrame:
    """Linear interpolation in depth: a weighted sum per output voxel, combined before the shuffle.

    A voxel needs both of its source voxels; where one is absent the output has none.

    ``antialias``: where depth shrinks, over all source planes under a triangle as wide as the
    output's spacing, mirrored at the ends; the tap table is still bounded by the source's depth.
    """
    source = volume.withColumnRenamed("z", "sz")
    if antialias:
        rows = [(k, p, w) for k in range(view.scaled_z) for p, w in view.smoothed_depth(k)]
        wide = volume.sparkSession.createDataFrame(rows, "z long, sz long, c double")
        return source.join(F.broadcast(wide), "sz").groupBy("z", "y", "x").agg(F.sum(F.col("c") * F.col("v")).alias("v"))
    rows = []
    for k in range(view.scaled_z):
        z0, z1, w = view.depth(k)
        rows += [(k, z0, 1.0, 1)] if z0 == z1 else [(k, z0, 1.0 - w, 2), (k, z1, w, 2)]
    taps = volume.sparkSession.createDataFrame(rows, "z long, sz long, c double, n int")
    found = source.join(F.broadcast(taps), "sz").groupBy("z", "y", "x").agg(F.sum(F.col("c") * F.col("v")).alias("v"), F.count("v").alias("known"), F.count("*").alias("found"), F.max("n").alias("n"))
    return found.where("found = n").select("z", "y", "x", F.when(F.col("known") == F.col("n"), F.col("v")).alias("v"))


def _looked_up(view: TopView) -> tuple[F.Column, F.Column]:
    """Nearest source row and column of a cell (y, x) of the sheared frame, rotated about its centre, half-even."""
    cy, cx = (view.shear_y - 1) / 2.0, (view.x - 1) / 2.0
    yy, xx = F.col("y").cast("double") - cy, F.col("x").cast("double") - cx
    sy = F.rint(F.lit(view.cos) * yy - F.lit(view.sin) * xx + F.lit(cy)).cast("long").alias("sy")
    return sy, F.rint(F.lit(view.sin) * yy + F.lit(view.cos) * xx + F.lit(cx)).cast("long").alias("sx")


def rotation_lookup(spark: SparkSession, view: TopView) -> DataFrame:
    """Nearest source (sy, sx) of every (y, x) of the sheared frame, rotated about its centre, half-even."""
    cells = spark.range(view.shear_y * view.x).select(F.expr(f"id div {view.x}").alias("y"), (F.col("id") % view.x).alias("x"))
    return cells.select("y", "x", *_looked_up(view))


def _read_only(frames: DataFrame, view: TopView, row: F.Column) -> DataFrame:
    """Without the rows of the sheared frame that no cell looks up."""
    low, high = view.read_rows()
    return frames.where((row >= low) & (row < high))


def _gathered(source: DataFrame, view: TopView, bands: DataFrame, depth: int, value: F.Column) -> DataFrame:
    """Every cell (z, y, x) with ``value`` of the voxel (z, sy, sx, v) that it looks up; v is null where there is none.

    ``bands`` (z, low, high), one row per plane and broadcast: the rows of the frame within which a plane has
    voxels. Cells that look elsewhere are 0 and aren't joined, so the shuffle grows with the source and not with
    the frame, which is mostly empty in a deep volume.
    """
    spark = source.sparkSession
    within = (F.col("sx") >= 0) & (F.col("sx") < view.x)
    banded = within & (F.col("sy") >= F.col("low")) & (F.col("sy") < F.col("high"))
    cells = rotation_lookup(spark, view).where(within).join(F.broadcast(bands), banded).select("z", "y", "x", "sy", "sx")
    found = cells.join(source, ["z", "sy", "sx"], "left").select("z", "y", "x", value.alias("v"))
    every = grid(spark, (depth, view.shear_y, view.x)).select("z", "y", "x", *_looked_up(view))
    empty = every.join(F.broadcast(bands), "z").where(~banded).select("z", "y", "x", F.lit(0.0).alias("v"))
    return found.unionByName(empty)


def rotated_nearest(volume: DataFrame, view: TopView) -> DataFrame:
    """Every plane of a volume in the sheared frame, rotated in (y, x) by nearest neighbour; 0 outside."""
    ends = volume.groupBy("z").agg(F.min("y").alias("low"), (F.max("y") + 1).alias("high"))
    bands = volume.sparkSession.range(view.z).withColumnRenamed("id", "z").join(ends, "z", "left").fillna(0)
    source = _read_only(volume, view, F.col("y")).select("z", F.col("y").alias("sy"), F.col("x").alias("sx"), "v")
    return _gathered(source, view, bands, view.z, F.coalesce("v", F.lit(0.0)))


def rotated_bilinear(page: DataFrame, view: TopView) -> DataFrame:
    """One page (y, x, v) of the sheared frame rotated by bilinear interpolation; 0 outside."""
    cells = rotation_lookup(page.sparkSession, view).drop("sy", "sx")
    cy, cx = (view.shear_y - 1) / 2.0, (view.x - 1) / 2.0
    yy, xx = F.col("y").cast("double") - cy, F.col("x").cast("double") - cx
    cells = cells.withColumns({"fy": F.lit(view.cos) * yy - F.lit(view.sin) * xx + F.lit(cy), "fx": F.lit(view.sin) * yy + F.lit(view.cos) * xx + F.lit(cx)})
    taps = cells.select("y", "x", _taps("fy").alias("ty"), _taps("fx").alias("tx")).select("y", "x", F.explode("ty").alias("a"), "tx").select("y", "x", "a", F.explode("tx").alias("b"))
    taps = taps.select("y", "x", F.col("a.i").alias("sy"), F.col("b.i").alias("sx"), (F.col("a.w") * F.col("b.w")).alias("w"))
    source = page.select(F.col("y").alias("sy"), F.col("x").alias("sx"), "v")
    return taps.join(source, ["sy", "sx"], "left").groupBy("y", "x").agg(F.sum(F.col("w") * F.coalesce("v", F.lit(0.0))).alias("v"))


def _taps(at: str) -> F.Column:
    low = F.floor(at)
    rest = F.col(at) - low
    return F.array(F.struct(low.cast("long").alias("i"), (1 - rest).alias("w")), F.struct((low + 1).cast("long").alias("i"), rest.alias("w")))


def _summed(volume: DataFrame, view: TopView) -> DataFrame:
    """The interpolated frame (z, sy, sx, v): the weighted sum of at most three source planes, in double precision."""
    taps = volume.sparkSession.createDataFrame(view.taps(), "z long, sz long, shift long, c double")
    moved = _read_only(volume.withColumnRenamed("z", "sz").join(F.broadcast(taps), "sz"), view, F.col("y") + F.col("shift"))
    return moved.groupBy("z", (F.col("y") + F.col("shift")).alias("sy"), F.col("x").alias("sx")).agg(F.sum(F.col("c") * F.col("v")).alias("v"))


def _summed_single(volume: DataFrame, view: TopView) -> DataFrame:
    """The same in single precision, step by step: means of neighbours first, then their weighted sum; one shuffle as well."""
    taps = volume.sparkSession.createDataFrame(view.single_taps(), "z long, sz long, place int, shift long, first double, second double")
    moved = _read_only(volume.withColumnRenamed("z", "sz").join(F.broadcast(taps), "sz"), view, F.col("y") + F.col("shift"))
    planes = [F.coalesce(F.max(F.when(F.col("place") == i, F.col("v").cast("float"))), F.lit(0.0).cast("float")).alias(f"v{i}") for i in range(3)]
    found = moved.groupBy("z", (F.col("y") + F.col("shift")).alias("sy"), F.col("x").alias("sx"), "first", "second").agg(F.max(F.col("sz") - F.col("place")).alias("low"), *planes)
    v0, v1, v2, half = F.col("v0"), F.col("v1"), F.col("v2"), F.lit(0.5).cast("float")
    last = view.z - 1
    here = F.when(F.col("low") == last, v0).otherwise(half * (v0 + v1))
    deeper = F.when(F.col("low") == last, v0).when(F.col("low") == last - 1, v1).otherwise(half * (v1 + v2))
    return found.select("z", "sy", "sx", (F.col("first").cast("float") * here + F.col("second").cast("float") * deeper).cast("double").alias("v"))


def top_view_volume(volume: DataFrame, view: TopView, rounding: str = "half_even", bypass_single: bool = False, arithmetic: str = "float64") -> DataFrame:
    """Fused top view: neighbour mean, depth interpolation and shear in one aggregate, then the rotation as a gather.

    The taps of all output planes (at most three source planes each) are one
    small table, bounded by the depth, and are broadcast; their weighted sums, of the rows that are looked up, combine before
    the only shuffle of voxels. The result is dense: voxels without a source are 0.
    ``bypass_single``: a volume of one plane passes as it is. ``arithmetic``: ``float64``, snapped to a
    millionth, or ``float32``, in which near-ties round as single precision has them.
    """
    if bypass_single and view.z == 1:
        return volume
    spark = volume.sparkSession
    single = arithmetic == "float32"
    summed = _summed_single(volume, view) if single else _summed(volume, view)
    value = F.coalesce("v", F.lit(0.0))
    return _gathered(summed, view, spark.createDataFrame(view.bands(), "z long, low long, high long"), view.scaled_z, to_range(value if single else snapped(value), rounding))


def affine_volume(volume: DataFrame, geometry: Affine, output_type: str = "float32") -> DataFrame:
    """Affine resampling: up to eight taps per output voxel, weighted by support.

    Taps outside the source, or on absent or NaN voxels, are dropped and the rest renormalised; a voxel outside
    the half-voxel domain, or with almost no support, is 0. The result is dense; voxels outside the
    domain, most of a deep volume's, come straight from the grid and aren't shuffled.
    """
    spark = volume.sparkSession
    nz, ny, nx = geometry.source
    cells = grid(spark, geometry.shape)
    for name, (a, b, c, d) in zip(("fz", "fy", "fx"), geometry.to_source(), strict=True):
        cells = cells.withColumn(name, F.lit(a) * F.col("z") + F.lit(b) * F.col("y") + F.lit(c) * F.col("x") + F.lit(d))
    near = F.lit(True)
    for name, n in (("fz", nz), ("fy", ny), ("fx", nx)):
        near = near & (F.col(name) >= -0.5) & (F.col(name) <= n - 0.5)
    inside = cells.where(near)
    taps = inside.select("z", "y", "x", F.explode(_taps("fz")).alias("a"), "fy", "fx").where("a.w > 0").select("z", "y", "x", "a", F.explode(_taps("fy")).alias("b"), "fx").where("b.w > 0")
    sx, w = F.col("x"), F.col("a.w") * F.col("b.w")  # a transform about x leaves x as it is: one tap instead of two
    if geometry.to_source()[2] != (0.0, 0.0, 1.0, 0.0):
        taps = taps.select("z", "y", "x", "a", "b", F.explode(_taps("fx")).alias("c"))
        sx, w = F.col("c.i"), w * F.col("c.w")
    taps = taps.select("z", "y", "x", F.col("a.i").alias("sz"), F.col("b.i").alias("sy"), sx.alias("sx"), w.alias("w")).where("w > 0")
    source = volume.where(~F.isnan("v")).toDF(*[{"z": "sz", "y": "sy", "x": "sx"}.get(c, c) for c in volume.columns])
    parts = taps.join(source, ["sz", "sy", "sx"]).select("z", "y", "x", (F.col("w") * F.col("v")).alias("s"), "w")
    none = inside.select("z", "y", "x", F.lit(0.0).alias("s"), F.lit(0.0).alias("w"))  # keeps every voxel, without another join
    sums = parts.unionByName(none).groupBy("z", "y", "x").agg(F.sum("s").alias("s"), F.sum("w").alias("w"))
    full = sums.select("z", "y", "x", F.when(F.col("w") > SUPPORT, F.col("s") / F.col("w")).otherwise(0.0).alias("v"))
    full = full if output_type == "float32" else full.withColumn("v", to_range(snapped(F.col("v")), "half_up"))
    return full.unionByName(cells.where(~near).select("z", "y", "x", F.lit(0.0).alias("v")))


def pyramid(volume: DataFrame, factors: list[int]) -> DataFrame:
    """All levels in one pass: each voxel goes to the levels whose stride it lies on; levels come from level 0."""
    levels = F.filter(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(f).alias("factor")) for i, f in enumerate(factors)]), lambda s: (F.col("y") % s["factor"] == 0) & (F.col("x") % s["factor"] == 0))
    every = volume.select("z", "y", "x", "v", F.explode(levels).alias("l"))
    return every.select("l.level", "l.factor", "z", F.expr("y div l.factor").alias("y"), F.expr("x div l.factor").alias("x"), "v")


def pyramid_shapes(shape: tuple[int, int, int], factors: list[int]) -> list[tuple[int, int, int, int, int]]:
    z, y, x = shape
    return [(i, f, z, level_size(y, f), level_size(x, f)) for i, f in enumerate(factors)]


def max_projection(volume: DataFrame) -> DataFrame:
    return volume.groupBy("y", "x").agg(F.max("v").alias("v"))


