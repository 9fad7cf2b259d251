"""Catalogue of registered queries, each with the DuckDB SQL it must equal.

A query is a function of (spark, sf_dir) named like its key. Oracles are
written for the same Parquet tables; geometry constants are computed once here
and appear in both forms as numbers.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import exprs, geometry, names, params
from tessera.operators import block_resample, compare, project, resample
from tessera.session import ship
from tessera.sources import blocks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Acquisition of the sample volumes.
DX, DZ, ANGLE = 0.168, 0.2, 45.0
#: Depths of the embedding volume at the scales of the test tables; affine constants are listed for each.
DEPTHS = (20, 80)
MOST = 16


def query(sql: str | None):
    """Register a query and, where SQL can express it, its oracle."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(ship(spark), sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return run

    return add


# ---- fixtures in SQL ---------------------------------------------------------------------------------------

_E = "(SELECT vec_id, label, unnest(embedding)::DOUBLE AS e, unnest(range(1, len(embedding) + 1)) - 1 AS x FROM embeddings)"
VE = f"ve AS (SELECT vec_id // 25 AS z, vec_id % 25 AS y, x, round_even((e + 1) * 10000, 0)::DOUBLE AS v FROM {_E})"
VF = f"vf AS (SELECT vec_id // 25 AS z, vec_id % 25 AS y, x, e AS v FROM {_E})"
VC = "vc AS (SELECT z, y, x, v + (z + y + x) % 3 AS v FROM ve)"
SIZE = "dims AS (SELECT max(z) + 1 AS nz, max(y) + 1 AS ny, max(x) + 1 AS nx FROM ve)"
LINES = (
    "cells AS (SELECT l_linenumber::BIGINT - 1 AS z, l_orderkey % 64 AS y, l_partkey % 64 AS x, sum(l_quantity) AS v FROM lineitem GROUP BY ALL), "
    "vl AS (SELECT g.z, g.y, g.x, coalesce(c.v, 0.0) AS v FROM (SELECT z.range AS z, y.range AS y, x.range AS x FROM range(7) z, range(64) y, range(64) x) g LEFT JOIN cells c USING (z, y, x))"
)
VM = f"vm AS (SELECT printf('volume_%02d.tif', label) AS volume_id, dense_rank() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS z, 0::BIGINT AS y, x, round_even((e + 1) * 10000, 0)::DOUBLE AS v FROM {_E})"


def num(value: float) -> str:
    return f"cast('{float(value)!r}' as double)"


def micro_sql(value: str) -> str:
    return f"cast(floor(({value}) * 1e6 + {num(0.5)}) as bigint)"


def shear_sql(flip: int = 1) -> str:
    """Offsets, margin and output sizes of the top view, from trigonometric constants."""
    ratio, scale = geometry.shear_ratio(DX, DZ, ANGLE), geometry.depth_scale(DX, DZ, ANGLE)
    return (
        f"off AS (SELECT p.range AS z, round_even({num(flip)} * (p.range + 1 - (nz // 2 + 1)) * {num(ratio)}, 0)::BIGINT AS o FROM dims, range((SELECT nz FROM dims)) p), "
        f"frame AS (SELECT nz, ny, nx, (SELECT max(abs(o)) FROM off) AS m, ny + 2 * (SELECT max(abs(o)) FROM off) AS sy, greatest(1, round_even(nz * {num(scale)}, 0))::BIGINT AS sz FROM dims)"
    )


def lookup_sql(flip: int = 1) -> str:
    import math

    theta = math.radians(-float(flip) * ANGLE)
    c, s = num(math.cos(theta)), num(math.sin(theta))
    return (
        f"yx AS (SELECT y.range AS y, x.range AS x, {c} * (y.range - (sy - 1) / 2.0::DOUBLE) - {s} * (x.range - (nx - 1) / 2.0::DOUBLE) + (sy - 1) / 2.0::DOUBLE AS fy, "
        f"{s} * (y.range - (sy - 1) / 2.0::DOUBLE) + {c} * (x.range - (nx - 1) / 2.0::DOUBLE) + (nx - 1) / 2.0::DOUBLE AS fx "
        "FROM frame, range((SELECT sy FROM frame)) y, range((SELECT nx FROM frame)) x), "
        "look AS (SELECT y, x, round_even(fy, 0)::BIGINT AS ry, round_even(fx, 0)::BIGINT AS rx FROM yx)"
    )


DEPTH = (
    "q AS (SELECT k.range AS z, least(greatest((k.range + 0.5::DOUBLE) * nz / sz - 0.5::DOUBLE, 0.0), nz - 1.0::DOUBLE) AS q, nz FROM frame, range((SELECT sz FROM frame)) k), "
    "depth AS (SELECT z, floor(q)::BIGINT AS z0, least(floor(q)::BIGINT + 1, nz - 1) AS z1, q - floor(q) AS w, nz FROM q)"
)


def top_view_sql(rounding: str, flip: int = 1) -> str:
    snapped = f"floor(coalesce(s, 0.0) * 1e6 + {num(0.5)}) / 1e6"
    whole = f"round_even({snapped}, 0)" if rounding == "half_even" else f"floor({snapped} + {num(0.5)})"
    return (
        f"WITH {VE}, {SIZE}, {shear_sql(flip)}, {lookup_sql(flip)}, {DEPTH}, "
        "pair AS (SELECT z, z0 AS p, 1 - w AS c, nz FROM depth UNION ALL SELECT z, z1, w, nz FROM depth), "
        f"half AS (SELECT z, p, CASE WHEN p = nz - 1 THEN c ELSE {num(0.5)} * c END AS c FROM pair UNION ALL SELECT z, p + 1, {num(0.5)} * c FROM pair WHERE p < nz - 1), "
        "taps AS (SELECT z, p, sum(c) AS c FROM half GROUP BY z, p), "
        "summed AS (SELECT t.z, ve.y + o + (SELECT m FROM frame) AS ry, ve.x AS rx, sum(c * v) AS s FROM taps t JOIN ve ON ve.z = t.p JOIN off ON off.z = t.p GROUP BY ALL), "
        "cells AS (SELECT d.z, y, x, ry, rx FROM look, depth d) "
        f"SELECT z, y, x, least(greatest({whole}, 0.0), 65535.0)::DOUBLE AS v FROM cells LEFT JOIN summed USING (z, ry, rx)"
    )


def affine_sql(rotate: bool, out: str, flip: int = 1, angle: float = ANGLE) -> str:
    """Geometry rows for each known depth, then grid, taps and support."""
    rows = []
    for depth in DEPTHS:
        g = geometry.affine((depth, tables.PLANE_ROWS, tables.WIDTH), DX, DZ, angle, flip, rotate)
        rows.append("(" + ", ".join([str(depth), *map(str, g.shape), *(num(v) for row in g.to_source() for v in row)]) + ")")
    columns = ["nz", "oz", "oy", "ox", *[f"{n}{i}" for n in "abc" for i in range(4)]]
    at = [f"{n}0 * z.range + {n}1 * y.range + {n}2 * x.range + {n}3" for n in "abc"]
    taps = ", ".join(f"(VALUES (0), (1)) d{n}(i{n})" for n in "zyx")
    weight = " * ".join(f"(CASE WHEN i{n} = 0 THEN 1 - (f{n} - floor(f{n})) ELSE f{n} - floor(f{n}) END)" for n in "zyx")
    value = "coalesce(CASE WHEN w > 1e-3 THEN s / w ELSE 0.0 END, 0.0)"
    shown = f"{micro_sql(value)} AS v_micro" if out == "float32" else f"least(greatest(floor(floor({value} * 1e6 + {num(0.5)}) / 1e6 + {num(0.5)}), 0.0), 65535.0)::DOUBLE AS v"
    return (
        f"WITH {VE}, {SIZE}, g({', '.join(columns)}) AS (VALUES {', '.join(rows)}), one AS (SELECT g.*, ny, nx FROM g JOIN dims USING (nz)), "
        f"grid AS (SELECT z.range AS z, y.range AS y, x.range AS x, {at[0]} AS fz, {at[1]} AS fy, {at[2]} AS fx, nz, ny, nx FROM one, range((SELECT oz FROM one)) z, range((SELECT oy FROM one)) y, range((SELECT ox FROM one)) x), "
        "inside AS (SELECT * FROM grid WHERE fz BETWEEN -0.5 AND nz - 0.5 AND fy BETWEEN -0.5 AND ny - 0.5 AND fx BETWEEN -0.5 AND nx - 0.5), "
        f"taps AS (SELECT z, y, x, floor(fz)::BIGINT + iz AS pz, floor(fy)::BIGINT + iy AS py, floor(fx)::BIGINT + ix AS px, {weight} AS w FROM inside, {taps}), "
        "sums AS (SELECT t.z, t.y, t.x, sum(w * v) AS s, sum(w) AS w FROM taps t JOIN ve ON ve.z = pz AND ve.y = py AND ve.x = px GROUP BY ALL) "
        f"SELECT z, y, x, {shown} FROM grid LEFT JOIN sums USING (z, y, x)"
    )


def view_of(spark: SparkSession, sf_dir: str, flip: int = 1) -> geometry.TopView:
    return geometry.top_view(tables.embedding_shape(spark, sf_dir), DX, DZ, ANGLE, flip)


# ---- scans and projections ---------------------------------------------------------------------------------


@query(f"WITH {VE} SELECT z, y, x, v FROM ve")
def voxel_scan(spark, sf_dir):
    return tables.embedding_volume(spark, sf_dir)


@query(f"WITH {VE} SELECT y, x, v FROM ve WHERE z = 7")
def plane_slice(spark, sf_dir):
    return project.plane(tables.embedding_volume(spark, sf_dir, planes=(7, 8)), "z", 7)


@query(f"WITH {VE} SELECT z, y, v FROM ve WHERE x = 33 AND z BETWEEN 1 AND (SELECT max(z) - 1 FROM ve) AND y BETWEEN 2 AND 22")
def axis_slice(spark, sf_dir):
    shape = tables.embedding_shape(spark, sf_dir)
    return project.plane(project.trim(tables.embedding_volume(spark, sf_dir, planes=(1, shape[0] - 1)), shape, (1, 2, 0)), "x", 33)


@query(f"WITH {VE} SELECT z, y, x, v FROM ve WHERE z BETWEEN 2 AND (SELECT max(z) - 2 FROM ve) AND y BETWEEN 1 AND 23 AND x BETWEEN 5 AND 58")
def trim_crop(spark, sf_dir):
    shape = tables.embedding_shape(spark, sf_dir)
    return project.trim(tables.embedding_volume(spark, sf_dir, planes=(2, shape[0] - 2)), shape, (2, 1, 5))


@query(f"WITH {VE} SELECT z, y // 4 AS y, x // 4 AS x, v FROM ve WHERE y % 4 = 0 AND x % 4 = 0")
def stride_downsample(spark, sf_dir):
    return project.stride(tables.embedding_volume(spark, sf_dir), 4)


@query(f"WITH {VE} SELECT y AS z, z AS y, x, v FROM ve")
def axis_permute(spark, sf_dir):
    return project.permute(tables.embedding_volume(spark, sf_dir), ("y", "z", "x"))


_SCALED = "(SELECT z, y, x, CASE WHEN (z + x) % 5 = 0 THEN floor(v * 100) + 0.5::DOUBLE WHEN y = 3 THEN v * 200000 ELSE v * 1000 END AS v FROM vf)"


def _scaled(spark, sf_dir):
    v = F.col("v")
    value = F.when((F.col("z") + F.col("x")) % 5 == 0, F.floor(v * 100) + F.lit(0.5)).when(F.col("y") == 3, v * 200000).otherwise(v * 1000)
    return tables.embedding_volume(spark, sf_dir, raw=True).withColumn("v", value.cast("double"))


@query(f"WITH {VF} SELECT z, y, x, least(greatest(round_even(v, 0), 0.0), 65535.0)::DOUBLE AS v FROM {_SCALED}")
def round_half_even_u16(spark, sf_dir):
    return _scaled(spark, sf_dir).withColumn("v", exprs.to_range(F.col("v"), "half_even"))


@query(f"WITH {VF} SELECT z, y, x, least(greatest(floor(v + 0.5::DOUBLE), 0.0), 65535.0)::DOUBLE AS v FROM {_SCALED}")
def round_half_up_u16(spark, sf_dir):
    return _scaled(spark, sf_dir).withColumn("v", exprs.to_range(F.col("v"), "half_up"))


_HOLES = "(SELECT z, y, x, CASE WHEN (z + y + x) % 11 = 0 THEN 'nan'::DOUBLE WHEN (z + y + x) % 13 = 0 THEN 'inf'::DOUBLE WHEN (z + y) % 7 = 0 THEN 0.0 ELSE v END AS v FROM vf)"


def _holes(spark, sf_dir):
    z, y, x = F.col("z"), F.col("y"), F.col("x")
    value = F.when((z + y + x) % 11 == 0, float("nan")).when((z + y + x) % 13 == 0, float("inf")).when((z + y) % 7 == 0, 0.0).otherwise(F.col("v"))
    return tables.embedding_volume(spark, sf_dir, raw=True).withColumn("v", value)


@query(f"WITH {VF} SELECT z, y, x, {micro_sql('v')} AS v_micro FROM {_HOLES} WHERE isfinite(v)")
def finite_filter(spark, sf_dir):
    return _holes(spark, sf_dir).where(exprs.finite(F.col("v"))).select("z", "y", "x", exprs.micro(F.col("v")).alias("v_micro"))


def _stats_sql(source: str, keys: str, where: str) -> str:
    k = f"{keys}, " if keys else ""
    return (
        f"SELECT {k}count(*) AS count, {micro_sql('avg(v)')} AS mean_micro, {micro_sql('stddev_pop(v)')} AS sigma_micro, {micro_sql(f'stddev_pop(v) * {num(exprs.FWHM)}')} AS fwhm_micro "
        f"FROM {source} WHERE {where}" + (f" GROUP BY {keys}" if keys else "")
    )


def _stats(df, keys, ignore_zero=False):
    found = compare.intensity_stats(df, keys, "v", ignore_zero)
    return found.select(*keys, "count", *[exprs.micro(F.col(c)).alias(f"{c}_micro") for c in ("mean", "sigma", "fwhm")])


@query(f"WITH {VF} " + _stats_sql(_HOLES, "z", "isfinite(v) AND v <> 0"))
def ignore_zero_stats(spark, sf_dir):
    return _stats(_holes(spark, sf_dir), ["z"], ignore_zero=True)


@query(f"WITH {VE} " + _stats_sql("ve", "z", "true"))
def intensity_stats(spark, sf_dir):
    return _stats(tables.embedding_volume(spark, sf_dir), ["z"])


@query(f"WITH {VE} " + _stats_sql("ve", "", "true"))
def pooled_stats(spark, sf_dir):
    return _stats(tables.embedding_volume(spark, sf_dir), [])


@query(f"WITH {VE} SELECT z, y, x, v FROM (SELECT tt.range AS t, cc.range AS c, z, y, x, v + 100 * tt.range + cc.range AS v FROM ve, range(2) tt, range(3) cc) WHERE t = 1 AND c = 2")
def component_view(spark, sf_dir):
    volume = tables.embedding_volume(spark, sf_dir)
    six = volume.crossJoin(spark.range(2).withColumnRenamed("id", "t")).crossJoin(spark.range(3).withColumnRenamed("id", "c")).withColumn("p", F.lit(0))
    return project.component(six.withColumn("v", F.col("v") + 100 * F.col("t") + F.col("c")), 1, 0, 2)


# ---- shear, depth, rotation --------------------------------------------------------------------------------


@query(f"WITH {VE}, {SIZE}, {shear_sql()} SELECT z, o, (SELECT m FROM frame) AS margin, (SELECT sy FROM frame) AS shear_y, (SELECT sz FROM frame) AS scaled_z FROM off")
def shear_offsets(spark, sf_dir):
    view = view_of(spark, sf_dir)
    return resample.offset_table(spark, view).select("z", "o", *[F.lit(n).cast("long").alias(k) for k, n in (("margin", view.margin), ("shear_y", view.shear_y), ("scaled_z", view.scaled_z))])


@query(f"WITH {VE}, {SIZE}, {shear_sql()} SELECT z, y + o + (SELECT m FROM frame) AS y, x, v FROM ve JOIN off USING (z)")
def shear_volume(spark, sf_dir):
    return resample.sheared(tables.embedding_volume(spark, sf_dir), view_of(spark, sf_dir))


@query(f"WITH {VE} SELECT z, y, x, coalesce((v + lead(v) OVER (PARTITION BY y, x ORDER BY z)) * 0.5::DOUBLE, v) AS v FROM ve")
def adjacent_slice_mean(spark, sf_dir):
    return resample.neighbour_mean(tables.embedding_volume(spark, sf_dir))


@query(f"WITH {VE}, {SIZE}, {shear_sql()}, {DEPTH} SELECT z, z0, z1, {micro_sql('w')} AS w_micro FROM depth")
def depth_resample_map(spark, sf_dir):
    return resample.depth_map(spark, view_of(spark, sf_dir)).select("z", "z0", "z1", exprs.micro(F.col("w")).alias("w_micro"))


@query(f"WITH {VE}, {SIZE}, {shear_sql()}, {DEPTH} SELECT d.z, a.y, a.x, {micro_sql('(1 - w) * a.v + w * b.v')} AS v_micro FROM depth d JOIN ve a ON a.z = z0 JOIN ve b ON b.z = z1 AND b.y = a.y AND b.x = a.x")
def depth_resample(spark, sf_dir):
    out = resample.depth_resized(tables.embedding_volume(spark, sf_dir), view_of(spark, sf_dir))
    return out.select("z", "y", "x", exprs.micro(F.col("v")).alias("v_micro"))


@query(f"WITH {VE}, {SIZE}, {shear_sql()}, {lookup_sql()} SELECT y, x, ry AS sy, rx AS sx FROM look")
def rotation_lookup(spark, sf_dir):
    return resample.rotation_lookup(spark, view_of(spark, sf_dir))


@query(
    f"WITH {VE}, {SIZE}, {shear_sql()}, {lookup_sql()}, sheared AS (SELECT z, y + o + (SELECT m FROM frame) AS ry, x AS rx, v FROM ve JOIN off USING (z)) "
    "SELECT off.z, look.y, look.x, coalesce(v, 0.0) AS v FROM look CROSS JOIN off LEFT JOIN sheared s ON s.z = off.z AND s.ry = look.ry AND s.rx = look.rx"
)
def plane_rotate_nn(spark, sf_dir):
    view = view_of(spark, sf_dir)
    return resample.rotated_nearest(resample.sheared(tables.embedding_volume(spark, sf_dir), view), view)


@query(
    f"WITH {VE}, {SIZE}, {shear_sql()}, {lookup_sql()}, page AS (SELECT y + o + (SELECT m FROM frame) AS py, x AS px, max(v) AS v FROM ve JOIN off USING (z) GROUP BY ALL), "
    "taps AS (SELECT y, x, floor(fy)::BIGINT + i AS py, floor(fx)::BIGINT + j AS px, (CASE WHEN i = 0 THEN 1 - (fy - floor(fy)) ELSE fy - floor(fy) END) * (CASE WHEN j = 0 THEN 1 - (fx - floor(fx)) ELSE fx - floor(fx) END) AS w FROM yx, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)) "
    f"SELECT y, x, {micro_sql('sum(w * coalesce(v, 0.0))')} AS v_micro FROM taps LEFT JOIN page USING (py, px) GROUP BY y, x"
)
def plane_rotate_bilinear(spark, sf_dir):
    view = view_of(spark, sf_dir)
    page = resample.max_projection(resample.sheared(tables.embedding_volume(spark, sf_dir), view))
    return resample.rotated_bilinear(page, view).select("y", "x", exprs.micro(F.col("v")).alias("v_micro"))


SMOOTHED = (
    "near AS (SELECT k.range AS z, i.range AS i, (k.range + 0.5::DOUBLE) * nz / sz - 0.5::DOUBLE AS c, greatest(nz::DOUBLE / sz, 1.0) AS step, nz FROM frame, range((SELECT sz FROM frame)) k, range(-4 - (SELECT nz FROM frame), 2 * (SELECT nz FROM frame) + 4) i), "
    "tri AS (SELECT z, ((i % (2 * nz)) + 2 * nz) % (2 * nz) AS turn, nz, greatest(0.0, 1 - abs(i - c) / step) AS w FROM near WHERE abs(i - c) < step), "
    "wide AS (SELECT z, CASE WHEN turn < nz THEN turn ELSE 2 * nz - 1 - turn END AS p, w / sum(w) OVER (PARTITION BY z) AS c FROM tri)"
)


@query(f"WITH {VE}, {SIZE}, {shear_sql()}, {SMOOTHED} SELECT wide.z, y, x, {micro_sql('sum(c * v)')} AS v_micro FROM wide JOIN ve ON ve.z = p GROUP BY wide.z, y, x")
def depth_resample_antialiased(spark, sf_dir):
    """The older depth resize: where depth shrinks, a triangle as wide as the output's spacing."""
    found = resample.depth_resized(tables.embedding_volume(spark, sf_dir), view_of(spark, sf_dir), antialias=True)
    return found.select("z", "y", "x", exprs.micro(F.col("v")).alias("v_micro"))


def single_sql() -> str:
    """Top view in FLOAT: weights, means and sums are each rounded to single precision."""
    return (
        f"WITH {VE}, {SIZE}, {shear_sql()}, {lookup_sql()}, {DEPTH}, "
        "moved AS (SELECT z, y + o + (SELECT m FROM frame) AS ry, x AS rx, v::FLOAT AS v FROM ve JOIN off USING (z)), "
        "twice AS (SELECT z AS p, ry, rx, v FROM moved UNION ALL SELECT z - 1, ry, rx, v FROM moved WHERE z > 0), "
        "mean AS (SELECT p, ry, rx, (CASE WHEN p = (SELECT max(z) FROM ve) THEN sum(v) ELSE sum(v) * 0.5::DOUBLE END)::FLOAT AS m FROM twice GROUP BY p, ry, rx), "
        "share AS (SELECT z, z0 AS p, (1.0::DOUBLE - w::FLOAT::DOUBLE)::FLOAT AS c FROM depth UNION ALL SELECT z, z1, w::FLOAT FROM depth), "
        "summed AS (SELECT s.z, ry, rx, sum(((c::DOUBLE * m::DOUBLE)::FLOAT)::DOUBLE)::FLOAT AS s FROM share s JOIN mean USING (p) GROUP BY ALL), "
        "cells AS (SELECT d.z, y, x, ry, rx FROM look, depth d) "
        "SELECT z, y, x, least(greatest(round_even(coalesce(s, 0.0)::DOUBLE, 0), 0.0), 65535.0)::DOUBLE AS v FROM cells LEFT JOIN summed USING (z, ry, rx)"
    )


@query(single_sql())
def topview_float32(spark, sf_dir):
    return resample.top_view_volume(tables.embedding_volume(spark, sf_dir), view_of(spark, sf_dir), arithmetic="float32")


@query(single_sql())
def topview_float32_blocks(spark, sf_dir):
    """The same from planes, as the batch pipeline runs it."""
    shape = tables.embedding_shape(spark, sf_dir)
    planes = blocks.from_voxels(tables.embedding_volume(spark, sf_dir), shape, (1, *shape[1:]))
    return blocks.to_voxels(block_resample.top_view_planes(planes, view_of(spark, sf_dir), arithmetic="float32").drop("k"))


@query(top_view_sql("half_even"))
def topview(spark, sf_dir):
    return resample.top_view_volume(tables.embedding_volume(spark, sf_dir), view_of(spark, sf_dir))


@query(top_view_sql("half_up"))
def topview_half_up(spark, sf_dir):
    return resample.top_view_volume(tables.embedding_volume(spark, sf_dir), view_of(spark, sf_dir), "half_up")


@query(top_view_sql("half_even", -1))
def topview_flip(spark, sf_dir):
    return resample.top_view_volume(tables.embedding_volume(spark, sf_dir), view_of(spark, sf_dir, -1))


@query(f"WITH {VE} SELECT y, x, max(v) AS v FROM ve GROUP BY y, x")
def max_intensity_projection(spark, sf_dir):
    return resample.max_projection(tables.embedding_volume(spark, sf_dir))


# ---- affine ------------------------------------------------------------------------------------------------

#: Parameter sets (dx, dz, angle, flip, rotate), each for planes of 25 x 64.
AFFINE_SETS = [(0.168, 0.2, 45.0, 1, True), (0.168, 0.2, 45.0, 1, False), (1.0, 1.0, 30.0, 1, True), (0.108, 0.3, 40.0, -1, True), (1.0, 1.0, 0.0, 1, True)]
_VOLUMES = "sizes AS (SELECT label, count(*) AS size FROM embeddings WHERE label IS NOT NULL GROUP BY label)"


def _volumes(spark, sf_dir):
    """The depths of the volumes that the vectors of each label make."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("size"))


_AFFINE_CORNERS = """
WITH {volumes}, sets(id, dx, dz, c, s, sh) AS (VALUES {rows}),
p AS (SELECT label * 10 + id AS id, id AS set, size AS nz, 25 AS ny, dx, dz, c, s, sh FROM sizes, sets),
k AS (SELECT p.*, (ny - 1) * dx AS ly, (nz - 1) * dz AS lz FROM p),
m AS (SELECT *, c AS a22, c * sh - s AS a23, s AS a32, s * sh + c AS a33 FROM k),
e AS (SELECT id, set, a22, a23, a32, a33, dx, dz, a22 * i * ly + a23 * j * lz AS y, a32 * i * ly + a33 * j * lz AS z FROM m, (VALUES (0), (1)) u(i), (VALUES (0), (1)) w(j))
SELECT id::BIGINT AS id, greatest(1, floor((max(z) - min(z)) / any_value(dz) + 1e-9)::BIGINT + 1) AS oz, greatest(1, floor((max(y) - min(y)) / any_value(dx) + 1e-9)::BIGINT + 1) AS oy, any_value(ox) AS ox,
  floor(any_value(a22) * 1e6)::BIGINT AS m_yy, floor(any_value(a23) * 1e6)::BIGINT AS m_yz, floor(any_value(a32) * 1e6)::BIGINT AS m_zy, floor(any_value(a33) * 1e6)::BIGINT AS m_zz
FROM e JOIN (VALUES {widths}) x(xid, ox) ON xid = set GROUP BY id
"""


def _affine_geometry_sql() -> str:
    import math

    rows, widths = [], []
    for i, (dx, dz, angle, flip, rotate) in enumerate(AFFINE_SETS):
        turn = math.radians(-flip * angle if rotate else 0.0)
        rows.append(f"({i}, {num(dx)}, {num(dz)}, {num(math.cos(turn))}, {num(math.sin(turn))}, {num(flip * math.sin(math.radians(angle)))})")
        widths.append(f"({i}, {geometry.affine((2, 25, 64), dx, dz, angle, flip, rotate, exact_extent=True).shape[2]}::BIGINT)")
    return _AFFINE_CORNERS.format(volumes=_VOLUMES, rows=", ".join(rows), widths=", ".join(widths))


@query(_affine_geometry_sql())
def affine_geometry(spark, sf_dir):
    """Output extents and matrices for the volume of every label, by each parameter set."""

    def made(batches):
        for batch in batches:
            rows = []
            for label, size in zip(batch["label"], batch["size"], strict=True):
                for i, (dx, dz, angle, flip, rotate) in enumerate(AFFINE_SETS):
                    g = geometry.affine((int(size), 25, 64), dx, dz, angle, flip, rotate, exact_extent=True)
                    rows.append((label * 10 + i, *g.shape, *[int(v * 1e6 // 1) for v in (g.matrix[1][1], g.matrix[1][2], g.matrix[2][1], g.matrix[2][2])]))
            yield pd.DataFrame(rows, columns=["id", "oz", "oy", "ox", "m_yy", "m_yz", "m_zy", "m_zz"])

    return _volumes(spark, sf_dir).mapInPandas(made, "id long, oz long, oy long, ox long, m_yy long, m_yz long, m_zy long, m_zz long")


def _affine(spark, sf_dir, rotate=True, out="float32", angle=ANGLE, flip=1):
    g = geometry.affine(tables.embedding_shape(spark, sf_dir), DX, DZ, angle, flip, rotate)
    found = resample.affine_volume(tables.embedding_volume(spark, sf_dir), g, out)
    return found.select("z", "y", "x", exprs.micro(F.col("v")).alias("v_micro")) if out == "float32" else found


@query(affine_sql(True, "float32"))
def affine_resample_f32(spark, sf_dir):
    return _affine(spark, sf_dir)


@query(affine_sql(True, "uint16"))
def affine_resample_u16(spark, sf_dir):
    return _affine(spark, sf_dir, out="uint16")


@query(affine_sql(False, "float32"))
def affine_shear_only(spark, sf_dir):
    return _affine(spark, sf_dir, rotate=False)


@query(affine_sql(True, "uint16", -1, 40.0))
def affine_flip(spark, sf_dir):
    return _affine(spark, sf_dir, out="uint16", angle=40.0, flip=-1)


@query(f"WITH {_VOLUMES} SELECT label, s.range AS start, least(s.range + 16, size) AS stop, greatest(0, s.range - 1) AS low, least(size, least(s.range + 16, size) + 1) AS high FROM sizes, range(0, (SELECT max(size) FROM sizes), 16) s WHERE s.range < size")
def tile_halo_bounds(spark, sf_dir):
    """Tiles of 16 columns of every volume with the source columns that they need."""

    def tiled(batches):
        for batch in batches:
            rows = [(label, a, min(a + 16, size), *geometry.tile_halo(a, min(a + 16, size), size)) for label, size in zip(batch["label"], map(int, batch["size"]), strict=True) for a in range(0, size, 16)]
            yield pd.DataFrame(rows, columns=["label", "start", "stop", "low", "high"])

    return _volumes(spark, sf_dir).mapInPandas(tiled, "label int, start long, stop long, low long, high long")


# ---- pyramid -----------------------------------------------------------------------------------------------


def _levels(source: str) -> str:
    return f"SELECT level, factor, z, y // factor AS y, x // factor AS x, v FROM {source}, (VALUES (0, 1), (1, 2), (2, 4), (3, 8), (4, 16)) l(level, factor) WHERE y % factor = 0 AND x % factor = 0"


@query(f"WITH {VE} " + _levels("ve"))
def pyramid_levels(spark, sf_dir):
    return resample.pyramid(tables.embedding_volume(spark, sf_dir), geometry.pyramid_factors(MOST))


@query(f"WITH {LINES} " + _levels("vl"))
def pyramid_lineitem(spark, sf_dir):
    return resample.pyramid(tables.lineitem_volume(spark, sf_dir), geometry.pyramid_factors(MOST))


@query(f"WITH {VE}, {SIZE} SELECT level, factor, nz AS z, (ny - 1) // factor + 1 AS y, (nx - 1) // factor + 1 AS x, greatest(1, least(greatest(1, least(256, ny) // factor), (ny - 1) // factor + 1)) AS chunk_y FROM dims, (VALUES (0, 1), (1, 2), (2, 4), (3, 8), (4, 16)) l(level, factor)")
def pyramid_shapes(spark, sf_dir):
    shape = tables.embedding_shape(spark, sf_dir)
    chunk = geometry.default_chunks(shape)[1]
    rows = [(*r, geometry.level_chunk(chunk, r[1], r[3])) for r in resample.pyramid_shapes(shape, geometry.pyramid_factors(MOST))]
    return spark.createDataFrame(rows, "level int, factor int, z long, y long, x long, chunk_y long")


@query(
    f"WITH {VE}, {SIZE} SELECT level::VARCHAR AS path, to_json([1, factor, factor])::VARCHAR AS scale, to_json([nz, (ny - 1) // factor + 1, (nx - 1) // factor + 1])::VARCHAR AS shape "
    "FROM dims, (VALUES (0, 1), (1, 2), (2, 4), (3, 8), (4, 16)) l(level, factor)"
)
def pyramid_metadata(spark, sf_dir):
    """Scales and shapes that a group of the table's volume would state for its levels."""
    from tessera.sinks.zarr import level_infos, multiscales

    factors = geometry.pyramid_factors(MOST)
    sets = multiscales("volume", factors)[0]["datasets"]
    infos = level_infos(tables.embedding_shape(spark, sf_dir), "<u2", factors, None)
    rows = [(d["path"], [int(v) for v in d["coordinateTransformations"][0]["scale"]], info["shape"]) for d, info in zip(sets, infos, strict=True)]
    return spark.createDataFrame(rows, "path string, scale array<int>, shape array<int>").select("path", F.to_json("scale").alias("scale"), F.to_json("shape").alias("shape"))


# ---- comparison --------------------------------------------------------------------------------------------


def _pair_sql(keys: str, source: str) -> str:
    return (
        f"moments AS (SELECT {keys}, count(*) AS n, avg(r) AS mr, avg(c) AS mc, var_pop(r) AS vr, var_pop(c) AS vc, covar_pop(r, c) AS rc, greatest(max(r), max(c)) AS hi, least(min(r), min(c)) AS lo FROM {source} WHERE isfinite(r) AND isfinite(c) GROUP BY {keys}), "
        f"alike_ AS (SELECT {keys}, n, CASE WHEN vr = 0 AND vc = 0 THEN 1.0 WHEN vr * vc = 0 THEN 'nan'::DOUBLE ELSE rc / sqrt(vr * vc) END AS ncc, "
        "(2 * mr * mc + pow(0.01::DOUBLE * greatest(1.0, hi - lo), 2)) * (2 * rc + pow(0.03::DOUBLE * greatest(1.0, hi - lo), 2)) / ((mr * mr + mc * mc + pow(0.01::DOUBLE * greatest(1.0, hi - lo), 2)) * (vr + vc + pow(0.03::DOUBLE * greatest(1.0, hi - lo), 2))) AS ssim FROM moments)"
    )


_BOTH = "both_ AS (SELECT ve.z, ve.y, ve.x, ve.v AS r, vc.v AS c FROM ve JOIN vc USING (z, y, x))"


def _both(spark, sf_dir):
    volume = tables.embedding_volume(spark, sf_dir)
    return volume, tables.candidate_volume(volume)


@query(f"WITH {VE}, {VC}, {_BOTH}, {_pair_sql('z', 'both_')} SELECT z, n, {micro_sql('ncc')} AS ncc_micro FROM alike_")
def page_ncc(spark, sf_dir):
    found = compare.similarity(compare.paired(*_both(spark, sf_dir)), ["z"])
    return found.select("z", "n", exprs.micro(F.col("ncc")).alias("ncc_micro"))


@query(f"WITH {VE}, {VC}, {_BOTH}, {_pair_sql('z', 'both_')} SELECT z, {micro_sql('ssim')} AS ssim_micro FROM alike_")
def page_ssim(spark, sf_dir):
    found = compare.similarity(compare.paired(*_both(spark, sf_dir)), ["z"])
    return found.select("z", exprs.micro(F.col("ssim")).alias("ssim_micro"))


@query(f"WITH {VE} SELECT DISTINCT z, CASE WHEN z % 3 = 2 THEN NULL ELSE 1000000::BIGINT END AS ncc_micro FROM ve")
def ncc_constant_pages(spark, sf_dir):
    """Constant pages of different height correlate to 1, a constant and a varying one to NaN (null here)."""
    v = tables.embedding_volume(spark, sf_dir)
    pairs = v.select("z", "y", "x", F.lit(5.0).alias("r"), F.when(F.col("z") % 3 == 2, F.col("v")).otherwise(9.0 + F.col("z")).alias("c"))
    ncc = F.col("ncc")
    return compare.similarity(pairs, ["z"]).select("z", F.when(~F.isnan(ncc), exprs.micro(F.nanvl(ncc, F.lit(0.0)))).alias("ncc_micro"))


@query(f"WITH {VE}, first AS (SELECT z, y AS py, x AS px, v AS pv, row_number() OVER (PARTITION BY z ORDER BY v DESC, y, x) AS n FROM ve) SELECT z, py, px, pv FROM first WHERE n = 1")
def peak_anchor(spark, sf_dir):
    return compare.peak(tables.embedding_volume(spark, sf_dir), ["z"])


_LINES_SQL = (
    "top AS (SELECT z, y AS py, x AS px, row_number() OVER (PARTITION BY z ORDER BY r DESC, y, x) AS n FROM both_), "
    "line AS (SELECT b.z, 'x' AS axis, py AS index, x AS pos, r, c FROM both_ b JOIN top t ON t.z = b.z AND n = 1 AND y = py UNION ALL SELECT b.z, 'y', px, y, r, c FROM both_ b JOIN top t ON t.z = b.z AND n = 1 AND x = px)"
)


@query(f"WITH {VE}, {VC}, {_BOTH}, {_LINES_SQL} SELECT z, axis, index, pos, r, c FROM line")
def peak_profiles(spark, sf_dir):
    return compare.profiles(compare.paired(*_both(spark, sf_dir)))


@query(None)
def profile_fit(spark, sf_dir):
    """Gaussian fits of the lines through every page's peak (tested on synthetic lines)."""
    lines = compare.profiles(compare.paired(*_both(spark, sf_dir)))
    return compare.fit_lines(lines.withColumn("v", F.col("r")), ["z", "axis"], DX)


@query(f"WITH {VE}, {VC}, {_BOTH}, {_LINES_SQL} SELECT z, axis, count(*) AS count, true AS stationary FROM line GROUP BY z, axis")
def profile_fit_stationary(spark, sf_dir):
    """Fits of peaks over the table's values are least-squares fits: the squared error has no slope there."""
    lines = compare.profiles(compare.paired(*_both(spark, sf_dir)))
    away = F.col("pos") - F.when(F.col("axis") == "x", 32).otherwise(12)
    lines = lines.withColumn("v", 100 * F.exp(-away * away / 32) + F.col("r") % 7)
    return compare.stationary(lines, compare.fit_lines(lines, ["z", "axis"], DX), ["z", "axis"])


@query(f"WITH {_VOLUMES} SELECT label, c.count, (CASE WHEN c.count >= size THEN k.range ELSE round_even(k.range * ((size - 1)::DOUBLE / (c.count - 1)), 0)::BIGINT END) AS index FROM sizes, (VALUES (4), (32), (7)) c(count), range(32) k WHERE k.range < least(size, c.count)")
def sample_pages(spark, sf_dir):
    """Evenly spread pages of every volume, for three sizes of the sample."""

    def picked(batches):
        for batch in batches:
            rows = [(label, count, i) for label, size in zip(batch["label"], batch["size"], strict=True) for count in (4, 32, 7) for i in geometry.sample_indices(int(size), count)]
            yield pd.DataFrame(rows, columns=["label", "count", "index"])

    return _volumes(spark, sf_dir).mapInPandas(picked, "label int, count int, index long")


_PICKED = "picked AS (SELECT DISTINCT CASE WHEN 8 >= nz - 2 THEN 1 + k.range ELSE 1 + round_even(k.range * ((nz - 3)::DOUBLE / 7), 0)::BIGINT END AS z FROM dims, range(8) k)"


@query(
    f"WITH {VE}, {VC}, {SIZE}, {_PICKED}, both_ AS (SELECT ve.z, ve.y - 1 AS y, ve.x - 2 AS x, ve.v AS r, vc.v AS c FROM ve JOIN vc USING (z, y, x) JOIN picked USING (z) WHERE ve.y BETWEEN 1 AND 23 AND ve.x BETWEEN 2 AND 61), {_pair_sql('z', 'both_')}, "
    f"{_LINES_SQL}, {_pair_sql('z, axis', 'line').replace('moments AS', 'line_moments AS').replace('FROM moments)', 'FROM line_moments)').replace('alike_ AS', 'line_alike_ AS')}, "
    f"pooled AS (SELECT avg(r) AS r_mean, avg(c) AS c_mean, stddev_pop(r) * {num(exprs.FWHM)} AS r_fwhm, stddev_pop(c) * {num(exprs.FWHM)} AS c_fwhm FROM both_), pages AS (SELECT count(*) AS samples, avg(ncc) AS ncc_mean, min(ncc) AS ncc_min, avg(ssim) AS ssim_mean, min(ssim) AS ssim_min FROM alike_), "
    "lined AS (SELECT count(*) AS profiles, avg(ncc) AS profile_ncc_mean, max(ssim) AS profile_ssim_max FROM line_alike_) "
    f"SELECT samples, profiles, {', '.join(f'{micro_sql(c)} AS {c}_micro' for c in ('r_mean', 'c_mean', 'r_fwhm', 'c_fwhm', 'ncc_mean', 'ncc_min', 'ssim_mean', 'ssim_min', 'profile_ncc_mean', 'profile_ssim_max'))}, {micro_sql('c_mean - r_mean')} AS mean_delta_micro FROM pooled, pages, lined"
)
def compare_summary(spark, sf_dir):
    shape = tables.embedding_shape(spark, sf_dir)
    s = compare.compare(*_both(spark, sf_dir), shape, samples=8, trim=(1, 1, 2), fits=False).summary
    named = {"r_mean": "r_mean", "c_mean": "c_mean", "r_fwhm": "r_fwhm", "c_fwhm": "c_fwhm", "ncc_mean": "ncc.mean", "ncc_min": "ncc.min", "ssim_mean": "ssim.mean", "ssim_min": "ssim.min", "profile_ncc_mean": "profile_ncc.mean", "profile_ssim_max": "profile_ssim.max", "mean_delta": "mean_delta"}
    return s.select("samples", "profiles", *[exprs.micro(F.col(c)).alias(f"{k}_micro") for k, c in named.items()])


# ---- stacking ----------------------------------------------------------------------------------------------


@query(f"WITH {VM}, d AS (SELECT volume_id, max(z) + 1 AS n FROM vm GROUP BY 1), f AS (SELECT volume_id, coalesce(sum(n) OVER (ORDER BY volume_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM d) SELECT volume_id, z + first AS z, y, x, v FROM vm JOIN f USING (volume_id)")
def concat_depth(spark, sf_dir):
    return project.concat_depth(tables.label_volumes(spark, sf_dir))


@query(f"WITH {VM}, s AS (SELECT volume_id, max(y) + 1 AS ny, max(x) + 1 AS nx FROM vm GROUP BY 1) SELECT ny, nx, count(*) AS volumes FROM s GROUP BY ny, nx")
def merge_shape_check(spark, sf_dir):
    return project.plane_shapes(tables.label_volumes(spark, sf_dir))


# ---- names and parameters ----------------------------------------------------------------------------------

#: Endings of the files that a listing of acquisitions shows in turn; the third and fourth, and some without one, are folders.
ENDINGS = [".tif", ".TIFF", ".ome.zarr", ".OME.ZARR", ".czi", ".nd2", ".lif", ".h5", ".hdf5", ".ozx", ".txt", "", ".Ome.Zarr", ".tiff"]
_NAME = (
    "(CASE WHEN doc_id % 5 = 0 THEN 'CH' || lpad(cast(doc_id % 4 AS {text}), 2, '0') || '_' || cast(doc_id AS {text}) || CASE WHEN doc_id % 2 = 1 THEN '_registered_consistent' ELSE '' END "
    "ELSE coalesce(lang, 'xx') || '.' || cast(doc_id AS {text}) END)"
)
_IS_DIR = "(doc_id % 14 IN (2, 3) OR doc_id % 14 = 11 AND doc_id % 3 = 0)"
_FILES = f"files AS (SELECT doc_id AS id, coalesce(source, '') AS folder, {_NAME.format(text='VARCHAR')} || {ENDINGS!r}[doc_id % 14 + 1] AS name, {_IS_DIR} AS is_dir FROM documents)"


def _files(spark, sf_dir):
    """A listing of acquisitions, a file or folder for each document: ``id``, ``folder``, ``name``, ``is_dir``."""
    ending = f"element_at(array({', '.join(map(repr, ENDINGS))}), cast(doc_id % 14 + 1 AS int))"
    return spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS id", "coalesce(source, '') AS folder", f"{_NAME.format(text='string')} || {ending} AS name", f"{_IS_DIR} AS is_dir")


_STEM = r"CASE WHEN lower(name) LIKE '%.ome.zarr' THEN left(name, length(name) - 9) WHEN name LIKE '_%.%' THEN regexp_replace(name, '\.[^.]*$', '') ELSE name END"


@query(f"WITH {_FILES} SELECT folder, name, (row_number() OVER (PARTITION BY folder ORDER BY name))::INTEGER AS position FROM files WHERE (is_dir AND lower(name) LIKE '%.ome.zarr') OR (NOT is_dir AND regexp_matches(lower(name), '\\.tiff?$'))")
def catalogue_discover(spark, sf_dir):
    from tessera.sources.discover import image_volumes

    return image_volumes(_files(spark, sf_dir), "folder")


@query(f"WITH {_FILES} SELECT name FROM files WHERE NOT (is_dir AND lower(name) LIKE '%.ome.zarr')")
def unsupported_inputs(spark, sf_dir):
    """What an archive export must refuse: everything that is no Zarr folder."""
    files = _files(spark, sf_dir)
    return files.join(files.where(names.is_zarr(F.col("name")) & F.col("is_dir")).select("name"), "name", "left_anti").select("name")


@query(f"WITH {_FILES} SELECT name, CASE WHEN is_dir THEN CASE WHEN lower(name) LIKE '%.ome.zarr' THEN 'zarr' END ELSE CASE regexp_extract(lower(name), '\\.([^.]*)$', 1) WHEN 'tif' THEN 'tiff' WHEN 'tiff' THEN 'tiff' WHEN 'czi' THEN 'czi' WHEN 'nd2' THEN 'nd2' WHEN 'lif' THEN 'lif' WHEN 'h5' THEN 'hdf5' WHEN 'hdf5' THEN 'hdf5' WHEN 'ozx' THEN 'archive' END END AS kind FROM files")
def reader_dispatch(spark, sf_dir):
    return _files(spark, sf_dir).select("name", names.kind(F.col("name"), F.col("is_dir")).alias("kind"))


@query(f"WITH {_FILES} SELECT name, {_STEM} AS stem, lower(name) LIKE '%.ome.zarr' AS is_zarr FROM files")
def stem_extract(spark, sf_dir):
    return _files(spark, sf_dir).select("name", names.stem(F.col("name")).alias("stem"), names.is_zarr(F.col("name")).alias("is_zarr"))


@query(f"WITH {_FILES} SELECT name, geometry, {_STEM} || CASE WHEN lower(name) LIKE '%.ome.zarr' OR geometry = 'affine' THEN '.ome.zarr' ELSE '.tif' END AS output FROM files, (VALUES ('top_view'), ('affine')) g(geometry)")
def output_names(spark, sf_dir):
    both = _files(spark, sf_dir).select("name", F.explode(F.array(*map(F.lit, params.GEOMETRIES))).alias("geometry"))
    return both.select("name", "geometry", names.output_name(F.col("name"), F.col("geometry")).alias("output"))


@query(f"WITH {_FILES} SELECT name, regexp_matches(name, '(?i)\\.(tif|tiff|czi|nd2|lif|h5|hdf5|ozx|ome\\.zarr)$') AS accepted FROM files")
def input_contract(spark, sf_dir):
    return _files(spark, sf_dir).select("name", F.col("name").rlike(names.INPUT_PATTERN).alias("accepted"))


@query(f"WITH {_FILES} SELECT channel, count(*) AS files FROM (SELECT regexp_extract(name, '^CH(\\d+)_(\\d+)(?:_registered_consistent)?\\.tiff?$', 1) AS channel FROM files) WHERE channel <> '' GROUP BY channel")
def channel_extract(spark, sf_dir):
    found = _files(spark, sf_dir).select(names.channel(F.col("name")).alias("channel")).where("channel <> ''")
    return found.groupBy("channel").agg(F.count("*").alias("files"))


#: Ways to write a list of patterns around a name.
_LISTED = (
    "CASE id % 6 WHEN 0 THEN '[' || name || ', b.tif]' WHEN 1 THEN chr(39) || 'x ' || name || chr(39) || ' , ' || chr(34) || 'z.nd2' || chr(34) WHEN 2 THEN name WHEN 3 THEN '[ ]' "
    "WHEN 4 THEN name || ',,b' ELSE '[' || chr(39) || 'q.ome.zarr' || chr(39) || ', ' || name || ' ]' END"
)


@query(
    f"WITH {_FILES}, p AS (SELECT id, {_LISTED} AS text FROM files), parts AS (SELECT id, unnest(regexp_split_to_array(regexp_replace(trim(text), '^\\[(.*)\\]$', '\\1'), '\\s*,\\s*')) AS part FROM p), "
    "bare AS (SELECT id, regexp_replace(regexp_replace(trim(part), '^[\\[''\"\\s]+', ''), '[\\]''\"\\s]+$', '') AS pattern FROM parts) SELECT id, pattern FROM bare WHERE pattern <> ''"
)
def input_patterns(spark, sf_dir):
    rows = _files(spark, sf_dir).selectExpr("id", f"{_LISTED} AS text")
    return rows.select("id", F.explode(names.input_patterns(F.col("text"))).alias("pattern"))


@query(
    f"WITH {_FILES}, b AS (SELECT id, id % 3 = 0 AS given, 'run_' || id % 10 AS output_dir, name FROM files) SELECT id, output_dir || '/Top_shear/' || ({_STEM}) || CASE WHEN given OR NOT name LIKE '_%.%' THEN '.ome.zarr' ELSE regexp_extract(name, '(\\.[^.]*)$', 1) END AS output FROM b"
)
def derive_output_path(spark, sf_dir):
    """Where the run of each acquisition puts its result: the first of its inputs counts, else the image path."""
    given = F.col("id") % 3 == 0
    inputs = F.when(given, F.array(F.concat(F.lit("/data/"), "name"), F.lit("/data/second.tif")))
    rows = _files(spark, sf_dir).select("id", inputs.alias("input"), F.concat(F.lit("/images/"), "name").alias("image_path"), F.concat(F.lit("run_"), (F.col("id") % 10).cast("string")).alias("output_dir"))
    return rows.select("id", names.derived_output(F.col("input"), F.col("image_path"), F.col("output_dir")).alias("output"))


_WORDS = ["true", "Yes", "ON", "0", "off", "", "maybe", "-1", "-1.0", "gpu", "CUDA", "cpu-blocked", "cpu", "cpu_block"]
_SPELT = "repeat(' ', cast(doc_id % 3 AS int)) || CASE WHEN doc_id % 4 = 0 THEN upper({word}) ELSE {word} END || repeat(' ', cast(doc_id % 2 AS int))"
_WORD_ROWS = f"w AS (SELECT doc_id AS id, {_SPELT.format(word=f'{_WORDS!r}[doc_id % 14 + 1]')} AS word FROM documents)"


@query(
    f"WITH {_WORD_ROWS} SELECT id, word, CASE WHEN lower(trim(word)) IN ('1', 'true', 'yes', 'on') THEN true WHEN lower(trim(word)) IN ('0', 'false', 'no', 'off', '') THEN false ELSE length(word) > 0 END AS flag, trim(word) NOT IN ('', '-1', '-1.0') AS supplied, "
    "CASE replace(lower(trim(CASE WHEN word = '' THEN 'cpu_blocked' ELSE word END)), '-', '_') WHEN 'gpu' THEN 'gpu' WHEN 'cuda' THEN 'gpu' WHEN 'cpu' THEN 'cpu_blocked' WHEN 'cpu_block' THEN 'cpu_blocked' WHEN 'cpu_blocked' THEN 'cpu_blocked' WHEN '' THEN 'cpu_blocked' END AS backend FROM w"
)
def param_coercion(spark, sf_dir):
    """Words that parameters are given in, by document, in several spellings."""
    spelt = f"element_at(array({', '.join(map(repr, _WORDS))}), cast(doc_id % 14 + 1 AS int))"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS id", f"{_SPELT.format(word=spelt)} AS word")
    word = F.lower(F.trim("word"))
    aliases = F.create_map(*[F.lit(x) for pair in params.BACKENDS.items() for x in pair])
    return rows.select(
        "id", "word", F.when(word.isin(*[w for w, on in params.SWITCHES.items() if on]), True).when(word.isin(*[w for w, on in params.SWITCHES.items() if not on]), False).otherwise(F.length("word") > 0).alias("flag"),
        (~F.trim("word").isin(*params.UNSET_WORDS)).alias("supplied"),
        F.element_at(aliases, F.regexp_replace(F.when(F.col("word") == "", "cpu_blocked").otherwise(word), "-", "_")).alias("backend"),
    )


_DIMS = "1 + doc_id % 2, 1 + doc_id % 3, 5, 1 + doc_id % 4, 1 + doc_id % 5"


@query(f"WITH s AS (SELECT doc_id AS id, list_slice([{_DIMS}], 1, 2 + doc_id % 4) AS dims FROM documents), k AS (SELECT id, list_filter(dims, lambda d: d <> 1) AS d FROM s) SELECT id, (CASE len(d) WHEN 3 THEN to_json(d) WHEN 2 THEN to_json(list_prepend(1, d)) END)::VARCHAR AS shape FROM k")
def rank_coercion(spark, sf_dir):
    """Singleton axes go, two axes become one plane, anything else is refused (null here)."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS id", f"slice(array({_DIMS}), 1, cast(2 + doc_id % 4 AS int)) AS dims")
    kept = F.filter("dims", lambda d: d != 1)
    shape = F.when(F.size(kept) == 3, kept).when(F.size(kept) == 2, F.concat(F.array(F.lit(1).cast("long")), kept))
    return rows.select("id", F.to_json(shape).alias("shape"))


_MEMBER = "CASE id % 5 WHEN 0 THEN 'a/' || name WHEN 1 THEN '../' || name WHEN 2 THEN '/etc/' || name WHEN 3 THEN name || '/../../b' ELSE 'a..b/' || name END"


@query(f"WITH {_FILES} SELECT id, path, NOT (path LIKE '/%' OR list_contains(string_split(path, '/'), '..')) AS safe FROM (SELECT id, {_MEMBER} AS path FROM files)")
def archive_member_check(spark, sf_dir):
    """Archive members by acquisition; those that lead outside are unsafe."""
    rows = _files(spark, sf_dir).selectExpr("id", f"{_MEMBER} AS path")
    return rows.select("id", "path", (~(F.col("path").startswith("/") | F.array_contains(F.split("path", "/"), ".."))).alias("safe"))


@query(f"WITH {VF}, s AS (SELECT z, avg(v) AS m FROM {_HOLES} GROUP BY z) SELECT z, CASE WHEN isfinite(m) THEN {micro_sql('m')} END AS mean_micro FROM s")
def json_safe_metrics(spark, sf_dir):
    """Numbers that are not finite are published as null."""
    found = _holes(spark, sf_dir).groupBy("z").agg(F.avg("v").alias("m"))
    safe = F.when(exprs.finite(F.col("m")), F.col("m"))
    return found.select("z", exprs.micro(safe).alias("mean_micro"))
