"""Comparison of two volumes: statistics, correlation, similarity, profiles and fits."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import FWHM, finite
from tessera.functions.geometry import sample_indices

#: Voxels this close relative to the page's level count as equal where a page is constant.
CLOSE = 1e-8
NAN = float("nan")


def intensity_stats(volume: DataFrame, keys: list[str], value: str = "v", ignore_zero: bool = False) -> DataFrame:
    """Count, mean, population sigma and FWHM of the finite values of each group; without values 0 and NaN."""
    v = F.col(value)
    kept = finite(v) & (v != 0) if ignore_zero else finite(v)
    used = F.when(kept, v)
    rows = volume.groupBy(*keys).agg(F.count(used).alias("count"), F.avg(used).alias("mean"), F.stddev_pop(used).alias("sigma"))
    return rows.select(*keys, "count", F.coalesce("mean", F.lit(NAN)).alias("mean"), F.coalesce("sigma", F.lit(NAN)).alias("sigma"), F.coalesce(F.col("sigma") * FWHM, F.lit(NAN)).alias("fwhm"))


def paired(reference: DataFrame, candidate: DataFrame, keys: tuple[str, ...] = ("z", "y", "x")) -> DataFrame:
    """Voxels of both volumes side by side as ``r`` and ``c``."""
    return reference.select(*keys, F.col("v").alias("r")).join(candidate.select(*keys, F.col("v").alias("c")), list(keys))


def similarity(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``ncc`` and ``ssim`` of each group over the pairs that are finite on both sides.

    One aggregate of moments about the means. Two constant groups correlate to
    1 (the values are centred first), a constant and a varying one to NaN. SSIM's
    range is at least 1.
    """
    both = finite(F.col("r")) & finite(F.col("c"))
    r, c = F.when(both, F.col("r")), F.when(both, F.col("c"))
    rows = pairs.groupBy(*keys).agg(
        F.count(r).alias("n"), F.avg(r).alias("mr"), F.avg(c).alias("mc"), F.var_pop(r).alias("vr"), F.var_pop(c).alias("vc"), F.covar_pop(r, c).alias("rc"),
        F.greatest(F.max(r), F.max(c)).alias("hi"), F.least(F.min(r), F.min(c)).alias("lo"),
    )
    span = F.greatest(F.lit(1.0), F.col("hi") - F.col("lo"))
    c1, c2 = F.pow(0.01 * span, F.lit(2.0)), F.pow(0.03 * span, F.lit(2.0))
    return rows.select(*keys, "n", _ncc().alias("ncc"), F.when(F.col("n") == 0, NAN).otherwise(
        (2 * F.col("mr") * F.col("mc") + c1) * (2 * F.col("rc") + c2) / ((F.col("mr") ** 2 + F.col("mc") ** 2 + c1) * (F.col("vr") + F.col("vc") + c2))).alias("ssim"))


def _ncc() -> Column:
    spread = F.sqrt(F.col("vr") * F.col("vc"))
    constant = (F.col("vr") == 0) & (F.col("vc") == 0)
    return F.when(F.col("n") == 0, NAN).when(constant, 1.0).when(spread == 0, NAN).otherwise(F.col("rc") / spread)


def peak(volume: DataFrame, keys: list[str]) -> DataFrame:
    """First largest finite voxel in row order of each group: ``py``, ``px``, ``pv``."""
    best = F.max(F.struct(F.col("v"), (-F.col("y")).alias("y"), (-F.col("x")).alias("x")))
    return volume.where(finite(F.col("v"))).groupBy(*keys).agg(best.alias("b")).select(*keys, (-F.col("b.y")).alias("py"), (-F.col("b.x")).alias("px"), F.col("b.v").alias("pv"))


def profiles(pairs: DataFrame) -> DataFrame:
    """Lines along x and y through the reference page's peak: ``z``, ``axis``, ``index``, ``pos``, ``r``, ``c``."""
    anchor = peak(pairs.select("z", "y", "x", F.col("r").alias("v")), ["z"])
    on = pairs.join(anchor, "z").where((F.col("y") == F.col("py")) | (F.col("x") == F.col("px")))
    lines = F.array(
        F.struct(F.lit("x").alias("axis"), F.col("py").alias("index"), F.col("x").alias("pos"), (F.col("y") == F.col("py")).alias("on")),
        F.struct(F.lit("y").alias("axis"), F.col("px").alias("index"), F.col("y").alias("pos"), (F.col("x") == F.col("px")).alias("on")),
    )
    return on.select("z", F.explode(lines).alias("l"), "r", "c").where("l.on").select("z", "l.axis", "l.index", "l.pos", "r", "c")


def gaussian(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """amplitude * exp(-(x - centre)^2 / (2 sigma^2)) + base, for p = amplitude, centre, sigma, base; one line or many (rows)."""
    a, centre, sigma, base = np.moveaxis(np.asarray(p)[..., None], -2, 0)
    return a * np.exp(-((x - centre) ** 2) / (2 * sigma**2)) + base


def _slopes(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    a, centre, sigma, _ = np.moveaxis(p[..., None], -2, 0)
    d = x - centre
    e = np.exp(-(d**2) / (2 * sigma**2))
    return np.stack([e, a * e * d / sigma**2, a * e * d**2 / sigma**3, np.ones_like(e)], axis=-1)


def _steps(a: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Solutions of many small systems; NaN where one is singular."""
    try:
        return np.linalg.solve(a, g[..., None])[..., 0]
    except np.linalg.LinAlgError:
        if len(a) == 1:
            return np.full(g.shape, NAN)
        return np.concatenate([_steps(a[k : k + 1], g[k : k + 1]) for k in range(len(a))])


def levenberg_marquardt(x: np.ndarray, y: np.ndarray, known: np.ndarray, start: np.ndarray, most: int = 2000) -> np.ndarray:
    """Least-squares Gaussians of many lines (rows) at once by damped Gauss-Newton steps; NaN where one doesn't settle.

    Every line has its own damping and leaves when it has settled. Points that aren't ``known`` have no weight.
    """
    out = np.full(start.shape, NAN)
    line = np.arange(len(x))
    p, damp = start.astype(float), np.full(len(x), 1e-3)
    with np.errstate(all="ignore"):
        miss = np.where(known, y - gaussian(x, p), 0.0)
        loss = (miss**2).sum(axis=1)
        for _ in range(most):
            if not len(line):
                break
            j = np.where(known[..., None], _slopes(x, p), 0.0)
            a, g = np.einsum("nmi,nmj->nij", j, j), np.einsum("nmi,nm->ni", j, miss)
            scale = np.einsum("nii->ni", a) + 1e-12
            step = _steps(a + np.eye(4) * (damp[:, None] * scale)[:, None, :], g)
            singular = np.isnan(step).all(axis=1)
            new = p + step
            left = np.where(known, y - gaussian(x, new), 0.0)
            new_loss = (left**2).sum(axis=1)
            better = (new[:, 2] != 0) & np.isfinite(new).all(axis=1) & (new_loss <= loss)
            small = (loss - new_loss <= 1e-15 * np.maximum(loss, 1e-300)) & (np.abs(step).max(axis=1) <= 1e-10 * (np.abs(p).max(axis=1) + 1e-10))
            settled = better & (small | (new_loss == 0))
            p, miss, loss = np.where(better[:, None], new, p), np.where(better[:, None], left, miss), np.where(better, new_loss, loss)
            damp = np.where(better, np.maximum(damp / 10, 1e-14), damp * 10)
            settled |= ~better & ~singular & (damp > 1e14)
            out[line[settled]] = p[settled]
            stay = ~settled & ~singular
            line, x, y, known, p, miss, loss, damp = (v[stay] for v in (line, x, y, known, p, miss, loss, damp))
    return out


NAMES = ("amplitude", "x_offset", "sigma", "y_offset")


def fit_profiles(lines: list[tuple[np.ndarray, np.ndarray]], pixel: float = 1.0) -> list[dict[str, float]]:
    """Gaussians through lines (x, y): count, fwhm, amplitude, x_offset, sigma, y_offset, r2; NaN under four points.

    Starts at the range, the index of the maximum, sigma 3 and the minimum. Sigma keeps its sign.
    """
    known = [np.isfinite(x) & np.isfinite(y) for x, y in lines]
    lines = [(x[k], y[k]) for (x, y), k in zip(lines, known, strict=True)]
    out = [{"count": len(x), "fwhm": NAN, **dict.fromkeys(NAMES, NAN), "r2": NAN} for x, _ in lines]
    long = [i for i, (x, _) in enumerate(lines) if len(x) >= 4]
    if not long:
        return out
    width = max(len(lines[i][0]) for i in long)
    x, y, some = np.zeros((len(long), width)), np.zeros((len(long), width)), np.zeros((len(long), width), bool)
    for row, i in enumerate(long):
        n = len(lines[i][0])
        x[row, :n], y[row, :n], some[row, :n] = *lines[i], True
    start = np.array([[lines[i][1].max() - lines[i][1].min(), float(np.argmax(lines[i][1])), 3.0, lines[i][1].min()] for i in long])
    for i, p in zip(long, levenberg_marquardt(x, y, some, start), strict=True):
        if np.isnan(p).any():
            continue
        own, values = lines[i]
        rest, total = ((values - gaussian(own, p)) ** 2).sum(), ((values - values.mean()) ** 2).sum()
        r2 = (1.0 if np.allclose(values, gaussian(own, p)) else NAN) if total == 0 else 1 - rest / total
        out[i] |= dict(zip(NAMES, map(float, p), strict=True)) | {"fwhm": FWHM * float(p[2]) * pixel, "r2": float(r2)}
    return out


def fit_profile(x: np.ndarray, y: np.ndarray, pixel: float = 1.0) -> dict[str, float]:
    """``fit_profiles`` of one line."""
    return fit_profiles([(np.asarray(x, float), np.asarray(y, float))], pixel)[0]


FIT = "count long, fwhm double, amplitude double, x_offset double, sigma double, y_offset double, r2 double"
#: Values of lines that are fitted together.
FIT_VALUES = 1 << 18


def fit_lines(lines: DataFrame, keys: list[str], pixel: float = 1.0, position: str = "pos", value: str = "v") -> DataFrame:
    """Fit every group's line, many lines at a time; a group is one image line, gathered to an array."""
    kinds = dict(lines.dtypes)
    points = F.sort_array(F.collect_list(F.struct(F.col(position).cast("double").alias("x"), F.col(value).cast("double").alias("y"))))
    gathered = lines.groupBy(*keys).agg(points.alias("_line")).select(*keys, F.col("_line.x").alias("_x"), F.col("_line.y").alias("_y"))
    names = [c.split()[0] for c in FIT.split(", ")]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(batch.column(len(keys)).value_lengths().to_numpy()) // FIT_VALUES
            for run in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(sizes)) + 1):
                part = batch.slice(run[0], len(run)) if len(run) else batch
                xs, ys = (part.column(len(keys) + k) for k in (0, 1))
                found = fit_profiles([tuple(v.values.fill_null(NAN).to_numpy() for v in pair) for pair in zip(xs, ys, strict=True)], pixel)
                values = [pa.array([f[n] for f in found], pa.int64() if n == "count" else pa.float64()) for n in names]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *values], names=[*keys, *names])

    return gathered.mapInArrow(fit, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", " + FIT)


def stationary(lines: DataFrame, fits: DataFrame, keys: list[str], position: str = "pos", value: str = "v", tolerance: float = 1e-5) -> DataFrame:
    """Whether the squared error's gradient is zero at each fit, in columns only: ``keys``, ``count``, ``stationary``.

    Every partial derivative is measured against the lengths of the residual and of the slope, so the
    test has no unit. Lines without a fit (under four points, or unsettled) have null.
    """
    d = F.col(position) - F.col("x_offset")
    e = F.exp(-d * d / (2 * F.col("sigma") * F.col("sigma")))
    miss = F.col(value) - (F.col("amplitude") * e + F.col("y_offset"))
    slopes = [e, F.col("amplitude") * e * d / F.pow("sigma", F.lit(2)), F.col("amplitude") * e * d * d / F.pow("sigma", F.lit(3)), F.lit(1.0)]
    known = lines.where(finite(F.col(value))).join(fits.select(*keys, "count", *NAMES), keys)
    sums = [F.sum(miss * s).alias(f"g{i}") for i, s in enumerate(slopes)] + [F.sum(s * s).alias(f"a{i}") for i, s in enumerate(slopes)]
    summed = known.groupBy(*keys, "count").agg(*sums, F.sum(miss * miss).alias("rest"), F.sum(F.col(value) * F.col(value)).alias("all"), F.first("sigma").alias("sigma"))
    floor = 1e-20 * F.col("all")  # an exact fit leaves only rounding
    flat = [F.col(f"g{i}") * F.col(f"g{i}") <= tolerance**2 * F.col(f"a{i}") * F.greatest("rest", floor) + F.lit(1e-300) for i in range(4)]
    met = flat[0] & flat[1] & flat[2] & flat[3]
    return summed.select(*keys, "count", F.when(~F.isnan("sigma"), met).alias("stationary"))


@dataclass(frozen=True)
class Comparison:
    """DataFrames of one comparison: per page, per profile, and one summary row."""

    pages: DataFrame
    lines: DataFrame
    summary: DataFrame


def summary_of(values: Column) -> Column:
    used = F.when(finite(values), values)
    return F.struct(F.coalesce(F.avg(used), F.lit(NAN)).alias("mean"), F.coalesce(F.min(used), F.lit(NAN)).alias("min"), F.coalesce(F.max(used), F.lit(NAN)).alias("max"))


def compare(reference: DataFrame, candidate: DataFrame, shape: tuple[int, int, int], axis: str = "z", samples: int = 32, trim: tuple[int, int, int] = (0, 0, 0), ignore_zero: bool = False, pixel: float = 1.0, fits: bool = True) -> Comparison:
    """Compare two volumes of one shape on evenly spread pages of an axis.

    Pages keep their absolute index; profile positions and anchors count within
    the cropped page. Only sampled pages are read.
    """
    from tessera.operators.project import AXES
    from tessera.operators.project import trim as cropped

    at = AXES.index(axis)
    index = [trim[at] + i for i in sample_indices(shape[at] - 2 * trim[at], samples)]
    rest = [a for a in AXES if a != axis]
    chosen = [cropped(v, shape, trim).where(F.col(axis).isin(index)) for v in (reference, candidate)]
    pairs = paired(*chosen)
    page = pairs.select(F.col(axis).alias("z"), *[(F.col(a) - trim[AXES.index(a)]).alias(n) for a, n in zip(rest, ("y", "x"), strict=True)], "r", "c")
    sides = [intensity_stats(page.withColumn("v", F.col(s)), ["z"], "v", ignore_zero).select("z", F.col("fwhm").alias(f"{s}_fwhm")) for s in "rc"]
    pages = similarity(page, ["z"]).join(sides[0], "z").join(sides[1], "z")
    own = profiles(page)
    lines = similarity(own, ["z", "axis", "index"]).drop("n")
    if fits:
        for side in "rc":
            found = fit_lines(own.select("z", "axis", F.col("pos"), F.col(side).alias("v")), ["z", "axis"], pixel)
            lines = lines.join(found.select("z", "axis", F.col("fwhm").alias(f"{side}_fwhm"), F.col("r2").alias(f"{side}_r2")), ["z", "axis"])
        lines = lines.withColumns({"fwhm_delta": F.col("c_fwhm") - F.col("r_fwhm"), "r2_delta": F.col("c_r2") - F.col("r_r2")})
    pooled = [intensity_stats(page.withColumn("v", F.col(s)), [], "v", ignore_zero).select(F.col("mean").alias(f"{s}_mean"), F.col("fwhm").alias(f"{s}_fwhm")) for s in "rc"]
    of_pages = pages.agg(summary_of(F.col("ncc")).alias("ncc"), summary_of(F.col("ssim")).alias("ssim"), F.count("*").alias("samples"))
    of_lines = lines.agg(F.count("*").alias("profiles"), *[summary_of(F.col(c)).alias(f"profile_{c}") for c in lines.columns if c not in ("z", "axis", "index")])
    summary = pooled[0].crossJoin(pooled[1]).crossJoin(of_pages).crossJoin(of_lines)  # one row each
    return Comparison(pages, lines, summary.withColumns({"mean_delta": F.col("c_mean") - F.col("r_mean"), "fwhm_delta": F.col("c_fwhm") - F.col("r_fwhm")}))


def json_safe(value):
    """Nested values with numbers that are not finite as null."""
    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v) for v in value]
    if isinstance(value, np.generic):
        value = value.item()
    return None if isinstance(value, float) and not math.isfinite(value) else value
