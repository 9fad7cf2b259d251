import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.exprs import FWHM
from tessera.operators import compare


def page(spark, values, z=0):
    return spark.createDataFrame([(z, y, x, float(v)) for y, row in enumerate(values) for x, v in enumerate(row)], "z long, y long, x long, v double")


def test_stats(spark):
    r = compare.intensity_stats(page(spark, [[0, 2, 4, float("nan"), float("inf")]]), ["z"]).first()
    assert (r["count"], r["mean"]) == (3, 2) and r["sigma"] == pytest.approx(np.std([0, 2, 4])) and r["fwhm"] == pytest.approx(FWHM * r["sigma"])
    assert compare.intensity_stats(page(spark, [[0, 2, 4]]), ["z"], ignore_zero=True).first()["count"] == 2
    none = compare.intensity_stats(page(spark, [[float("nan")]]), ["z"]).first()
    assert none["count"] == 0 and math.isnan(none["fwhm"])


@pytest.mark.parametrize(("r", "c", "ncc"), [([[1, 2], [3, 4]], [[1, 2], [3, 4]], 1), ([[5, 5]], [[7, 7]], 1), ([[5, 5]], [[7, 8]], None), ([[1, 2]], [[2, 1]], -1), ([[float("nan")]], [[1]], None)])
def test_similarity(spark, r, c, ncc):
    found = compare.similarity(compare.paired(page(spark, r), page(spark, c)), ["z"]).first()
    assert math.isnan(found["ncc"]) if ncc is None else found["ncc"] == pytest.approx(ncc)
    if r == c:
        assert found["ssim"] == pytest.approx(1)


def test_peak_is_the_first_in_row_order(spark):
    r = compare.peak(page(spark, [[1, 9, 2], [9, float("nan"), 9]]), ["z"]).first()
    assert (r["py"], r["px"], r["pv"]) == (0, 1, 9)


def test_gaussian_fit_recovers_its_parameters():
    x = np.arange(21.0)
    found = compare.fit_profile(x, compare.gaussian(x, np.array([10.0, 10.0, 2.0, 3.0])), 0.5)
    assert abs(found["sigma"]) == pytest.approx(2, abs=1e-6) and found["r2"] == pytest.approx(1) and found["fwhm"] == pytest.approx(FWHM)
    assert math.isnan(compare.fit_profile(x[:3], x[:3])["r2"]) and compare.fit_profile(x[:3], x[:3])["count"] == 3
    assert compare.fit_profile(x, np.full(21, 4.0))["r2"] == 1.0
    noisy = compare.gaussian(x, np.array([5.0, 8.0, 3.0, 1.0])) + np.random.default_rng(0).normal(0, 0.1, 21)
    assert compare.fit_profile(x, noisy)["r2"] > 0.98


def test_full_comparison(spark):
    line = np.exp(-((np.arange(9) - 4.0) ** 2) / 4)
    pages = [page(spark, np.outer(line, line) * (k + 1) * 100, k) for k in range(3)]
    volume = pages[0].union(pages[1]).union(pages[2])
    same = compare.compare(volume, volume, (3, 9, 9), samples=3)
    s = same.summary.first()
    assert s["samples"] == 3 and s["profiles"] == 6 and s["ncc"]["min"] == pytest.approx(1) and s["profile_r_r2"]["min"] > 0.999 and s["fwhm_delta"] == 0
    trimmed = compare.compare(volume, volume, (3, 9, 9), samples=4, trim=(1, 1, 0), fits=False)
    assert [r["z"] for r in trimmed.pages.collect()] == [1]
    across = compare.compare(volume, volume, (3, 9, 9), axis="x", samples=2, fits=False).pages.collect()
    assert sorted(r["z"] for r in across) == [0, 8]


def test_json_safe():
    assert compare.json_safe({"a": (1, float("nan")), 2: [np.float64("inf"), np.int64(3)]}) == {"a": [1, None], "2": [None, 3]}


def test_many_fits_equal_single_ones_and_are_stationary(spark):
    draw = np.random.default_rng(2)
    lines = []
    for k in range(60):
        n = int(draw.integers(2, 60))
        x = np.arange(n, dtype=float)
        y = compare.gaussian(x, np.array([draw.uniform(-5, 50), draw.uniform(0, n), draw.uniform(1, 5), draw.uniform(-3, 3)])) + draw.normal(0, draw.choice([0, 0.1, 2]), n)
        if k % 7 == 0:
            y[0] = np.nan
        lines.append((x, y))
    lines += [(np.arange(9.0), np.full(9, 4.0)), (np.arange(0.0), np.arange(0.0))]
    together = compare.fit_profiles(lines, 0.5)
    for line, found in zip(lines, together, strict=True):
        alone = compare.fit_profile(*line, 0.5)
        assert found["count"] == alone["count"]
        assert all(found[k] == pytest.approx(alone[k], rel=1e-6, abs=1e-6, nan_ok=True) for k in found)
    rows = [(k, float(x), None if np.isnan(y) else float(y)) for k, (xs, ys) in enumerate(lines) for x, y in zip(xs, ys, strict=True)]
    table = spark.createDataFrame(rows, "k int, pos double, v double")
    fits = compare.fit_lines(table, ["k"])
    assert {r["k"]: r["count"] for r in fits.collect()} == {k: f["count"] for k, f in enumerate(together) if len(lines[k][0])}
    checked = {r["k"]: r["stationary"] for r in compare.stationary(table, fits, ["k"]).collect()}
    assert all(checked[k] is True for k, f in enumerate(together) if not np.isnan(f["sigma"]) and k in checked)
    moved = compare.stationary(table, fits.withColumn("sigma", F.col("sigma") * 1.01), ["k"]).where("stationary").count()
    assert moved < 10
