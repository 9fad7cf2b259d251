import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.functions import geometry as g
from tessera.operators import block_resample, project, resample
from tessera.sources import blocks, tables


def cube(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["z"], r["y"], r["x"]] = r["v"]
    return out


def counting(spark, shape):
    return tables.grid(spark, shape).selectExpr("z", "y", "x", f"cast(z * {shape[1] * shape[2]} + y * {shape[2]} + x as double) as v")


def test_top_view_golden(spark):
    out = cube(resample.top_view_volume(counting(spark, (3, 5, 4)), g.top_view((3, 5, 4), 1, 1, 30)), (1, 7, 4))
    want = [[0, 0, 12, 0], [10, 11, 35, 0], [10, 34, 34, 39], [32, 37, 38, 43], [36, 41, 41, 46], [0, 40, 45, 46], [0, 44, 28, 28]]
    assert out[0].tolist() == want


def plain_top_view(v, dx, dz, angle, flip):
    """The published steps one by one, in exact fractions up to the rotation: shear, neighbour mean, depth, nearest rotation."""
    nz, ny, nx = v.shape
    shift = [round(flip * (k + 1 - (nz // 2 + 1)) * (dz * math.cos(math.radians(angle)) / dx)) for k in range(nz)]
    margin = max(map(abs, shift))
    tall, deep = ny + 2 * margin, max(1, round(nz * (dz * math.sin(math.radians(angle)) / dx)))
    t = math.radians(-flip * angle)

    def sample(z, y, x):
        y -= shift[z] + margin
        return Fraction(int(v[z, y, x])) if 0 <= y < ny else Fraction(0)

    def mean(z, y, x):
        return sample(z, y, x) if z == nz - 1 else (sample(z, y, x) + sample(z + 1, y, x)) / 2

    out = np.zeros((deep, tall, nx))
    for k in range(deep):
        q = min(max((k + 0.5) * nz / deep - 0.5, 0.0), float(nz - 1))
        low = math.floor(q)
        w = Fraction(q - low)
        for y in range(tall):
            for x in range(nx):
                cy, cx = y - (tall - 1) / 2, x - (nx - 1) / 2
                sy, sx = round(math.cos(t) * cy - math.sin(t) * cx + (tall - 1) / 2), round(math.sin(t) * cy + math.cos(t) * cx + (nx - 1) / 2)
                if 0 <= sy < tall and 0 <= sx < nx:
                    out[k, y, x] = (1 - w) * mean(low, sy, sx) + w * mean(min(low + 1, nz - 1), sy, sx)
    return out


@pytest.mark.parametrize(("shape", "dx", "dz", "angle", "flip"), [((3, 5, 4), 1, 1, 30, 1), ((8, 16, 12), 0.168, 0.2, 45, 1), ((9, 14, 10), 0.108, 0.3, 40, -1)])
def test_top_view_forms_agree(spark, shape, dx, dz, angle, flip):
    view = g.top_view(shape, dx, dz, angle, flip)
    volume = tables.synthetic_volume(spark, shape)
    exact = plain_top_view(cube(volume, shape), dx, dz, angle, flip)
    for rounding in ("half_even", "half_up"):
        voxels = cube(resample.top_view_volume(volume, view, rounding), view.shape)
        assert not np.isnan(voxels).any()
        # values within a millionth of a tie are ties (rounded as such); all others round as the exact value does
        tie = np.abs(exact % 1 - 0.5) < 1e-6
        want = np.where(tie, np.floor(exact) + 0.5, exact)
        assert (voxels == (np.rint(want) if rounding == "half_even" else np.floor(want + 0.5))).all()
        packed = blocks.synthetic_planes(spark, shape, 3)
        assert (cube(blocks.to_voxels(block_resample.top_view_planes(packed, view, rounding).drop("k")), view.shape) == voxels).all()


@pytest.mark.parametrize(
    ("shape", "dx", "dz", "angle", "flip", "rotate", "total"),
    [((4, 6, 5), 1, 1, 30, 1, True, 4161295.2031), ((8, 16, 12), 0.168, 0.2, 45, 1, True, 50340728.457), ((7, 10, 16), 0.108, 0.3, 40, -1, True, 35329342.7364), ((8, 16, 12), 0.168, 0.2, 45, 1, False, 50122604.2231), ((4, 6, 5), 1, 1, 0, 1, True, 3921544)],
)
def test_affine_forms_agree(spark, shape, dx, dz, angle, flip, rotate, total):
    a = g.affine(shape, dx, dz, angle, flip, rotate)
    volume = tables.synthetic_volume(spark, shape)
    voxels = cube(resample.affine_volume(volume, a), a.shape)
    assert voxels.sum() == pytest.approx(total, abs=0.01)
    slabs = block_resample.affine_blocks(blocks.synthetic_planes(spark, shape, 2), a, "float32", (3, 7, 5))
    assert np.allclose(cube(blocks.to_voxels(slabs), a.shape), voxels, rtol=1e-6, atol=1e-2)
    whole = block_resample.affine_blocks(blocks.synthetic_planes(spark, shape, 2), a, "uint16", (64, 4, 64))
    assert (cube(blocks.to_voxels(whole), a.shape) == cube(resample.affine_volume(volume, a, "uint16"), a.shape)).all()
    if angle == 0:
        assert (voxels == cube(volume, shape)).all()


def test_affine_golden_line(spark):
    a = g.affine((4, 6, 5), 1, 1, 30)
    out = cube(resample.affine_volume(counting(spark, (4, 6, 5)), a), a.shape)
    assert out[2, :, 0] == pytest.approx([2.332532, 7.422278, 25.502405, 43.582532, 61.662659, 79.742786, 97.822913, 113.893421], abs=1e-5)


def test_shear_keeps_the_sum_and_pyramid_levels_nest(spark):
    shape = (5, 9, 8)
    volume = tables.synthetic_volume(spark, shape)
    view = g.top_view(shape, 0.168, 0.2, 45)
    assert resample.sheared(volume, view).agg({"v": "sum"}).first()[0] == volume.agg({"v": "sum"}).first()[0]
    base = cube(volume, shape)
    levels = resample.pyramid(volume, [1, 2, 4])
    for i, f in enumerate((1, 2, 4)):
        want = base[:, ::f, ::f]
        assert (cube(levels.where(levels.level == i), want.shape) == want).all()
    assert (cube(project.stride(volume, 2), base[:, ::2, ::2].shape) == base[:, ::2, ::2]).all()
    with pytest.raises(ValueError, match="stride"):
        project.stride(volume, 0)
    with pytest.raises(ValueError, match="trimming"):
        project.trim(volume, shape, (3, 0, 0))


def test_support_at_the_half_voxel_edge(spark):
    line = spark.createDataFrame([(0, 0, 0, 10.0), (0, 0, 1, 20.0)], "z long, y long, x long, v double")
    for x, want in ((-0.5, 10), (-0.5001, 0), (1.5, 20), (1.5001, 0)):
        one = g.affine((1, 1, 2), 1, 1, 0)
        moved = g.Affine(one.source, (1, 1, 1), one.voxel, (x, 0.0, 0.0), one.matrix, one.offset, one.inverse, (0.0, 0.0, 0.0), 0.0, 0.0)
        assert resample.affine_volume(line, moved).first()["v"] == want


def test_planes_and_voxels_round_trip(spark):
    shape = (5, 7, 6)
    volume = tables.synthetic_volume(spark, shape)
    packed = blocks.from_voxels(volume, shape, (2, 4, 4))
    assert (cube(blocks.to_voxels(packed), shape) == cube(volume, shape)).all()
    whole = blocks.planes(packed, shape)
    assert whole.count() == 5 and (cube(blocks.to_voxels(whole), shape) == cube(volume, shape)).all()
    strided = block_resample.pyramid_planes(whole, [1, 2])
    assert (cube(blocks.to_voxels(strided.where("level = 1")), (5, 4, 3)) == cube(volume, shape)[:, ::2, ::2]).all()


def single_top_view(v, view):
    """Single precision with numpy's own float32, voxel by voxel in the published order."""
    frame = np.zeros((view.z, view.shear_y, view.x), np.float32)
    for z, o in enumerate(view.offsets):
        frame[z, o + view.margin : o + view.margin + view.y] = v[z]
    half = np.float32(0.5)
    mean = [frame[z] if z == view.z - 1 else half * (frame[z] + frame[z + 1]) for z in range(view.z)]
    out = []
    for k in range(view.scaled_z):
        low, high, w = view.depth(k)
        w = np.float32(w)
        out.append(np.float32(1.0 - float(w)) * mean[low] + w * mean[high])
    t = np.array(out)
    cy, cx = (view.shear_y - 1) / 2.0, (view.x - 1) / 2.0
    yy, xx = np.arange(view.shear_y)[:, None] - cy, np.arange(view.x)[None] - cx
    sy, sx = np.rint(view.cos * yy - view.sin * xx + cy).astype(int), np.rint(view.sin * yy + view.cos * xx + cx).astype(int)
    inside = (sy >= 0) & (sy < view.shear_y) & (sx >= 0) & (sx < view.x)
    return np.clip(np.rint(np.where(inside, t[:, np.clip(sy, 0, view.shear_y - 1), np.clip(sx, 0, view.x - 1)], np.float32(0))), 0, 65535)


@pytest.mark.parametrize(("shape", "dx", "dz", "angle", "flip", "total"), [((8, 16, 12), 0.168, 0.2, 45, 1, 36_414_892), ((9, 14, 10), 0.108, 0.3, 40, -1, None), ((1, 5, 4), 1, 1, 30, 1, None), ((2, 5, 4), 1, 2, 60, 1, None)])
def test_single_precision(spark, shape, dx, dz, angle, flip, total):
    view = g.top_view(shape, dx, dz, angle, flip)
    volume = tables.synthetic_volume(spark, shape)
    want = single_top_view(cube(volume, shape), view)
    voxels = cube(resample.top_view_volume(volume, view, arithmetic="float32"), view.shape)
    assert (voxels == want).all() and total in (None, int(voxels.sum()))
    packed = blocks.synthetic_planes(spark, shape, 3)
    assert (cube(blocks.to_voxels(block_resample.top_view_planes(packed, view, arithmetic="float32").drop("k")), view.shape) == want).all()


@pytest.mark.parametrize(("z", "scaled"), [(10, 4), (9, 8), (7, 1), (5, 5), (4, 9), (1, 3), (2, 1)])
def test_antialiased_depth(spark, z, scaled):
    view = g.TopView(z, 2, 3, (0,) * z, 0, 2, scaled, 1.0, 0.0)
    volume = tables.synthetic_volume(spark, (z, 2, 3))
    got = cube(resample.depth_resized(volume, view, antialias=True), (scaled, 2, 3))
    v = cube(volume, (z, 2, 3))
    ratio = scaled / z
    for k in range(scaled):
        # the kernel by its published form, over the mirrored axis
        u = (k + 1) / ratio + 0.5 * (1 - 1 / ratio)
        shrink = min(ratio, 1.0)
        taps = [(i, shrink * max(0.0, 1 - abs(shrink * (u - i)))) for i in range(math.floor(u - 2 / shrink) - 1, math.ceil(u + 2 / shrink) + 2)]
        mirrored = [*range(z), *reversed(range(z))]
        want = sum(w * v[mirrored[(i - 1) % (2 * z)]] for i, w in taps) / sum(w for _, w in taps)
        assert np.allclose(got[k], want, rtol=1e-12)
    if scaled >= z:
        assert np.allclose(got, cube(resample.depth_resized(volume, view), got.shape), rtol=1e-12)


def test_tiles_over_a_block_are_those_that_need_it():
    for shape, dx, dz, angle, flip, rotate in (((8, 16, 12), 0.168, 0.2, 45, 1, True), ((7, 10, 16), 0.108, 0.3, 40, -1, True), ((9, 12, 5), 0.2, 0.5, 30, 1, False), ((4, 6, 5), 1, 1, 0, 1, True)):
        a, tile = g.affine(shape, dx, dz, angle, flip, rotate), (3, 4, 5)
        keys = list(np.ndindex(*block_resample.tile_counts(a, tile)))
        boxes = {k: block_resample.source_box(a, block_resample.tile_ranges(a, tile, k)) for k in keys}
        for at in np.ndindex(shape[0], 3, 2):
            at = (at[0], at[1] * 4, at[2] * 3)
            size = tuple(min(s, n - p) for s, n, p in zip((1, 4, 3), shape, at, strict=True))
            if min(size) < 1:
                continue
            found = set(block_resample.tiles_over(a, tile, at, size))
            # every tile with a voxel whose taps reach the block
            need = set()
            for k in keys:
                own = block_resample.tile_ranges(a, tile, k)
                grid = np.stack(np.meshgrid(*own, indexing="ij"), -1).reshape(-1, 3)
                f = np.stack([grid @ np.array(row[:3]) + row[3] for row in a.to_source()], -1)
                low = np.floor(f)
                weight = lambda d: np.where(np.array(d) == 1, f - low, 1 - (f - low)).min(1) > 1e-9  # noqa: E731, B023
                if any((weight(d) & ((low + d >= at) & (low + d < np.add(at, size))).all(1)).any() for d in np.ndindex(2, 2, 2)):
                    need.add(k)
            assert need <= found
            assert all(lo < hi for k in need for lo, hi in [(max(b[0], p), min(b[1], p + n)) for b, p, n in zip(boxes[k], at, size, strict=True)])


def test_a_block_looks_at_its_own_tiles_only():
    """The largest geometry in use: a plane's part meets few of thousands of tiles."""
    a = g.affine((500, 2024, 128), 0.108, 0.3, 45)
    counts = block_resample.tile_counts(a, (64, 256, 64))
    seen = [len(list(block_resample.tiles_over(a, (64, 256, 64), (z, y, 0), (1, 256, 128)))) for z in (0, 250, 499) for y in (0, 768, 1792)]
    assert max(seen) <= 60 and math.prod(counts) > 200


def deep(spark, flip=1):
    """A volume so deep that its sheared frame is mostly empty, and its top view."""
    volume = tables.synthetic_volume(spark, (120, 3, 16))
    return volume, g.top_view((120, 3, 16), 0.168, 0.2, 45.0, flip)


def shuffled(df):
    """Most rows that an exchange of a run query writes."""
    df.collect()
    nodes, most = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                most = max(most, node.metrics().get("shuffleRecordsWritten").get().value())
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return most


def looked_up(planes, view):
    """Rotation of (planes, shear_y, x) by nearest neighbour."""
    cy, cx = (view.shear_y - 1) / 2, (view.x - 1) / 2
    yy, xx = np.arange(view.shear_y)[:, None] - cy, np.arange(view.x)[None] - cx
    sy, sx = np.rint(view.cos * yy - view.sin * xx + cy).astype(int), np.rint(view.sin * yy + view.cos * xx + cx).astype(int)
    inside = (sy >= 0) & (sy < view.shear_y) & (sx >= 0) & (sx < view.x)
    return np.where(inside, planes[:, np.clip(sy, 0, view.shear_y - 1), np.clip(sx, 0, view.x - 1)], 0.0)


def test_rotation_of_planes_shuffles_no_empty_cells(spark):
    """F16: every cell of the frame was shuffled, the empty ones too."""
    volume, view = deep(spark)
    out = resample.rotated_nearest(resample.sheared(volume, view), view)
    assert shuffled(out) < 120 * 3 * 16
    base, planes = cube(volume, (120, 3, 16)), np.zeros((120, view.shear_y, 16))
    for z, o in enumerate(view.offsets):
        planes[z, o + view.margin : o + view.margin + 3] = base[z]
    assert out.count() == planes.size and (cube(out, planes.shape) == looked_up(planes, view)).all()


@pytest.mark.parametrize(("rounding", "flip", "arithmetic"), [("half_up", 1, "float64"), ("half_even", 1, "float32"), ("half_even", -1, "float64"), ("half_even", 1, "float64")])
def test_top_view_shuffles_no_empty_cells(spark, rounding, flip, arithmetic):
    """F18 to F21: the top view's frame grows with the square of the depth; its empty cells were shuffled."""
    volume, view = deep(spark, flip)
    out = resample.top_view_volume(volume, view, rounding, arithmetic=arithmetic)
    assert shuffled(out) < 3 * 120 * 3 * 16
    packed = blocks.from_voxels(volume, (120, 3, 16), (1, 3, 16))
    want = cube(blocks.to_voxels(block_resample.top_view_planes(packed, view, rounding, arithmetic).drop("k")), view.shape)
    assert out.count() == want.size and (cube(out, view.shape) == want).all() and want.any()


@pytest.mark.parametrize("flip", [1, -1])
def test_affine_shuffles_no_voxels_outside_the_source(spark, flip):
    """the box around a deep volume is mostly empty, and all of it was shuffled."""
    volume, a = tables.synthetic_volume(spark, (100, 3, 4)), g.affine((100, 3, 4), 0.168, 0.2, 45.0, flip)
    out = resample.affine_volume(volume, a)
    assert shuffled(out) < 10 * 100 * 3 * 4 < math.prod(a.shape)
    assert out.count() == math.prod(a.shape)
    slabs = block_resample.affine_blocks(blocks.from_voxels(volume, (100, 3, 4), (1, 3, 4)), a)
    assert np.allclose(cube(out, a.shape), cube(blocks.to_voxels(slabs), a.shape), rtol=1e-6, atol=1e-2)
