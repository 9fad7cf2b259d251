"""Resampling in block form, the path for large volumes: numpy kernels per plane or per block.

Results equal the voxel form's. Top view: an output plane needs at most three
source planes, so planes meet on the tap table and are gathered per output plane.
Affine: the output is cut into blocks, each resampled from the box of source voxels under it.
"""

from __future__ import annotations

import dataclasses
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import SUPPORT
from tessera.functions.geometry import Affine, TopView, indices_out, tile_halo
from tessera.sources.blocks import SCHEMA, block_array, block_row, cut, spread


def _rounded(a: np.ndarray, rounding: str, snap: bool = True) -> np.ndarray:
    snapped = np.floor(a * 1e6 + 0.5) / 1e6 if snap else a
    whole = np.rint(snapped) if rounding == "half_even" else np.floor(snapped + 0.5)
    return np.clip(whole, 0, 65535).astype("<u2")


def _frame(rows: pd.DataFrame, view: TopView) -> np.ndarray:
    """The interpolated frame of one output plane in double precision."""
    frame = np.zeros((view.shear_y, view.x))
    for row in rows.sort_values("z0").itertuples():
        frame[row.shift : row.shift + view.y] += row.c * block_array(row)[0]
    return frame


def _frame_single(rows: pd.DataFrame, view: TopView) -> np.ndarray:
    """The same in single precision: means of neighbouring planes, then their weighted sum."""
    v = np.zeros((3, view.shear_y, view.x), np.float32)
    for row in rows.itertuples():
        v[row.place, row.shift : row.shift + view.y] = block_array(row)[0]
    low, last, half = int((rows.z0 - rows.place).iloc[0]), view.z - 1, np.float32(0.5)
    here = v[0] if low == last else half * (v[0] + v[1])
    deeper = v[0] if low == last else v[1] if low == last - 1 else half * (v[1] + v[2])
    return np.float32(rows["first"].iloc[0]) * here + np.float32(rows.second.iloc[0]) * deeper


def sheared_planes(planes: DataFrame, view: TopView) -> DataFrame:
    """Whole source planes, each in its place in the sheared frame; 0 elsewhere."""

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                frame = np.zeros((1, view.shear_y, view.x), np.dtype(row.dtype))
                shift = view.offsets[row.z0] + view.margin
                frame[:, shift : shift + view.y] = block_array(row)
                yield pd.DataFrame([block_row(frame, (row.z0, 0, 0))])

    return planes.mapInPandas(move, SCHEMA)


def top_view_planes(planes: DataFrame, view: TopView, rounding: str = "half_even", arithmetic: str = "float64") -> DataFrame:
    """Output planes (uint16) from source planes; the tap table, bounded by the depth, is broadcast. ``arithmetic`` as in ``top_view_volume``."""
    single = arithmetic == "float32"
    taps = planes.sparkSession.createDataFrame(*((view.single_taps(), "k long, z0 long, place int, shift long, first double, second double") if single else (view.taps(), "k long, z0 long, shift long, c double")))

    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def lookup() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in the output of the cells that look into the frame, in the order of the frame's rows, and those rows and columns; once a task."""
        if not found:
            cy, cx = (view.shear_y - 1) / 2.0, (view.x - 1) / 2.0
            yy, xx = np.arange(view.shear_y)[:, None] - cy, np.arange(view.x)[None] - cx
            sy = np.rint(view.cos * yy - view.sin * xx + cy).astype(np.int64)
            sx = np.rint(view.sin * yy + view.cos * xx + cx).astype(np.int64)
            at = np.flatnonzero((sy >= 0) & (sy < view.shear_y) & (sx >= 0) & (sx < view.x))
            at = at[np.argsort(sy.ravel()[at], kind="stable")]
            found.append((at, sy.ravel()[at], sx.ravel()[at]))
        return found[0]

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        at, sy, sx = lookup()
        low, high = int(rows["shift"].min()), int(rows["shift"].max()) + view.y  # the rest of the frame is 0
        own = slice(*np.searchsorted(sy, (low, high)))
        near = dataclasses.replace(view, shear_y=high - low)
        rows = rows.assign(shift=rows["shift"] - low)
        frame = _frame_single(rows, near) if single else _frame(rows, near)
        out = np.zeros(view.shear_y * view.x, "<u2")
        out[at[own]] = _rounded(frame[sy[own] - low, sx[own]], rounding, not single)
        return pd.DataFrame([block_row(out.reshape(1, view.shear_y, view.x), (int(rows.k.iloc[0]), 0, 0))])

    return spread(planes.join(F.broadcast(taps), "z0"), "k").groupBy("k").applyInPandas(gather, SCHEMA)


Box = list[tuple[int, int]]


def tile_counts(geometry: Affine, tile: tuple[int, int, int]) -> tuple[int, ...]:
    return tuple(-(-n // t) for n, t in zip(geometry.shape, tile, strict=True))


def tile_ranges(geometry: Affine, tile: tuple[int, int, int], key: tuple[int, ...]) -> list[range]:
    """The output voxels of a tile, an index range per axis."""
    return [range(k * t, min((k + 1) * t, n)) for k, t, n in zip(key, tile, geometry.shape, strict=True)]


def source_box(geometry: Affine, own: list[range]) -> Box:
    """The source voxels that a tile's taps lie in, from the inverse transform of its corners."""
    box = []
    for row, n in zip(geometry.to_source()[:2], geometry.source, strict=False):
        at = [sum(k * v for k, v in zip(row, point, strict=False)) + row[3] for point in itertools.product(*[(r[0], r[-1]) for r in own])]
        box.append((min(n, max(0, math.floor(min(at)))), max(0, min(n, math.floor(max(at)) + 2))))
    return [*box, tile_halo(own[2].start, own[2].stop, geometry.source[2])]


def tiles_over(geometry: Affine, tile: tuple[int, int, int], at: tuple[int, int, int], shape: tuple[int, int, int]) -> Iterator[tuple[int, ...]]:
    """Keys of the tiles whose box may meet a source block: the range of tiles under its image, a voxel wider.

    Found by arithmetic on the transform, so the work depends on the block and not on how many tiles there are.
    """
    corners = list(itertools.product(*[(a - 1.0, a + n) for a, n in zip(at, shape, strict=True)]))
    spans = []
    for row, t, n in zip(indices_out(geometry), tile, geometry.shape, strict=True):
        image = [sum(k * v for k, v in zip(row, c, strict=False)) + row[3] for c in corners]
        low, high = max(0, math.floor(min(image)) - 1), min(n - 1, math.ceil(max(image)) + 1)
        spans.append(range(low // t, high // t + 1) if low <= high else range(0))
    yield from itertools.product(*spans)


#: Source blocks are cut to these sizes before their tiles are looked up.
CUT = (1, 256, 256)


def affine_blocks(planes: DataFrame, geometry: Affine, output_type: str = "float32", tile: tuple[int, int, int] = (64, 256, 64)) -> DataFrame:
    """Output blocks of at most ``tile`` voxels from source blocks of any form.

    Source blocks meet the tiles over them by an equality join on the tile's key: a block lists its
    own tiles, and every tile is listed once, so those without a source come too. A task holds
    one tile and the box of source voxels under it; no task or closure holds all tiles.
    NaN voxels count as absent: they give no support.
    """
    nz, ny, nx = geometry.source
    (a0, a1, a2, a3), (b0, b1, b2, b3), (c0, c1, c2, c3) = geometry.to_source()
    counts = tile_counts(geometry, tile)
    spark = planes.sparkSession

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                out = []
                for part, at in cut(block_array(row), (row.z0, row.y0, row.x0), CUT):
                    for key in tiles_over(geometry, tile, at, part.shape):
                        box = source_box(geometry, tile_ranges(geometry, tile, key))
                        spans = [(max(low, a), min(high, a + n)) for (low, high), a, n in zip(box, at, part.shape, strict=True)]
                        if all(low < high for low, high in spans):
                            piece = part[tuple(slice(low - a, high - a) for (low, high), a in zip(spans, at, strict=True))]
                            out.append({"tile": int(np.ravel_multi_index(key, counts)), **block_row(piece, tuple(low for low, _ in spans))})
                if out:
                    yield pd.DataFrame(out)

    def taps(n: int, f: np.ndarray, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        first = np.floor(f).astype(np.int64)
        rest = f - first
        return [(np.clip(i - low, 0, high - low - 1), w, (i >= 0) & (i < n)) for i, w in ((first, 1 - rest), (first + 1, rest))]

    def resampled(rows: pd.DataFrame) -> pd.DataFrame:
        own = tile_ranges(geometry, tile, tuple(int(k) for k in np.unravel_index(int(rows.tile.iloc[0]), counts)))
        box = source_box(geometry, own)
        out = np.zeros([len(r) for r in own])
        if all(low < high for low, high in box):
            source = np.zeros([high - low for low, high in box])
            for row in rows.itertuples():
                source[tuple(slice(a - low, a - low + n) for a, n, (low, _) in zip((row.z0, row.y0, row.x0), (row.nz, row.ny, row.nx), box, strict=True))] = block_array(row)
            there = ~np.isnan(source)
            source[~there] = 0.0
            y, x = np.array(own[1])[:, None], np.array(own[2])[None]
            for k, z in enumerate(own[0]):  # one output plane of the block at a time
                fz, fy, fx = a0 * z + a1 * y + a2 * x + a3, b0 * z + b1 * y + b2 * x + b3, c0 * z + c1 * y + c2 * x + c3
                ok = (fz >= -0.5) & (fz <= nz - 0.5) & (fy >= -0.5) & (fy <= ny - 0.5) & (fx >= -0.5) & (fx <= nx - 0.5)
                total, support = np.zeros(ok.shape), np.zeros(ok.shape)
                for iz, wz, in_z in taps(nz, fz, *box[0]):
                    for iy, wy, in_y in taps(ny, fy, *box[1]):
                        for ix, wx, in_x in taps(nx, fx, *box[2]):
                            w = np.where(in_z & in_y & in_x & ok & there[iz, iy, ix], wz * wy * wx, 0.0)
                            total += w * source[iz, iy, ix]
                            support += w
                out[k] = np.where(support > SUPPORT, total / np.maximum(support, SUPPORT), 0.0)
        typed = out.astype("<f4") if output_type == "float32" else _rounded(out, "half_up")
        return pd.DataFrame([block_row(typed, (own[0].start, own[1].start, own[2].start))])

    every = spark.range(math.prod(counts)).selectExpr("id AS tile", "0L AS z0", "0L AS y0", "0L AS x0", "0 AS nz", "0 AS ny", "0 AS nx", "'|u1' AS dtype", "cast('' AS binary) AS data")
    return planes.mapInPandas(deal, "tile long, " + SCHEMA).unionByName(every).groupBy("tile").applyInPandas(resampled, SCHEMA)


def pyramid_planes(planes: DataFrame, factors: list[int]) -> DataFrame:
    """Strided planes of every level; each plane is read once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([{"level": i, **block_row(block_array(row)[:, ::f, ::f], (row.z0, 0, 0))} for row in batch.itertuples() for i, f in enumerate(factors)])

    return planes.mapInPandas(run, "level int, " + SCHEMA)
