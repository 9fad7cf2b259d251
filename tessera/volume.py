"""A volume and its operations, chained; everything stays a lazy DataFrame until it is written or counted."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tessera.functions import geometry
from tessera.functions.params import RunParams
from tessera.operators import compare as comparing
from tessera.operators import project, resample
from tessera.session import ship
from tessera.sinks import tiff
from tessera.sinks import zarr as zarr_sink
from tessera.sources import blocks, discover


@dataclass(frozen=True)
class Volume:
    """Voxels (z, y, x, v) of a known shape."""

    voxels: DataFrame
    shape: tuple[int, int, int]
    name: str = "volume"

    def _with(self, voxels: DataFrame, shape: tuple[int, int, int]) -> Volume:
        return replace(self, voxels=voxels, shape=shape)

    def slice(self, axis: str, index: int) -> DataFrame:
        return project.plane(self.voxels, axis, index)

    def trim(self, edges: tuple[int, int, int]) -> Volume:
        """Cut edges off; coordinates start at 0 again."""
        kept = project.trim(self.voxels, self.shape, edges)
        moved = kept.selectExpr(*[f"{a} - {t} as {a}" for a, t in zip(project.AXES, edges, strict=True)], "v")
        return self._with(moved, tuple(n - 2 * t for n, t in zip(self.shape, edges, strict=True)))

    def stride(self, factor: int) -> Volume:
        z, y, x = self.shape
        return self._with(project.stride(self.voxels, factor), (z, geometry.level_size(y, factor), geometry.level_size(x, factor)))

    def shear(self, params: RunParams) -> DataFrame:
        return resample.sheared(self.voxels, geometry.top_view(self.shape, params.dx, params.dz, params.angle, params.flip))

    def average_adjacent(self) -> Volume:
        return self._with(resample.neighbour_mean(self.voxels), self.shape)

    def top_view(self, params: RunParams) -> Volume:
        view = geometry.top_view(self.shape, params.dx, params.dz, params.angle, params.flip)
        return self._with(resample.top_view_volume(self.voxels, view, params.rounding, arithmetic=params.arithmetic), view.shape)

    def affine(self, params: RunParams) -> Volume:
        record = geometry.affine(self.shape, params.dx, params.dz, params.angle, params.flip, params.affine_rotate)
        return self._with(resample.affine_volume(self.voxels, record, params.output_type), record.shape)

    def pyramid(self, largest: int = 16) -> DataFrame:
        return resample.pyramid(self.voxels, geometry.pyramid_factors(largest))

    def mip(self) -> DataFrame:
        return resample.max_projection(self.voxels)

    def concat(self, *others: Volume) -> Volume:
        """Stacked along z after this volume, in the order given."""
        depth, out = self.shape[0], self.voxels
        for other in others:
            if other.shape[1:] != self.shape[1:]:
                raise ValueError(f"planes {self.shape[1:]} and {other.shape[1:]} can't be stacked")
            out = out.unionByName(other.voxels.selectExpr(f"z + {depth} as z", "y", "x", "v"))
            depth += other.shape[0]
        return self._with(out, (depth, *self.shape[1:]))

    def compare(self, other: Volume, **options) -> comparing.Comparison:
        if self.shape != other.shape:
            raise ValueError(f"the volumes' shapes differ: {self.shape} and {other.shape}")
        return comparing.compare(self.voxels, other.voxels, self.shape, **options)

    def write(self, path: str, dtype: str = "<u2", largest: int = 16) -> None:
        """As a Zarr group or a BigTIFF, by the path's suffix."""
        planes = blocks.from_voxels(self.voxels, self.shape, (1, *self.shape[1:]), dtype)
        if path.lower().endswith(".ome.zarr"):
            zarr_sink.write_zarr(planes, path, self.shape, dtype, self.name, largest)
        else:
            tiff.write_tiff(planes, path)


def read(spark: SparkSession, path: str) -> Volume:
    """Any supported volume file or group."""
    found = discover.read(ship(spark), path)
    return Volume(blocks.to_voxels(found), discover.shape(spark, path), path.rstrip("/").rpartition("/")[2].partition(".")[0])
