"""Python data sources: ``spark.read.format("voltiff" | "omezarr")``, and ``df.write.format("omezarr")``.

A volume is read as a grid of blocks: a Zarr array's chunks, a TIFF's pages cut by ``read_chunks``. A partition is a
run of the grid of up to ``partition_bytes`` (option, default 128 MB). Filters on z0, y0 and x0
are pushed down and narrow the grid, so nothing else is planned or read. TIFFs have to be
visible to every executor; Zarr groups may be in any store that ``store`` reaches. ``read_tiff``
and ``read_zarr`` read through Spark instead.
"""

from __future__ import annotations

import itertools
import json
import math
import mmap
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from tessera.functions.geometry import read_chunks
from tessera.sources import store, tiff, zarr
from tessera.sources.blocks import SCHEMA, block_row

_TESTS = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}
_ARROW = pa.schema([("z0", pa.int64()), ("y0", pa.int64()), ("x0", pa.int64()), ("nz", pa.int32()), ("ny", pa.int32()), ("nx", pa.int32()), ("dtype", pa.string()), ("data", pa.binary())])
PARTITION_BYTES = 128 << 20


@dataclass
class Run(InputPartition):
    """Cells ``first`` to ``last`` of a box of the grid; for a TIFF with the directory entries of its pages."""

    first: int
    last: int
    pages: dict[int, tiff.Page] = field(default_factory=dict)


class _Grid(DataSourceReader):
    """A grid of blocks whose positions filters narrow; every filter also goes back to Spark unless it is exact here."""

    shape: tuple[int, int, int]
    chunks: tuple[int, int, int]
    itemsize: int

    def __init__(self, partition_bytes: int) -> None:
        self.tests: list[tuple[int, type, int]] = []
        self.partition_bytes = partition_bytes

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            if type(f) in _TESTS and name in ("z0", "y0", "x0"):
                self.tests.append((("z0", "y0", "x0").index(name), type(f), f.value))
            else:
                yield f

    def axes(self) -> list[list[int]]:
        """On each axis the numbers of the cells whose first voxel passes the filters."""
        counts = [-(-n // c) for n, c in zip(self.shape, self.chunks, strict=True)]
        return [[k for k in range(n) if all(_TESTS[kind](k * c, value) for axis, kind, value in self.tests if axis == a)] for a, (n, c) in enumerate(zip(counts, self.chunks, strict=True))]

    def partitions(self) -> list[Run]:
        cells = math.prod(map(len, self.axes()))
        each = max(1, self.partition_bytes // (math.prod(self.chunks) * self.itemsize))
        return [self.run(a, min(a + each, cells)) for a in range(0, cells, each)] or [Run(0, 0)]

    def run(self, first: int, last: int) -> Run:
        return Run(first, last)

    def cells(self, run: Run) -> Iterator[tuple[int, int, int]]:
        axes = self.axes()
        sizes = [len(a) for a in axes]
        for k in range(run.first, run.last):
            yield tuple(axis[int(i)] for axis, i in zip(axes, np.unravel_index(k, sizes), strict=True))

    @staticmethod
    def batch(array: np.ndarray, at: tuple[int, int, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([block_row(array, at)], schema=_ARROW)


class TiffReader(_Grid):
    """Runs of pages; the file's directories are parsed once, and each run carries its own pages' places."""

    def __init__(self, path: str, partition_bytes: int) -> None:
        super().__init__(partition_bytes)
        self.path, self.state = tiff.local(path), tiff.file_state(tiff.local(path))
        found = self._pages()
        one = found[0] if found else None
        plane = ((one.height, one.width) if one.samples == 1 else (one.width, one.samples)) if one else (1, 1)
        self.samples, self.shape = one.samples if one else 1, (tiff.plane_count(found), *plane)
        self.itemsize = np.dtype(one.dtype).itemsize if one else 1
        self.chunks = (1, *read_chunks(plane))

    def _pages(self) -> list[tiff.Page]:
        with _mapped(self.path) as data:
            return tiff.pages(data)

    def partitions(self) -> list[Run]:
        found = self._pages()  # not kept: the reader itself goes to every task
        runs = super().partitions()
        for run in runs:
            planes = {z for z, _, _ in self.cells(run)}
            run.pages = {0: found[0]} if self.samples > 1 and planes else {z: found[z] for z in planes}
        return runs

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        if partition.first == partition.last:
            return
        if tiff.file_state(self.path) != self.state:
            raise RuntimeError(f"{self.path} changed while it was read")
        with _mapped(self.path) as data:
            whole = tiff.page_array(data, partition.pages[0]) if self.samples > 1 else None
            for z, cells in itertools.groupby(self.cells(partition), lambda c: c[0]):
                page = whole[z] if whole is not None else tiff.page_array(data, partition.pages[z])
                for _, y, x in cells:
                    at = (z, y * self.chunks[1], x * self.chunks[2])
                    yield self.batch(page[None, at[1] : at[1] + self.chunks[1], at[2] : at[2] + self.chunks[2]], at)


@contextmanager
def _mapped(path: str) -> Iterator[mmap.mmap]:
    """A file's bytes without reading it whole."""
    with open(path, "rb") as file, mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ) as data:
        yield data


class ZarrReader(_Grid):
    """Runs of chunks; chunks that were never written come as blocks of the fill value."""

    def __init__(self, path: str, level: str, partition_bytes: int) -> None:
        super().__init__(partition_bytes)
        self.root = f"{path.rstrip('/')}/{level}"
        text = store.read_bytes(f"{self.root}/.zarray")
        if text is None:
            raise FileNotFoundError(f"no Zarr array at {self.root}")
        self.info = json.loads(text)
        if len(self.info["shape"]) != 3:
            raise ValueError(f"a volume has three axes, not {len(self.info['shape'])}")
        self.shape, self.chunks, self.itemsize = tuple(self.info["shape"]), tuple(self.info["chunks"]), np.dtype(self.info["dtype"]).itemsize

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        mark = self.info.get("dimension_separator", ".")
        for index in self.cells(partition):
            raw = store.read_bytes(f"{self.root}/{mark.join(map(str, index))}")
            yield self.batch(zarr.chunk_array(raw, self.info, index), tuple(i * c for i, c in zip(index, self.chunks, strict=True)))


class VolumeTiff(DataSource):
    @classmethod
    def name(cls) -> str:
        return "voltiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TiffReader:
        return TiffReader(self.options["path"], int(self.options.get("partition_bytes", PARTITION_BYTES)))


class OmeZarr(DataSource):
    """Option ``level``: which pyramid level is read (default 0). Options of writing: see ``ZarrWriter``."""

    @classmethod
    def name(cls) -> str:
        return "omezarr"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZarrReader:
        return ZarrReader(self.options["path"], self.options.get("level", "0"), int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        from tessera.sinks.zarr import ZarrWriter

        return ZarrWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VolumeTiff)
    spark.dataSource.register(OmeZarr)
