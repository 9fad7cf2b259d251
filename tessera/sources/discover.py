"""Finding inputs: listings as DataFrames, archives, and the registry of readers."""

from __future__ import annotations

import functools
import shutil
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import names


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """``name``, ``is_dir``, ``path`` of a folder's entries."""
    rows = [(p.name, p.is_dir(), str(p)) for p in Path(folder).iterdir()]
    return spark.createDataFrame(rows, "name string, is_dir boolean, path string")


def image_volumes(files: DataFrame, *by: str) -> DataFrame:
    """Zarr folders and TIFF files with their position by name (case-sensitive), in each group ``by`` of a listing."""
    zarr = files.where(names.is_zarr(F.col("name")) & F.col("is_dir"))
    tiff = files.where(~F.col("is_dir") & names.suffix(F.col("name")).isin(*names.TIFF_SUFFIXES))
    order = Window.partitionBy(*by).orderBy("name") if by else Window.orderBy("name")
    return zarr.unionByName(tiff).select(*by, "name", F.row_number().over(order).alias("position"))


def volumes_in(spark: SparkSession, folder: str) -> list[str]:
    """Paths of a folder's volumes in name order; a Zarr group is its own only volume; none is an error."""
    root = Path(folder)
    if root.is_dir() and root.name.lower().endswith(names.ZARR_SUFFIX):
        return [str(root)]
    found = [r["name"] for r in image_volumes(listing(spark, folder)).orderBy("position").collect()]
    if not found:
        raise FileNotFoundError(f"no image volumes in {folder}")
    return [str(root / n) for n in found]


def supported_inputs(spark: SparkSession, folder: str) -> list[str]:
    """Paths of everything a reader takes, in name order."""
    rows = listing(spark, folder).withColumn("kind", names.kind(F.col("name"), F.col("is_dir"))).where("kind is not null").orderBy("name")
    return [r["path"] for r in rows.collect()]


def coerce_rank(array: np.ndarray, strict: bool = False) -> np.ndarray:
    """Three axes: singletons go (``strict`` keeps an array that has three already), two axes become a plane."""
    out = array if strict and array.ndim == 3 else np.squeeze(array)
    out = out[None] if out.ndim == 2 else out
    if out.ndim != 3:
        raise ValueError(f"a volume needs three axes, not shape {array.shape}")
    return out


def unpack_archive(path: str, folder: str) -> str:
    """Extract an archive that holds exactly one Zarr group, member by member in the session's tasks; its inner name is kept.

    A member that would land outside the folder fails the whole archive before
    anything is written.
    """
    root = Path(folder).resolve()
    with zipfile.ZipFile(path) as found:
        members = found.namelist()
        for name in members:
            if not (root / name).resolve().is_relative_to(root):
                raise ValueError(f"archive member {name!r} leads outside the target")
        groups = sorted({n.split("/")[0] for n in members if n.split("/")[0].lower().endswith(names.ZARR_SUFFIX)})
        if len(groups) != 1:
            raise ValueError(f"an archive must hold exactly one Zarr group, not {groups}")
        size = sum(m.file_size for m in found.infolist())
    files = [n for n in members if not n.endswith("/")]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with zipfile.ZipFile(path) as found:
                for name in batch.name:
                    found.extract(name, root)
            yield pd.DataFrame({"n": [len(batch)]})

    root.mkdir(parents=True, exist_ok=True)
    tasks = max(1, min(size // (64 << 20) + 1, len(files)))
    SparkSession.active().createDataFrame([(n,) for n in files], "name string").repartition(tasks).mapInPandas(extract, "n long").agg(F.sum("n")).first()
    return str(root / groups[0])


#: Readers by kind: (spark, path) to planes or blocks in block form.
_readers: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(kind: str, reader: Callable[[SparkSession, str], DataFrame]) -> None:
    _readers[kind] = reader


def copy_group(spark: SparkSession, source: str, target: str) -> str:
    """A Zarr group's files as they are, copied by the tasks; replaces what is at ``target``. Both are mounted folders."""
    if Path(target).exists():
        shutil.rmtree(target)
    names = [str(p.relative_to(source)) for p in Path(source).rglob("*") if p.is_file()]

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch.name:
                to = Path(target, name)
                to.parent.mkdir(parents=True, exist_ok=True)
                shutil.copyfile(Path(source, name), to)
            yield pd.DataFrame({"n": [len(batch)]})

    Path(target).mkdir(parents=True)
    tasks = max(1, min(len(names) // 64, 1000))
    spark.createDataFrame([(n,) for n in names], "name string").repartition(tasks).mapInPandas(copy, "n long").agg(F.sum("n")).first()
    return target


def _defaults() -> None:
    from tessera.sources import optional
    from tessera.sources.tiff import read_tiff
    from tessera.sources.zarr import read_zarr

    for kind, reader in (("tiff", lambda s, p: read_tiff(s, p).drop("path")), ("zarr", read_zarr)):
        _readers.setdefault(kind, reader)
    for kind in optional.OPENERS:
        _readers.setdefault(kind, functools.partial(optional.read, kind))


def kind_of(path: str) -> str:
    name = Path(path).name.lower()
    kind = "zarr" if name.endswith(names.ZARR_SUFFIX) else "archive" if name.endswith(".ozx") else names.READERS.get(name.rpartition(".")[2])
    if kind is None:
        raise ValueError(f"no reader for {path}")
    return kind


def read(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of any supported volume but archives, which are unpacked first."""
    _defaults()
    return _readers[kind_of(path)](spark, path)


def shape(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Axis lengths of any supported volume: as a Zarr array or a mounted TIFF declares them, else those of its blocks."""
    from tessera.sources import tiff, zarr

    kind = kind_of(path)
    if kind == "zarr":
        return zarr.volume_shape(spark, path)
    if kind == "tiff" and tiff.local(path):
        return tiff.volume_shape(path)
    r = read(spark, path).agg(*[F.max(F.col(f"{a}0") + F.col(f"n{a}")).alias(a) for a in "zyx"]).first()
    if r["z"] is None:
        raise ValueError("the volume has no blocks")
    return int(r["z"]), int(r["y"]), int(r["x"])
