"""Zarr version 2 arrays and image groups, read through Spark's own file access."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.blocks import SCHEMA, block_row, spread
from tessera.sources.codec import decode

#: Metadata keys that a comparison report shows.
REPORTED_KEYS = (
    "axes",
    "voxel_size_um_zyx",
    "voxel_size_resolution_source",
    "output_origin_xyz_um",
    "affine_matrix_xyz",
    "affine_offset_xyz_um",
    "inverse_affine_matrix_xyz",
    "inverse_affine_offset_xyz_um",
    "applied_rotation_deg_xyz",
    "multiscales",
)


def _text(spark: SparkSession, path: str) -> str | None:
    """Whole text of a small file in any store that Spark reaches; null where there is none.

    Data sources skip names that start with a dot, as the metadata files' do,
    so the file is opened through Hadoop's file system.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(at):
        return None
    stream = store.open(at)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def array_info(spark: SparkSession, path: str, level: str = "0") -> dict:
    text = _text(spark, f"{path}/{level}/.zarray")
    if text is None:
        raise FileNotFoundError(f"no Zarr array at {path}/{level}")
    return json.loads(text)


def attributes(spark: SparkSession, path: str) -> dict:
    """The group's attributes; malformed or missing ones are empty."""
    try:
        found = json.loads(_text(spark, f"{path}/.zattrs") or "{}")
    except json.JSONDecodeError:
        return {}
    return found if isinstance(found, dict) else {}


def axis_names(attrs: dict) -> list[str]:
    """Axis names of the first multiscale; z, y, x where absent or malformed."""
    try:
        found = [str(a["name"] if isinstance(a, dict) else a) for a in attrs["multiscales"][0]["axes"]]
    except (KeyError, IndexError, TypeError):
        return ["z", "y", "x"]
    return found if len(found) == 3 else ["z", "y", "x"]


def reported(attrs: dict) -> dict:
    """Recognised metadata, at the top level or within a nested affine record of any name."""
    nested = next((v for v in attrs.values() if isinstance(v, dict) and "affine_matrix_xyz" in v), {})
    merged = {**nested, **attrs}
    return {k: merged[k] for k in REPORTED_KEYS if k in merged}


def fill_of(info: dict) -> float | int:
    """What chunks that were never written hold."""
    fill = info.get("fill_value")
    return 0 if fill is None else float(fill.replace("Infinity", "inf")) if isinstance(fill, str) else fill


def chunk_array(raw: bytes | None, info: dict, index: tuple[int, ...]) -> np.ndarray:
    """The part of a chunk that lies inside the array; without bytes it holds the fill value."""
    dtype, chunks = np.dtype(info["dtype"]), info["chunks"]
    inside = tuple(slice(0, min(c, n - i * c)) for i, c, n in zip(index, chunks, info["shape"], strict=True))
    if raw is None:
        return np.full([s.stop for s in inside], fill_of(info), dtype)
    whole = np.frombuffer(decode(raw, info["compressor"], int(np.prod(chunks)) * dtype.itemsize), dtype)
    return whole.reshape(chunks, order=info.get("order", "C"))[inside]


def volume_shape(spark: SparkSession, path: str, level: str = "0", tpc: tuple[int, int, int] | None = None) -> tuple[int, int, int]:
    """The declared shape, whatever chunks there are; of a component its last three axes."""
    shape = array_info(spark, path, level)["shape"]
    if len(shape) != (3 if tpc is None else 6):
        raise ValueError(f"a volume has three axes, a component six, not {len(shape)}")
    return tuple(int(n) for n in shape[-3:])


def read_zarr(spark: SparkSession, path: str, level: str = "0", tpc: tuple[int, int, int] | None = None) -> DataFrame:
    """Blocks of one level, a row per chunk; only that level's files are listed.

    The array's grid, joined with the files' names, shows the chunks that were never written:
    they come as blocks of the fill value. Other files, and chunks outside the declared
    shape, are left alone. With ``tpc``, the array has six axes and the view at that (t, p, c) is read: only
    its files are.
    """
    info = array_info(spark, path, level)
    shape, chunks = info["shape"], info["chunks"]
    separator = info.get("dimension_separator", ".")
    lead: tuple[int, ...] = ()
    if tpc is not None:
        if len(shape) != 6:
            raise ValueError(f"a component has six axes, not {len(shape)}")
        if any(not 0 <= i < n for i, n in zip(tpc, shape, strict=False)):
            raise ValueError(f"{tpc} lies outside {tuple(shape[:3])}")
        lead = tuple(i // c for i, c in zip(tpc, chunks, strict=False))
    elif len(shape) != 3:
        raise ValueError(f"a volume has three axes, not {len(shape)}")
    grid = [-(-n // c) for n, c in zip(shape, chunks, strict=True)][len(lead) :]
    pattern = rf"/{re.escape(level)}/" + re.escape(separator).join([*map(str, lead), *[r"(\d{1,18})"] * 3]) + "$"

    def rows(contents) -> pd.DataFrame:
        found = []
        for k, raw in contents:
            index = tuple(int(i) for i in np.unravel_index(k, grid))
            a = chunk_array(raw, info, lead + index)
            if lead:
                a = a[tuple(i % c for i, c in zip(tpc, chunks, strict=False))]
            found.append(block_row(a, tuple(i * c for i, c in zip(index, chunks[len(lead) :], strict=True))))
        return pd.DataFrame(found, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield rows(zip(batch.k, batch.content, strict=True))

    def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch.k:
                yield rows([(k, None)])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[0-9]*").load(f"{path}/{level}")
    index = [F.regexp_extract("path", pattern, a + 1).try_cast("long") for a in range(3)]  # null where the name doesn't match
    inside = [(i >= 0) & (i < n) for i, n in zip(index, grid, strict=True)]
    number = (index[0] * grid[1] + index[1]) * grid[2] + index[2]
    own = files.where(F.col("path").rlike(pattern) & inside[0] & inside[1] & inside[2]).withColumn("k", number)
    absent = spark.range(int(np.prod(grid))).select(F.col("id").alias("k")).join(own.select("k"), "k", "left_anti")
    return own.select("k", "content").mapInPandas(decoded, SCHEMA).unionByName(spread(absent, "k").mapInPandas(filled, SCHEMA))
