"""BigTIFF writing: the executors write their own planes into the file.

Plain planes have like sizes, so every plane's place is known. Compressed planes are
compressed first, by the tasks, into a table; the running sum of their sizes gives their
places, and a second pass puts them there. Either way the file takes its name when it is whole.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.blocks import block_array, rechunk

#: Little-endian BigTIFF header up to the first directory's place; the codes of the compressions.
_HEADER = b"II" + struct.pack("<HHH", 43, 8, 0)
_TAGS = 10
COMPRESSIONS = {"none": 1, "deflate": 8, "zstd": 50000}
_KINDS = {"u": 1, "i": 2, "f": 3}


def _stride(ny: int, nx: int, dtype: np.dtype) -> int:
    """Bytes of a page: its values, padded to eight, and its directory."""
    return -(-ny * nx * dtype.itemsize // 8) * 8 + 8 + 20 * _TAGS + 8


def _directory(tags: list[tuple[int, int]], after: int) -> bytes:
    return struct.pack("<Q", len(tags)) + b"".join(struct.pack("<HHQQ", tag, 16, 1, value) for tag, value in tags) + struct.pack("<Q", after)


def _page(array: np.ndarray, k: int, last: bool) -> tuple[int, bytes]:
    """Place and bytes of page k of a file of like pages."""
    ny, nx = array.shape
    stride = _stride(ny, nx, array.dtype)
    at = 16 + k * stride
    tags = [(256, nx), (257, ny), (258, 8 * array.itemsize), (259, 1), (262, 1), (273, at), (277, 1), (278, ny), (279, array.nbytes), (339, _KINDS[array.dtype.kind])]
    values = array.astype(array.dtype.newbyteorder("<")).tobytes()
    return at, values + b"\0" * (-len(values) % 8) + _directory(tags, 0 if last else at + stride + _directory_at(stride))


def _directory_at(stride: int) -> int:
    return stride - 16 - 20 * _TAGS


def _begin(path: str, first: int, size: int) -> None:
    """A file of ``size`` bytes whose first directory is at ``first`` (0: none)."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "wb") as out:
        out.write(_HEADER + struct.pack("<Q", first))
        out.truncate(size)


#: Bytes that are looked at together for being zeros only.
RUN = 1 << 12


def _put(out: BinaryIO, at: int, data: bytes) -> None:
    """Bytes in their place in a new file. Runs of zeros aren't written: the file has its length from the start, so they are there already and take no disk."""
    for first in range(0, len(data), RUN):
        part = data[first : first + RUN]
        if part.count(0) < len(part):
            out.seek(at + first)
            out.write(part)


def write_pages(path: str, arrays: list[np.ndarray]) -> int:
    """Write like 2-D arrays as one file, here and now. Returns the number of pages."""
    stride = _stride(*arrays[0].shape, arrays[0].dtype) if arrays else 0
    _begin(path, 16 + _directory_at(stride) if arrays else 0, 16 + len(arrays) * stride)
    with open(path, "r+b") as out:
        for k, array in enumerate(arrays):
            at, data = _page(array, k, k + 1 == len(arrays))
            out.seek(at)
            out.write(data)
    return len(arrays)


def packed_plane(array: np.ndarray, compression: str = "none", predictor: int = 1, bits: int = 0) -> bytes:
    """A plane's bytes: predicted (2: differences of values, 3: of the bytes of floats), or packed to ``bits`` a value, then compressed."""
    little = array.astype(array.dtype.newbyteorder("<"))
    if bits:
        raw = np.packbits((little[:, :, None] >> np.arange(bits, dtype=little.dtype)[::-1] & 1).astype(np.uint8).reshape(len(array), -1), axis=1)
    elif predictor == 3:
        planes = array.astype(array.dtype.newbyteorder(">")).view(np.uint8).reshape(*array.shape, array.itemsize).transpose(0, 2, 1).reshape(len(array), -1)
        raw = np.diff(planes, axis=1, prepend=np.uint8(0))
    else:
        raw = np.diff(little, axis=1, prepend=little.dtype.type(0)).astype(little.dtype) if predictor == 2 else little
    data = raw.tobytes()
    if compression == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=3).compress(data)
    return zlib.compress(data, 6) if compression == "deflate" else data


def _sizes(planes: DataFrame) -> tuple[int, int, int, np.dtype]:
    """Planes and their like (ny, nx, type)."""
    r = planes.agg(F.count("*").alias("n"), F.max("z0").alias("last"), F.max("ny").alias("ny"), F.max("nx").alias("nx"), F.min("ny").alias("my"), F.min("nx").alias("mx"), F.max("dtype").alias("dtype"), F.min("dtype").alias("other")).first()
    if r["n"] and (r["last"] + 1 != r["n"] or (r["ny"], r["nx"], r["dtype"]) != (r["my"], r["mx"], r["other"])):
        raise ValueError("a TIFF stack needs like planes without gaps")
    return r["n"], r["ny"] or 0, r["nx"] or 0, np.dtype(r["dtype"] or "<u2")


def _named(draft: str, path: str) -> None:
    """Give a finished file its name; what had it before was whole until now."""
    os.replace(draft, path)


def write_tiff(planes: DataFrame, path: str, compression: str = "none", predictor: int = 1, bits: int = 0) -> int:
    """Whole planes in block form (z0 from 0, gapless) as one file; returns the number of pages.

    No plane passes through the driver, and a task that runs again writes the same bytes to the same
    place. ``compression``: none, deflate or zstd; ``predictor``: 1 none, 2 differences (whole numbers), 3 of floats' bytes;
    ``bits``: values packed to 1 to 15 bits (unsigned). ``path`` must be in a folder that driver and executors mount.
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression is one of {', '.join(COMPRESSIONS)}, not {compression}")
    n, ny, nx, dtype = _sizes(planes)
    if predictor == 2 and dtype.kind == "f" or predictor == 3 and dtype.kind != "f" or bits and (predictor != 1 or dtype.kind != "u" or not 0 < bits < 16 or bits == 8):
        raise ValueError(f"{dtype} can't be written with predictor {predictor} and {bits} bits")
    draft = f"{path}.writing-{uuid.uuid4().hex}"
    stride = _stride(ny, nx, dtype) if n else 0
    if compression != "none" or predictor != 1 or bits:
        return _write_packed(planes, path, draft, (n, ny, nx, dtype), compression, predictor, bits)
    _begin(draft, 16 + _directory_at(stride) if n else 0, 16 + n * stride)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with open(draft, "r+b") as out:
                for row in batch.itertuples():
                    _put(out, *_page(block_array(row)[0], int(row.z0), row.z0 + 1 == n))
            yield pd.DataFrame({"pages": [len(batch)]})

    written = int(planes.mapInPandas(write, "pages long").agg(F.sum("pages")).first()[0] or 0)
    _named(draft, path)
    return written


def _write_packed(planes: DataFrame, path: str, draft: str, sizes: tuple[int, int, int, np.dtype], compression: str, predictor: int, bits: int) -> int:
    """Pages of unlike lengths. The driver sees a number and a length of each, no bytes."""
    n, ny, nx, dtype = sizes
    spark = planes.sparkSession
    parts = f"{draft}-parts"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                yield pd.DataFrame({"z": [int(row.z0)], "data": [packed_plane(block_array(row)[0], compression, predictor, bits)]})

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    planes.mapInPandas(pack, "z long, data binary").write.parquet(f"file://{os.path.abspath(parts)}")
    packed = spark.read.parquet(f"file://{os.path.abspath(parts)}")
    lengths = np.zeros(n, np.int64)
    for r in packed.select("z", F.octet_length("data").alias("length")).toLocalIterator():
        lengths[r["z"]] = r["length"]
    tags = 11 if predictor != 1 else 10
    padded = -(-lengths // 8) * 8
    starts = 16 + np.concatenate([[0], np.cumsum(padded + 16 + 20 * tags)])
    _begin(draft, int(starts[0] + padded[0]) if n else 0, int(starts[-1]))
    directories = starts[:-1] + padded

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with open(draft, "r+b") as out:
                for z, data in zip(batch.z, batch.data, strict=True):
                    entries = [(256, nx), (257, ny), (258, bits or 8 * dtype.itemsize), (259, COMPRESSIONS[compression]), (262, 1), (273, int(starts[z])), (277, 1), (278, ny), (279, len(data))]
                    entries += ([(317, predictor)] if predictor != 1 else []) + [(339, _KINDS[dtype.kind])]
                    out.seek(int(starts[z]))
                    out.write(data + b"\0" * (-len(data) % 8) + _directory(entries, 0 if z + 1 == n else int(directories[z + 1])))
            yield pd.DataFrame({"pages": [len(batch)]})

    written = int(packed.mapInPandas(place, "pages long").agg(F.sum("pages")).first()[0] or 0)
    _named(draft, path)
    _drop(parts)
    return written


def _drop(folder: str) -> None:
    import shutil

    shutil.rmtree(folder, ignore_errors=True)


def write_sample_planes(volume: DataFrame, path: str, shape: tuple[int, int, int]) -> int:
    """A volume as one page (height z, width y) with a sample for each x, every sample in a plane of its own.

    Each task writes the sample planes that it holds; the driver writes the directory. Returns the samples.
    """
    height, width, samples = shape
    dtype = np.dtype(volume.select("dtype").first()[0])
    size = height * width * dtype.itemsize
    draft = f"{path}.writing-{uuid.uuid4().hex}"
    lists = 16 + -(-samples * size // 8) * 8
    _begin(draft, lists + 16 * samples, lists + 16 * samples)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with open(draft, "r+b") as out:
                for row in batch.itertuples():
                    out.seek(16 + int(row.x0) * size)
                    out.write(block_array(row).tobytes())
            yield pd.DataFrame({"samples": [len(batch)]})

    written = int(rechunk(volume, shape, (height, width, 1)).mapInPandas(write, "samples long").agg(F.sum("samples")).first()[0] or 0)
    if written != samples:
        raise ValueError(f"{written} of {samples} samples were written")
    plain = [(256, width), (257, height), (258, 8 * dtype.itemsize), (259, 1), (262, 1), (277, samples), (278, height), (284, 2), (339, _KINDS[dtype.kind])]
    entries = [struct.pack("<HHQQ", tag, 16, 1, value) for tag, value in plain]
    at = 16 if samples == 1 else lists
    entries += [struct.pack("<HHQQ", 273, 16, samples, at), struct.pack("<HHQQ", 279, 16, samples, size if samples == 1 else lists + 8 * samples)]
    entries.sort(key=lambda e: struct.unpack_from("<H", e))
    with open(draft, "r+b") as out:
        out.seek(lists)
        out.write(struct.pack(f"<{samples}Q", *[16 + k * size for k in range(samples)]) + struct.pack(f"<{samples}Q", *[size] * samples))
        out.write(struct.pack("<Q", len(entries)) + b"".join(entries) + struct.pack("<Q", 0))
    _named(draft, path)
    return written
