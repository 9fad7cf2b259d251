"""TIFF and BigTIFF decoding without a library: strips or tiles, either byte order, the lossless compressions, stacks in one directory."""

from __future__ import annotations

import mmap
import os
import pickle
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tessera.sources import blocks
from tessera.sources.blocks import SCHEMA, block_row

#: Bytes of the field types, the tags read here, and the codes of the compressions.
_TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
_FORMATS = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_WIDTH, _HEIGHT, _BITS, _COMPRESSION, _DESCRIPTION, _OFFSETS, _SAMPLES, _ROWS, _COUNTS = 256, 257, 258, 259, 270, 273, 277, 278, 279
_FILL_ORDER, _PLANAR, _PREDICTOR, _TILE_WIDTH, _TILE_HEIGHT, _TILE_OFFSETS, _TILE_COUNTS, _FORMAT = 266, 284, 317, 322, 323, 324, 325, 339
_NONE, _LZW, _DEFLATE, _OLD_DEFLATE, _PACKBITS, _ZSTD = 1, 5, 8, 32946, 32773, 50000
_CLEAR, _STOP = 256, 257


@dataclass(frozen=True)
class Page:
    height: int
    width: int
    dtype: str
    segments: tuple[tuple[int, int], ...]
    description: str
    samples: int = 1
    compression: int = _NONE
    predictor: int = 1
    segment: tuple[int, int] = (0, 0)
    bits: int = 0
    planar: bool = False
    reversed_bits: bool = False

    @property
    def shape(self) -> tuple[int, ...]:
        return (self.height, self.width) if self.samples == 1 else (self.height, self.width, self.samples)


def unpack_lzw(data: bytes) -> bytes:
    """Variable-width codes from the high bit on; the width grows one code early."""
    out, table, width, last = [], [], 9, b""
    bits = held = 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == _STOP:
            break
        if code == _CLEAR:
            table, width, last = [bytes((i,)) for i in range(256)] + [b"", b""], 9, b""
            continue
        word = table[code] if code < len(table) else last + last[:1]
        out.append(word)
        if last:
            table.append(last + word[:1])
        last, width = word, min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def unpack_bits(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            out.append(data[at + 1 : at + 2] * (257 - n if n > 128 else 0))
            at += 2 if n > 128 else 1
    return b"".join(out)


def _unpack(data: bytes, compression: int) -> bytes:
    if compression == _NONE:
        return data
    if compression in (_DEFLATE, _OLD_DEFLATE):
        return zlib.decompress(data)
    if compression == _ZSTD:
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return unpack_lzw(data) if compression == _LZW else unpack_bits(data)


def _fields(data: bytes, order: str, at: int, big: bool) -> tuple[dict[int, tuple], int]:
    count = struct.unpack_from(order + ("Q" if big else "H"), data, at)[0]
    at += 8 if big else 2
    found = {}
    for _ in range(count):
        tag, kind = struct.unpack_from(order + "HH", data, at)
        n = struct.unpack_from(order + ("Q" if big else "I"), data, at + 4)[0]
        value = at + (12 if big else 8)
        if n * _TYPE_BYTES.get(kind, 1) > (8 if big else 4):
            value = struct.unpack_from(order + ("Q" if big else "I"), data, value)[0]
        if kind in _FORMATS:
            found[tag] = struct.unpack_from(f"{order}{n}{_FORMATS[kind]}", data, value)
        at += 20 if big else 12
    return found, struct.unpack_from(order + ("Q" if big else "I"), data, at)[0]


def pages(data: bytes) -> list[Page]:
    """All pages; a description with ``images=n`` or ``slices=n`` makes one directory a stack."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None:
        raise ValueError("no TIFF byte-order mark")
    version = struct.unpack_from(order + "H", data, 2)[0]
    if version not in (42, 43):
        raise ValueError(f"TIFF version {version} is unknown")
    big = version == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)[0]
    found = []
    while at:
        tags, at = _fields(data, order, at, big)
        value = lambda tag, other: tags.get(tag, (other,))[0]  # noqa: E731, B023
        compression, predictor, samples = value(_COMPRESSION, _NONE), value(_PREDICTOR, 1), value(_SAMPLES, 1)
        if compression not in (_NONE, _LZW, _DEFLATE, _OLD_DEFLATE, _PACKBITS, _ZSTD) or predictor not in (1, 2, 3):
            raise ValueError(f"TIFF compression {compression} with predictor {predictor} is not supported")
        bits, kind = value(_BITS, 1), {1: "u", 2: "i", 3: "f"}.get(value(_FORMAT, 1), "u")
        packed = bits not in (8, 16, 32, 64)
        if packed and (kind != "u" or not 1 <= bits < 16 or predictor != 1) or predictor == 3 and kind != "f":
            raise ValueError(f"TIFF samples of {bits} bits ({kind}) with predictor {predictor} are not supported")
        text = value(_DESCRIPTION, b"").rstrip(b"\0").decode("utf-8", "replace")
        height, width = tags[_HEIGHT][0], tags[_WIDTH][0]
        tiled = _TILE_OFFSETS in tags
        segments = tuple(zip(tags[_TILE_OFFSETS if tiled else _OFFSETS], tags[_TILE_COUNTS if tiled else _COUNTS], strict=True))
        segment = (tags[_TILE_HEIGHT][0], tags[_TILE_WIDTH][0]) if tiled else (min(height, value(_ROWS, height)), width)
        size = (1 if bits < 8 else 2) if packed else bits // 8
        found.append(Page(height, width, f"{order}{kind}{size}", segments, text, samples, compression, predictor, segment, bits if packed else 0, samples > 1 and value(_PLANAR, 1) == 2, value(_FILL_ORDER, 1) == 2))
    if len(found) == 1 and (m := re.search(r"(?:images|slices)=(\d+)", found[0].description)) and int(m[1]) > 1:
        one = found[0]
        size = one.height * one.width * np.dtype(one.dtype).itemsize
        if one.compression == _NONE and one.samples == 1 and not one.bits and one.predictor == 1:
            found = [Page(one.height, one.width, one.dtype, ((one.segments[0][0] + k * size, size),), one.description, segment=(one.height, one.width)) for k in range(int(m[1]))]
    return found


def _values(raw: bytes, page: Page, tall: int, columns: int, samples: int) -> np.ndarray:
    """The values (tall, columns, samples) of a segment's unpacked bytes."""
    kind = np.dtype(page.dtype)
    if page.bits:  # rows of packed bits, each ending with a byte
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little" if page.reversed_bits else "big").reshape(tall, -1)
        single = bits[:, : columns * samples * page.bits].reshape(tall, columns, samples, page.bits)
        return single.astype(kind) @ (1 << np.arange(page.bits)[::-1]).astype(kind)
    if page.predictor == 3:  # differences of bytes; a row holds its values' highest bytes first, then the next ones
        planes = np.cumsum(np.frombuffer(raw, np.uint8).reshape(tall, -1, samples), axis=1, dtype=np.uint8).reshape(tall, kind.itemsize, columns * samples)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(tall, columns, samples)
    part = np.frombuffer(raw, kind).reshape(tall, columns, samples)
    return np.cumsum(part.astype(kind.newbyteorder("=")), axis=1, dtype=kind.newbyteorder("=")) if page.predictor == 2 else part


def page_array(data: bytes, page: Page) -> np.ndarray:
    """The page's values: (height, width), with samples (height, width, samples)."""
    rows, columns = page.segment
    across, down = -(-page.width // columns), -(-page.height // rows)
    inner = 1 if page.planar else page.samples
    row_bytes = -(-columns * inner * page.bits // 8) if page.bits else columns * inner * np.dtype(page.dtype).itemsize
    out = np.zeros((page.height, page.width, page.samples), page.dtype)
    for i, (at, n) in enumerate(page.segments):
        sample, j = divmod(i, across * down) if page.planar else (0, i)
        y, x = j // across * rows, j % across * columns
        tall = rows if columns < page.width or page.height % rows == 0 else min(rows, page.height - y)
        raw = _unpack(data[at : at + n], page.compression)
        if len(raw) < tall * row_bytes:
            tall = len(raw) // row_bytes
            if y + tall < min(page.height, y + rows):
                raise ValueError("a TIFF page is shorter than its size says")
        part = _values(raw[: tall * row_bytes], page, tall, columns, inner)[: page.height - y, : page.width - x]
        out[y : y + part.shape[0], x : x + part.shape[1], sample : sample + inner] = part
    return out if page.samples > 1 else out[:, :, 0]


def plane_count(found: list[Page]) -> int:
    """Planes of a file: its pages; one page with several samples is a volume (height, width, samples)."""
    if any(p.samples > 1 for p in found):
        if len(found) > 1:
            raise ValueError("a volume needs three axes; a stack of pages with several samples has four")
        return found[0].height
    return len(found)


def plane(data: bytes, found: list[Page], z: int) -> np.ndarray:
    return page_array(data, found[0])[z] if found[0].samples > 1 else page_array(data, found[z])


def local(path: str) -> str:
    """A mounted path without its scheme; empty for any other store."""
    parts = urlparse(path)
    found = path if not parts.scheme else unquote(parts.path) if parts.scheme == "file" else ""
    return found if found and os.path.exists(found) else ""


def file_state(path: str) -> str:
    """What changes when a file is written again or replaced."""
    s = os.stat(path)
    return f"{s.st_size}.{s.st_mtime_ns}.{s.st_ino}"


#: Mapped files of this worker by path, with their state.
_maps: dict[str, tuple[str, mmap.mmap]] = {}
MOST_MAPS = 4


def _opened(path: str, state: str) -> mmap.mmap:
    """The file's bytes in the state in which its pages were listed; a map of an earlier state is closed."""
    if path in _maps and _maps[path][0] != state:
        _maps.pop(path)[1].close()
    if path not in _maps:
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        if file_state(path) != state:
            raise RuntimeError(f"{path} changed after its pages were listed")
        while len(_maps) >= MOST_MAPS:
            _maps.pop(next(iter(_maps)))[1].close()
        _maps[path] = state, data
    return _maps[path][1]


#: Bytes of values that the pages of one reading task have together.
RUN_BYTES = 4 << 20


def read_tiff(spark: SparkSession, path: str) -> DataFrame:
    """Planes of TIFF volumes in block form with ``path``.

    On a mounted folder a file's directories are parsed once; the places of its pages are dealt to the
    tasks in runs of about ``RUN_BYTES``, and each task maps the file and reads its own pages' bytes only, so a file
    may be of any size and have any number of pages. From any other store Spark reads whole
    files (up to 2 GB), one task per file. A file that is replaced between listing and reading fails the job.
    """
    files = spark.read.format("binaryFile").load(path)
    if not local(path):

        def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for file in batch.itertuples():
                    found = pages(file.content)
                    for z in range(plane_count(found)):
                        yield pd.DataFrame([{"path": file.path, **block_row(plane(file.content, found, z)[None], (z, 0, 0))}])

        return files.select("path", "content").mapInPandas(decode, "path string, " + SCHEMA)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch.path:
                state = file_state(local(name))
                with open(local(name), "rb") as file, mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ) as data:
                    found = pages(data)
                if plane_count(found):
                    one = found[0]
                    many = one.samples > 1  # one page holds all planes, so one task reads them
                    each = max(1, one.height * one.width * one.samples * np.dtype(one.dtype).itemsize)
                    run = [0 if many else z * each // RUN_BYTES for z in range(len(found))]
                    yield pd.DataFrame({"path": name, "state": state, "z": range(len(found)), "page": [pickle.dumps(p) for p in found], "run": run})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                page = pickle.loads(row.page)  # made by ``listed``
                array = page_array(_opened(local(row.path), row.state), page)
                planes = array if page.samples > 1 else array[None]
                for k, one in enumerate(planes):
                    yield pd.DataFrame([{"path": row.path, **block_row(one[None], (int(row.z) + k, 0, 0))}])

    runs = files.select("path").mapInPandas(listed, "path string, state string, z long, page binary, run long")
    return blocks.spread(runs, "path", "run").mapInPandas(read, "path string, " + SCHEMA)


def volume_shape(path: str) -> tuple[int, int, int]:
    """Axis lengths of a mounted file, from its directories alone."""
    with open(local(path), "rb") as file, mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ) as data:
        found = pages(data)
    if not found:
        raise ValueError("the volume has no pages")
    one = found[0]
    return (plane_count(found), one.height, one.width) if one.samples == 1 else (one.height, one.width, one.samples)
