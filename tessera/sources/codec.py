"""Chunk codecs: byte order, raw, zlib, zstd and Blosc frames (decoding)."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa


def shuffle_bits(raw: bytes, size: int) -> bytes:
    """Bit planes of elements of ``size`` bytes, eight elements at a time; a rest of fewer stays as it is."""
    n = len(raw) // size // 8 * 8
    whole = np.frombuffer(raw, np.uint8, n * size).reshape(n, size)
    planes = np.packbits(np.unpackbits(whole, axis=1, bitorder="little").T, axis=1, bitorder="little")
    return planes.tobytes() + raw[n * size :]


def unshuffle_bits(raw: bytes, size: int) -> bytes:
    n = len(raw) // size // 8 * 8
    planes = np.frombuffer(raw, np.uint8, n * size).reshape(size * 8, n // 8)
    bits = np.unpackbits(planes, axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").tobytes() + raw[n * size :]


def unshuffle_bytes(raw: bytes, size: int) -> bytes:
    n = len(raw) // size
    return np.frombuffer(raw, np.uint8, n * size).reshape(size, n).T.tobytes() + raw[n * size :]


def decode_blosc(frame: bytes) -> bytes:
    """A Blosc 1 frame with zstd, zlib or no inner compressor, and byte, bit or no shuffle."""
    _, _, flags, size, total, block, _ = struct.unpack_from("<BBBBIII", frame)
    if flags & 2:
        return frame[16 : 16 + total]
    codec = flags >> 5
    if codec not in (3, 4):
        raise ValueError(f"Blosc inner compressor {codec} is not supported")
    count = -(-total // block)
    starts = struct.unpack_from(f"<{count}I", frame, 16)
    out = []
    for i, at in enumerate(starts):
        want = min(block, total - i * block)
        split = not flags & 16 and size <= 16 and want // size >= 128 and want == block
        parts, step = [], want // size if split else want
        for _ in range(size if split else 1):
            n = struct.unpack_from("<i", frame, at)[0]
            body = frame[at + 4 : at + 4 + n]
            parts.append(body if n == step else zlib.decompress(body) if codec == 3 else pa.decompress(pa.py_buffer(body), step, codec="zstd", asbytes=True))
            at += 4 + n
        raw = b"".join(parts)
        out.append(unshuffle_bits(raw, size) if flags & 4 else unshuffle_bytes(raw, size) if flags & 1 and size > 1 else raw)
    return b"".join(out)


def encode_blosc(raw: bytes, size: int, level: int = 3) -> bytes:
    """One-block Blosc frame: zstd over bit planes, stored raw where that doesn't pay."""
    import zstandard

    body = zstandard.ZstdCompressor(level=level).compress(shuffle_bits(raw, size))
    if len(body) + 24 >= len(raw):
        return struct.pack("<BBBBIII", 2, 1, 2 | 4 << 5, size, len(raw), len(raw), len(raw) + 16) + raw
    return struct.pack("<BBBBIII", 2, 1, 4 | 16 | 4 << 5, size, len(raw), len(raw), len(body) + 24) + struct.pack("<I", 20) + struct.pack("<i", len(body)) + body


def decode(raw: bytes, compressor: dict | None, size: int) -> bytes:
    """Raw bytes of a chunk under a Zarr compressor description."""
    kind = (compressor or {}).get("id")
    if kind is None:
        return raw
    if kind == "blosc":
        return decode_blosc(raw)
    if kind in ("zlib", "gzip"):
        return zlib.decompress(raw, 47)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(size, 1))
    raise ValueError(f"compressor {kind} is not supported")


def encode(raw: bytes, compressor: dict | None, size: int) -> bytes:
    kind = (compressor or {}).get("id")
    if kind is None:
        return raw
    if kind == "blosc":
        return encode_blosc(raw, size, compressor.get("clevel", 3))
    if kind == "zlib":
        return zlib.compress(raw, compressor.get("level", 1))
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=compressor.get("level", 3)).compress(raw)
    raise ValueError(f"compressor {kind} is not supported")


def native(array: np.ndarray) -> np.ndarray:
    """Native byte order, C order."""
    return np.ascontiguousarray(array.astype(array.dtype.newbyteorder("="), copy=False))
