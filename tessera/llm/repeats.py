"""Suffix-array dedup: bytes under long strings that occur at another place, too.

1. Every string of ``depth`` bytes has an anchor: the least-hashed of its short
   grams. Anchors are counted over the corpus; those that occur once can't lie in
   a repeated string.
2. The starts under a repeated anchor, with the bytes their strings cover, are the
   anchor's pieces; equal pieces become one, with the number of their places.
   Under an anchor that is very common, as in a short standing phrase, only starts
   whose whole string occurs twice by its hash go on, so such a shard stays small.
3. A shard of anchors sorts its pieces' suffixes by external induced sorting with common
   prefixes (``induced``); neighbours that share ``depth`` bytes are repeated strings.
4. Their byte ranges return to the places of the pieces. A place is the digest of its
   text and a start, so the result doesn't depend on how or in which order rows are read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, utf8, written
from tessera.llm.counting import count_and_finish
from tessera.llm.hashing import mix
from tessera.llm.induced import MEMORY, repeated_starts

#: Bytes of an anchor's gram.
GRAM = 64
#: Bits of a place among the bytes whose anchors are found together, few enough for a core's cache (more for a very large depth); the other bits are the hash's.
SEGMENT_BITS = 17
#: Occurrences of an anchor from which whole strings are counted, too.
COMMON = 2_000
#: Text bytes from which a shard takes no further anchor; an anchor with more is sorted alone, on disk beyond ``induced.MEMORY``.
SHARD_BYTES = 1 << 20
#: Bytes of the head of a row whose whole strings are counted: anchor, start and the text's SHA-256.
HEAD = 48

_ODD = 0x9E3779B97F4A7C15
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _powers:
        with np.errstate(over="ignore"):
            both = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, x, np.uint64), dtype=np.uint64)]) for x in (_ODD, pow(_ODD, -1, 1 << 64))]
        _powers[n] = both[0], both[1]
    return _powers[n]


def _segment_bits(depth: int) -> int:
    return max(SEGMENT_BITS, (4 * depth).bit_length())


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of the ``width`` bytes from each place."""
    n = len(data)
    up, down = _power_tables(1 << max(SEGMENT_BITS, (n - 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[:n], dtype=np.uint64)])
        return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by block-wise running minima from both sides."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    before = np.minimum.accumulate(square, axis=1).ravel()
    after = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def _segments(offsets: np.ndarray, depth: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of whole documents up to a segment's size; a longer document in overlapping ranges."""
    limit, at, n = 1 << _segment_bits(depth), 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        a, b = int(offsets[at]), int(offsets[to])
        while b - a > limit:
            yield a, a + limit
            a += limit - depth + 1
        yield a, b
        at = to


def anchors(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts that share an anchor: first start, last start, anchor hash."""
    doc_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    width, bits = min(GRAM, depth), np.uint64(_segment_bits(depth))
    found: list[tuple] = []
    for a, b in _segments(offsets, depth):
        if b - a < depth:
            continue
        hashes = gram_hashes(data[a:b], width)
        placed = hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64)
        chosen = sliding_min(placed, depth - width + 1)
        starts = np.flatnonzero(doc_of[a : b - depth + 1] == doc_of[a + depth - 1 : b])
        if not len(starts):
            continue
        anchor = (chosen[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        found.append((starts[new] + a, starts[np.append(new[1:], len(starts)) - 1] + a, hashes[anchor[new]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _candidates(rows: DataFrame, depth: int, common: int) -> DataFrame:
    """All runs under repeated anchors: ``anchor``, ``pid`` (digest of anchor and piece), ``piece``, ``n`` places, the distinct places (``texts``, ``starts``)."""
    schema = "anchor long, pid binary, piece binary, n long, texts array<binary>, starts array<bigint>"
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())]

    def listed(pieces: dict[tuple[int, bytes], dict]) -> list[list]:
        out: list[list] = [[], [], [], [], [], []]
        for (anchor, piece), places in pieces.items():
            name = anchor.to_bytes(8, "little")
            pid = hashlib.blake2b(name + piece, digest_size=16).digest()
            row = int.from_bytes(name, "little", signed=True), pid, piece, sum(places.values()), [t for t, _ in places], [x for _, x in places]
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    block: list = []  # the last one counted with its anchors, which finishing it takes up again

    def keys_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        block[:] = data, offsets, anchors(data, offsets, depth)
        return [block[2][2]]

    def finish(ids: list, data: np.ndarray, offsets: np.ndarray, tables: list) -> list[list]:
        first, last, keys = block[2] if block and block[0] is data and block[1] is offsets else anchors(data, offsets, depth)
        block.clear()
        own, totals = tables[0]
        often = totals[np.searchsorted(own, keys)] if len(keys) else keys
        pieces: dict[tuple[int, bytes], dict] = {}
        many: set[tuple] = set()
        digests: dict[int, bytes] = {}
        doc = np.searchsorted(offsets, first, side="right") - 1
        for i in np.flatnonzero(often >= 2).tolist():
            d = int(doc[i])
            if d not in digests:
                digests[d] = hashlib.sha256(data[offsets[d] : offsets[d + 1]]).digest()
            name = int(keys[i]), data[first[i] : last[i] + depth].tobytes()
            place = digests[d], int(first[i] - offsets[d])
            places = pieces.setdefault(name, {})
            places[place] = places.get(place, 0) + 1
            if often[i] > common:
                many.add(name)
        out = listed(pieces)
        # of a common anchor: 1 for a piece with one place, which must prove itself; 2 for one with several, a witness
        role = [(1 if n == 1 else 2) if name in many else 0 for name, n in zip(pieces, out[3], strict=True)]
        return [*out, role]

    def counted(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return [np.concatenate([gram_hashes(data[a + HEAD : b], depth) for a, b in zip(offsets[:-1], offsets[1:], strict=True)] or [np.zeros(0, np.uint64)])]

    def repeated(ids: list, data: np.ndarray, offsets: np.ndarray, tables: list) -> list[list]:
        own, totals = tables[0]
        pieces: dict[tuple[int, bytes], dict] = {}
        for i, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if i < 0:
                continue
            anchor, start = data[a : a + 16].tobytes()[:8], int.from_bytes(data[a + 8 : a + 16].tobytes(), "big")
            text = data[a + 16 : a + HEAD].tobytes()
            twice = totals[np.searchsorted(own, gram_hashes(data[a + HEAD : b], depth))] >= 2
            edge = np.flatnonzero(np.diff(np.concatenate([[0], twice.astype(np.int8), [0]])))
            for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                places = pieces.setdefault((int.from_bytes(anchor, "big"), data[a + HEAD + x : a + HEAD - 1 + y + depth].tobytes()), {})
                places[text, start + x] = 1
        return listed(pieces)

    found = written(count_and_finish(rows, keys_of, finish, schema + ", role int", [*types, pa.int32()]), "pieces")
    alone = F.col("role") == 1
    head = F.concat(*[F.unhex(F.lpad(F.hex(x), 16, "0")) for x in (F.col("anchor"), F.col("starts")[0])], F.col("texts")[0])
    again = found.where("role > 0").select(F.when(alone, 0).otherwise(-1).cast("long").alias("id"), F.concat(F.when(alone, head).otherwise(F.lit(bytes(HEAD))), "piece").alias("data"))
    return found.where(~alone).drop("role").unionByName(written(count_and_finish(again, counted, repeated, schema, types), "pieces"))


class _Shard:
    """Pieces that are sorted together, in the form the sort reads; on disk from a quarter of the sort's memory."""

    def __init__(self, memory: int):
        self.text = tempfile.SpooledTemporaryFile(memory // 4, prefix="shard-")
        self.names = tempfile.SpooledTemporaryFile(memory // 16, prefix="shard-")
        self.lengths, self.weights, self.size = [], [], 0

    def add(self, pid: bytes, piece: bytes, n: int) -> None:
        self.text.write(piece + b"\xff")
        self.names.write(pid)
        self.lengths.append(len(piece))
        self.weights.append(min(n, 2))
        self.size += len(piece)

    def ranges(self, depth: int, memory: int) -> Iterator[tuple[bytes, list[int], list[int]]]:
        """Pieces that hold repeated strings, with the ranges of bytes that these cover."""
        self.text.seek(0)
        self.names.seek(0)
        raw = iter(lambda: self.text.read(1 << 20), b"")
        for hit in repeated_starts(raw, np.array(self.lengths, np.int64), np.array(self.weights, np.int64), depth, memory):
            pid = self.names.read(16)
            edge = (np.flatnonzero(hit[1:] != hit[:-1]) + 1).tolist()
            edge = [*([0] if hit[0] else []), *edge, *([len(hit)] if hit[-1] else [])]
            if edge:
                yield pid, edge[::2], [x + depth - 1 for x in edge[1::2]]
        self.text.close()
        self.names.close()


def _sort_shards(batches: Iterator[pa.RecordBatch], depth: int, limit: int, memory: int) -> Iterator[pa.RecordBatch]:
    """Distinct pieces sorted by anchor to ``pid`` and ``ranges`` of repeated bytes; anchors are sorted together up to ``limit`` bytes."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    shard, last = _Shard(memory), None

    def sorted_out(shard: _Shard) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for pid, begin, end in shard.ranges(depth, memory):
            rows.append((pid, [{"start": a, "end": b} for a, b in zip(begin, end, strict=True)]))
            if len(rows) == 5_000:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], kind)], names=["pid", "ranges"])

    for batch in batches:
        for anchor, pid, piece, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if anchor != last and shard.size >= limit:
                yield from sorted_out(shard)
                shard = _Shard(memory)
            last = anchor
            shard.add(pid, piece, n)
    if shard.size:
        yield from sorted_out(shard)


def _union(spans: list) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for s in sorted((x["start"], x["end"]) for x in spans):
        if merged and s[0] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s[1])
        else:
            merged.append([*s])
    return [(a, b) for a, b in merged]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = 400, shard_bytes: int = SHARD_BYTES, common: int = COMMON, memory: int = MEMORY) -> DataFrame:
    """Key, ``n_bytes``, ``spans`` (merged byte ranges removed) and ``kept`` (the remaining bytes) of every row.

    A byte goes if a string of ``depth`` bytes over it also starts anywhere else, in the
    same text or another; matches never cross texts and are judged on the
    input, so of repeated rows none keeps its copy. A null text counts as empty; null keys pass
    through; an empty table gives an empty table. Texts are UTF-8; keys may be of any type. Other
    columns are not read. Rows may come in another order each time ``docs`` is read. ``memory``
    bounds what a task's sort holds at once; a larger shard is sorted on disk.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = _candidates(docs.select(F.lit(0).cast("long"), whole), depth, common)
    # equal pieces meet before they are dealt by anchor, so a passage in a third of all texts is one row of its shard
    pieces = found.groupBy("anchor", "pid").agg(F.first("piece").alias("piece"), F.sum("n").alias("n"))
    sharded = pieces.repartition("anchor").sortWithinPartitions("anchor")
    ranges = written(mapped(sharded, lambda batches: _sort_shards(batches, depth, shard_bytes, memory), "pid binary, ranges array<struct<start:bigint,end:bigint>>"), "piece-ranges")
    places = found.select("pid", "texts", "starts").join(ranges, "pid").select(F.explode(F.arrays_zip("texts", "starts")).alias("place"), "ranges")
    moved = F.transform("ranges", lambda r: F.struct((F.col("place.starts") + r["start"]).alias("start"), (F.col("place.starts") + r["end"]).alias("end")))
    spans = written(places.groupBy(F.col("place.texts").alias("of")).agg(F.flatten(F.collect_set(moved)).alias("found")), "text-ranges")
    named = docs.select(F.col(key).alias("key"), whole.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    joined = named.join(spans, F.col("digest") == F.col("of"), "left").select("key", "text", "found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            data = data.tobytes()
            ends = offsets.tolist()
            spans, kept = [], []
            for d, own in enumerate(batch.column(2).to_pylist()):
                raw = data[ends[d] : ends[d + 1]]
                merged = _union(own or [])
                if merged and merged[-1][1] > len(raw):
                    raise RuntimeError("a span lies outside its text")
                at, left = 0, []
                for a, b in merged:
                    left.append(raw[at:a])
                    at = b
                spans.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join([*left, raw[at:]]))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["key", "n_bytes", "spans", "kept"])

    kind = dict(docs.dtypes)[key]
    return mapped(joined, cut, f"key {kind}, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary").withColumnRenamed("key", key)
