"""Counts of hashed keys over a whole corpus, gathered block by block.

A block is a run of rows of one partition. Each block sends its distinct keys
with their counts, packed and dealt by the top bits of the key (a hash), so a
key that is everywhere costs one entry per block; a bucket adds up its keys and
answers every block with the totals in the order the keys came in; the block's
own rows travel beside the answers, compressed. Three kinds of rows, two
shuffles.

Buckets are as many as leave some KB in a packet, so the packets grow with the input
and not faster. A bucket may be larger than memory: its sorted packets then go to a file of the
task, and are added up one range of keys after the other.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, release, utf8

#: Bytes of a block's rows.
BLOCK_BYTES = 8 << 20

#: Keys of each table (order) of a block, with repeats: counted as often as they are listed.
KeysOf = Callable[[np.ndarray, np.ndarray], list[np.ndarray]]
#: Rows from a block: ids, data, offsets, and for each order its sorted distinct keys and their totals.
Finish = Callable[[list, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]], list[list]]

#: Kinds of rows beside the keys of each order: a block's rows, and their checksum.
ROWS, CHECK = -1, -2
CHANGED = "a block's rows differ between two reads of the table"

_PACKED = "kind int, part int, block long, data binary"
_NAMES = ["kind", "part", "block", "data"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]


#: Text bytes whose keys share a bucket, and the most buckets: a packet of a full block holds some KB.
BUCKET_BYTES, MOST_BUCKETS = 2 << 20, 1 << 10
#: Keys of a bucket that are added up in memory at once.
BUCKET_KEYS = 2_000_000
#: Text bytes of a task that settles blocks; tasks beyond the most of these take as many times more.
TASK_BYTES, MANY_TASKS, LARGER = 8 << 20, 2_000, 16


def size_of(rows: DataFrame) -> int:
    """Bytes of the data of ``rows`` (an id and the data)."""
    return rows.toDF("id", "data").agg(F.sum(F.octet_length("data"))).first()[0] or 0


def buckets_for(size: int) -> int:
    """A power of two that grows with the bytes of the data, whatever the session's settings are."""
    return min(MOST_BUCKETS, 1 << max(6, (size // BUCKET_BYTES).bit_length()))


def tasks_for(size: int) -> int:
    tasks = size // TASK_BYTES
    return max(16, min(tasks, MANY_TASKS) + max(0, tasks - MANY_TASKS) // LARGER)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    """(block number, ids, data, offsets) of runs of rows with about ``limit`` bytes."""
    number = -1
    ids: list = []
    parts: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    size = 0

    def closed():
        return number, list(ids), np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(lengths))])

    for batch in batches:
        if number < 0 and batch.num_rows:
            number = batch.column(2)[0].as_py() << 32  # of the table's own partition, whatever the task's is
        data, offsets = utf8(batch.column(1))
        keys, row, n = batch.column(0).to_pylist(), 0, batch.num_rows
        while row < n:
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit - size, side="right")) - 1)
            ids += keys[row:to]
            parts.append(data[offsets[row] : offsets[to]])
            lengths.append(np.diff(offsets[row : to + 1]))
            size += int(offsets[to] - offsets[row])
            row = to
            if size >= limit or row < n:
                yield closed()
                number += 1
                ids, parts, lengths, size = [], [], [], 0
    if ids:
        yield closed()


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte each, and eight more for those of 255 and over."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return struct.pack("<I", len(counts)) + small.tobytes() + counts[small == 255].astype("<u8").tobytes()


def unpack_counts(data: memoryview) -> np.ndarray:
    n = struct.unpack_from("<I", data)[0]
    counts = np.frombuffer(data, np.uint8, n, 4).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=4 + n).astype(np.int64)
    return counts


def _pack_keys(keys: np.ndarray, base: np.uint64) -> bytes:
    """Sorted keys of a bucket that starts at ``base``: steps between neighbours, byte plane by byte plane, so that the upper planes compress."""
    steps = np.diff(keys, prepend=base).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_keys(data: bytes | memoryview, base: np.uint64) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.uint64)
    if len(steps):
        steps[0] += base
    return np.cumsum(steps, dtype=np.uint64)


def _squeeze(data: bytes) -> bytes:
    return struct.pack("<I", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def _expand(cell: pa.Scalar) -> memoryview:
    data = memoryview(cell.as_buffer())
    return memoryview(pa.decompress(pa.py_buffer(data[4:]), struct.unpack_from("<I", data)[0], codec="zstd", asbytes=True))


def _shift(buckets: int) -> np.uint64:
    return np.uint64(64 - (buckets.bit_length() - 1))


def _totals(keys: np.ndarray, counts: np.ndarray, minimum: int) -> np.ndarray:
    """For each key the sum of the counts of its equals; those under ``minimum`` as 0."""
    rank = np.argsort(keys, kind="stable")
    ordered = keys[rank]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    total = np.add.reduceat(counts[rank], np.flatnonzero(first))
    total[total < minimum] = 0
    answer = np.empty(len(keys), np.int64)
    answer[rank] = total[np.cumsum(first) - 1]
    return answer


class Bucket:
    """Sorted keys and counts of one bucket's packets; from ``limit`` keys on in a file that goes with the task."""

    def __init__(self, limit: int):
        self.limit, self.sizes, self.held, self.waiting, self.file = limit, [], [], 0, None

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.sizes.append(len(keys))
        self.held.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="tessera-bucket-")
        for keys, counts in self.held:
            self.file.write(np.stack([keys, counts.astype(np.uint64)], axis=1).tobytes())
        self.held, self.waiting = [], 0

    def answers(self, minimum: int) -> Iterator[np.ndarray]:
        """The totals of each packet's keys, packet by packet."""
        ends = np.cumsum(self.sizes)
        if self.file is None:
            if self.held:
                found = _totals(*(np.concatenate(c) for c in zip(*self.held, strict=True)), minimum)
                yield from (found[e - n : e] for e, n in zip(ends, self.sizes, strict=True))
            return
        self._spill()
        self.file.flush()
        rows = np.memmap(self.file, np.uint64, "r+", shape=(int(ends[-1]), 2))
        reach = max(int(rows[e - 1, 0]) for e, n in zip(ends, self.sizes, strict=True) if n)
        least = min(int(rows[e - n, 0]) for e, n in zip(ends, self.sizes, strict=True) if n)
        parts = -(-int(ends[-1]) // self.limit)
        at = [e - n for e, n in zip(ends, self.sizes, strict=True)]
        for part in range(1, parts + 1):  # keys are hashes, so equal ranges hold about as many
            edge = least + (reach - least + 1) * part // parts
            upto = [a + int(np.searchsorted(rows[a:e, 0], np.uint64(min(edge, reach)), "right" if edge > reach else "left")) for a, e in zip(at, ends, strict=True)]
            own = [slice(a, b) for a, b in zip(at, upto, strict=True) if b > a]
            if own:
                found = _totals(np.concatenate([rows[x, 0] for x in own]), np.concatenate([rows[x, 1] for x in own]).astype(np.int64), minimum)
                begin = 0
                for x in own:
                    rows[x, 1] = found[begin : begin + x.stop - x.start].astype(np.uint64)
                    begin += x.stop - x.start
            at = upto
        yield from (rows[e - n : e, 1].astype(np.int64) for e, n in zip(ends, self.sizes, strict=True))
        del rows
        self.file.close()


def _checksum(data: np.ndarray, offsets: np.ndarray) -> bytes:
    return hashlib.blake2b(np.diff(offsets).astype("<i8").tobytes() + data.tobytes(), digest_size=16).digest()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


def count_and_finish(rows: DataFrame, keys_of: KeysOf, finish: Finish, schema: str, types: list[pa.DataType], buckets: int | None = None, minimum: int = 1, block_bytes: int = BLOCK_BYTES, bucket_keys: int = BUCKET_KEYS, rows_level: int = 1) -> DataFrame:
    """Run ``finish`` on every block with the corpus totals of the block's keys.

    ``rows``: an id (long) and a string or binary column, in the same order each time they
    are read (files or a written table; a block whose rows differ between the two reads
    fails the job). ``keys_of`` gives 64-bit hashes, all of whose bits count. ``buckets``: a power of
    two, ``buckets_for`` the bytes of the rows if not given. Totals under ``minimum`` are answered as 0. ``rows_level``:
    how hard rows are compressed, which costs CPU where traffic is scarce.
    """
    size = size_of(rows)
    buckets = buckets or buckets_for(size)
    rows = rows.toDF("id", "data").withColumn("of", F.spark_partition_id())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, data, offsets in _blocks(batches, block_bytes):
            yield _batch([(CHECK, block % buckets, block, _checksum(data, offsets))])
            for order, keys in enumerate(keys_of(data, offsets)):
                own, counts = distinct(keys)
                of = (own >> _shift(buckets)).astype(np.int64)
                edges = [*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), len(own)]  # a block without keys has none
                out = []
                for a, b in itertools.pairwise(edges):
                    packed = pack_counts(counts[a:b]) + _pack_keys(own[a:b], np.uint64(of[a]) << _shift(buckets))
                    out.append((order, int(of[a]), block, _squeeze(packed)))
                if out:
                    yield _batch(out)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The totals of each order and bucket go back in each block's order; checksums pass."""
        cells = (cell for batch in batches for cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True))
        for (order, part), packets in itertools.groupby(cells, lambda cell: cell[:2]):
            if order == CHECK:
                yield from (_batch([(order, part, block, data.as_py())]) for _, _, block, data in packets)
                continue
            bucket, blocks = Bucket(bucket_keys), []
            base = np.uint64(part) << _shift(buckets)
            for _, _, block, data in packets:
                view = _expand(data)
                n = struct.unpack_from("<I", view)[0]
                bucket.add(_unpack_keys(view[len(view) - 8 * n :], base), unpack_counts(view[: len(view) - 8 * n]))
                blocks.append(block)
            out, held = [], 0
            for block, totals in zip(blocks, bucket.answers(minimum), strict=True):
                out.append((order, part, block, _squeeze(pack_counts(totals))))
                held += len(out[-1][3])
                if held > 1 << 20:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)

    def own_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, data, offsets in _blocks(batches, block_bytes):
            n = len(ids)
            known = np.array([i is not None for i in ids], np.uint8)
            head = struct.pack("<I", n) + known.tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes() + np.diff(offsets).astype("<i8").tobytes()
            body = pa.Codec("zstd", compression_level=rows_level).compress(head + data.tobytes(), asbytes=True)
            yield _batch([(ROWS, len(head) + len(data), block, body)])

    def settle(table: pa.Table) -> pa.Table:
        kinds, parts, data = table.column("kind").to_pylist(), table.column("part").to_pylist(), table.column("data")
        if kinds.count(ROWS) != 1 or kinds.count(CHECK) != 1:
            raise RuntimeError(CHANGED)
        at = kinds.index(ROWS)
        raw = pa.decompress(data[at].as_buffer(), parts[at], codec="zstd", asbytes=True)
        n = struct.unpack_from("<I", raw)[0]
        known = np.frombuffer(raw, np.uint8, n, 4)
        ids = [int(i) if k else None for i, k in zip(np.frombuffer(raw, "<i8", n, 4 + n), known, strict=True)]
        offsets = np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<i8", n, 4 + 9 * n))])
        text = np.frombuffer(raw, np.uint8, offset=4 + 17 * n)
        if data[kinds.index(CHECK)].as_py() != _checksum(text, offsets):
            raise RuntimeError(CHANGED)
        totals: dict[int, list] = {}
        for i, kind in enumerate(kinds):
            if kind >= 0:
                totals.setdefault(kind, []).append((parts[i], unpack_counts(_expand(data[i]))))
        tables = []
        for order, keys in enumerate(keys_of(text, offsets)):
            own = distinct(keys)[0]
            counts = np.concatenate([c for _, c in sorted(totals.get(order, []), key=lambda x: x[0])] or [np.zeros(0, np.int64)])
            if len(own) != len(counts):
                raise RuntimeError(CHANGED)
            tables.append((own, counts))
        out = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(finish(ids, text, offsets, tables), types, strict=True)], names=[f.split()[0] for f in schema.split(", ")])
        del raw, text, tables, totals
        release()
        return out

    tasks = tasks_for(size)
    sent = mapped(rows, send, _PACKED).repartition(min(tasks, 3 * buckets), "kind", "part").sortWithinPartitions("kind", "part", "block")
    return mapped(sent, add_up, _PACKED).unionByName(mapped(rows, own_rows, _PACKED)).repartition(tasks, "block").groupBy("block").applyInArrow(settle, schema)
