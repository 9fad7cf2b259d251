"""Exact top-k inner products with block-at-a-time pruning.

Vectors are laid out in blocks: ranges of an order that puts like vectors together (the
signs of seeded projections), each with a forward index (its vectors as integers) and
the least and largest value of every component, its terms. The sum of a query's term maxima
over a block bounds every score in it:

    bound(query, block) = sum over components of max(q * low, q * high)

A query's kth score starts from the block that it stands in. Groups of queries keep the
blocks whose bound reaches the kth score of one of them, score them in descending order of
bound through their forward indexes, and leave each query out as soon as the bound falls
below its kth score. Scores are whole numbers and exact; no candidate is dropped otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, written

#: Vectors of a block, queries of a group, and blocks whose bounds are taken together.
BLOCK, GROUP, CHUNK = 512, 1_024, 256
#: A group's blocks are dealt to so many tasks at most, each with so many blocks of the index at least.
STRIPES, STRIPE_BLOCKS = 64, 32
#: Vectors of one range of the order.
RANGE = 65_536
#: Seeded projections whose signs order the vectors.
SIGNS, SEED = 14, 13
#: Whole numbers up to here are exact in a double.
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
LARGEST = np.finfo(np.float64).max


def whole_vectors(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a usable vector, and floor(scale * x) of them as doubles, shorter ones ended with zeros.

    Null vectors and those that hold a null or a value that isn't finite are not usable.
    """
    known = ~np.asarray(column.is_null())
    flat = column.flatten()
    at = np.concatenate([[0], np.cumsum(np.where(known, np.asarray(column.value_lengths().fill_null(0)), 0))])
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    with np.errstate(over="ignore"):
        values = np.clip(np.floor(scale * values), -LARGEST, LARGEST)
    use = np.flatnonzero(known & (bad[at[1:]] == bad[at[:-1]]))
    width = int(np.diff(at)[use].max()) if len(use) else 0
    place = np.arange(width)[None, :]
    size = np.diff(at)[use][:, None]
    out = np.where(place < size, values[np.minimum(at[use][:, None] + place, max(len(values) - 1, 0))] if len(values) else 0.0, 0.0)
    return use, out


def order_code(vectors: np.ndarray) -> np.ndarray:
    """The signs of seeded projections as one number. It only orders vectors; no result depends on it."""
    code = np.zeros(len(vectors), np.int64)
    for k in range(SIGNS):
        weights = np.random.default_rng((SEED, k)).standard_normal(vectors.shape[1])
        with np.errstate(over="ignore", invalid="ignore"):
            code = code * 2 + (vectors @ weights > 0)
    return code


def packed(numbers: np.ndarray) -> bytes:
    """A type letter and the numbers in the smallest type that holds them."""
    if not numbers.size or (abs(numbers).max() < 1 << 15):
        return b"h" + numbers.astype("<i2").tobytes()
    return b"i" + numbers.astype("<i4").tobytes() if abs(numbers).max() < 1 << 31 else b"d" + numbers.astype("<f8").tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    kind = {"h": "<i2", "i": "<i4", "d": "<f8"}[chr(data[0])]
    return np.frombuffer(data, kind, offset=1).astype(np.float64).reshape(rows, -1)


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products as longs; those beyond a long are its ends."""
    queries, vectors = _same_width(queries, vectors)
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    if abs(queries).max() * abs(vectors).max() * queries.shape[1] < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = [[int(x) for x in v] for v in vectors]
    return np.array([[max(LEAST, min(MOST, sum(int(a) * b for a, b in zip(q, v, strict=True)))) for v in whole] for q in queries], np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and block a number that no score of the block exceeds."""
    queries, low = _same_width(queries, low)
    _, high = _same_width(queries, high)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        sums = up @ high.T + down @ low.T
        reach = abs(queries) @ np.maximum(abs(low), abs(high)).T
        sums = np.where(reach < EXACT, sums, sums + reach * 1e-9)  # beyond, doubles are rounded
    return np.where(np.isfinite(sums), sums, np.inf)


def best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id, then first row."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        among = np.flatnonzero(score >= least)
    else:
        among = np.arange(len(score))
    return among[np.lexsort((rows[among], ids[among], ~score[among]))[:k]]


def _blocks(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """The index: ``block``, ``ids`` and ``rows`` (arrays), ``width``, ``low``, ``high``, ``forward``; written."""
    spark = vectors.sparkSession
    located = vectors.select(F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(vector).cast("array<double>").alias("vector"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            use, whole = whole_vectors(batch.column(2), scale)
            kept = batch.take(pa.array(use)) if len(use) else batch.slice(0, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(use) + 1) * whole.shape[1], pa.int32()), pa.array(whole.ravel()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), lists, pa.array(order_code(whole))], names=["id", "row", "vector", "code"])

    n = vectors.count()
    ranges = max(1, min(n // RANGE + spark.sparkContext.defaultParallelism, n // BLOCK + 1))
    dealt = mapped(located, coded, "id long, row long, vector array<double>, code long").repartitionByRange(ranges, "code", "id", "row").sortWithinPartitions("code", "id", "row")
    dealt = dealt.withColumn("part", F.spark_partition_id())

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        made = 0

        def block(table: pa.Table) -> pa.RecordBatch:
            nonlocal made
            _, whole = whole_vectors(table.column("vector").combine_chunks(), 1.0)
            number = (table.column("part")[0].as_py() << 33) + made
            made += 1
            ids, rows = ([table.column(c).to_pylist()] for c in ("id", "row"))
            columns = [[number], ids, rows, [whole.shape[1]], [packed(whole.min(axis=0))], [packed(whole.max(axis=0))], [packed(whole)]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["block", "ids", "rows", "width", "low", "high", "forward"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            while sum(t.num_rows for t in held) >= BLOCK:
                table = pa.concat_tables(held)
                yield block(table.slice(0, BLOCK))
                held = [table.slice(BLOCK)]
        if sum(t.num_rows for t in held):
            yield block(pa.concat_tables(held))

    return written(mapped(dealt, index, "block long, ids array<long>, rows array<long>, width int, low binary, high binary, forward binary"), "vector-blocks")


#: Stands for a null key in arrays.
_NO_ID = np.iinfo(np.int64).max


def _members(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (null: the largest), rows and vectors of a block."""
    ids = batch.column("ids")[i].values.fill_null(_NO_ID).to_numpy()
    return ids, batch.column("rows")[i].values.to_numpy(), unpacked(batch.column("forward")[i].as_py(), len(ids))


def _groups(index: DataFrame, every: int, k: int) -> DataFrame:
    """Packed queries: ``g``, ``ids``, ``rows``, ``kth`` (the kth score that their own block gives), ``vectors``; written."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, np.ndarray]] = []

        def group() -> pa.RecordBatch:
            width = max(len(v) for *_, v in held)
            vectors = np.stack([np.pad(v, (0, width - len(v))) for *_, v in held])
            columns = [[held[0][1]], [[h[0] for h in held]], [[h[1] for h in held]], [[h[2] for h in held]], [packed(vectors)]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["g", "ids", "rows", "kth", "vectors"])

        for batch in batches:
            for i in range(batch.num_rows):
                ids, rows, vectors = _members(batch, i)
                chosen = np.flatnonzero((ids % every == 0) & (ids != _NO_ID))
                own = scores(vectors[chosen], vectors)
                for c, s in zip(chosen, own, strict=True):
                    others = np.delete(s, c)
                    kth = int(np.partition(others, len(others) - k)[len(others) - k]) if len(others) >= k else LEAST
                    held.append((int(ids[c]), int(rows[c]), kth, vectors[c]))
                    if len(held) == GROUP:
                        yield group()
                        held = []
        if held:
            yield group()

    rows = index.select("ids", "rows", "forward")
    return written(mapped(rows, gather, "g long, ids array<long>, rows array<long>, kth array<long>, vectors binary"), "query-groups")


def _wanted(index: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """``g``, ``block``, ``bound``: the blocks that a query of a group may need, with the group's largest bound.

    Summaries are packed, so groups meet them some hundred blocks at a time.
    """
    chunks = max(1, -(-blocks // CHUNK))
    summaries = index.select(F.pmod(F.xxhash64("block"), F.lit(chunks)).alias("chunk"), F.struct("block", "width", "low", "high").alias("s")).groupBy("chunk").agg(F.collect_list("s").alias("summaries"))
    dealt = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))).join(summaries, "chunk")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = batch.column("summaries")[i].as_py()
                width = max(s["width"] for s in found)
                low, high = (np.stack([np.pad(unpacked(s[c], 1)[0], (0, width - s["width"])) for s in found]) for c in ("low", "high"))
                kth = batch.column("kth")[i].values.to_numpy()
                most = bounds(unpacked(batch.column("vectors")[i].as_py(), len(kth)), low, high)
                some = np.flatnonzero((most >= kth[:, None].astype(np.float64)).any(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("g")[i].as_py()] * len(some), pa.int64()), pa.array([found[j]["block"] for j in some], pa.int64()), pa.array(most.max(axis=0)[some], pa.float64())], names=["g", "block", "bound"])

    return mapped(dealt.select("g", "kth", "vectors", "summaries"), bound, "g long, block long, bound double")


def top_k(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, every: int = 100, scale: float = 1024.0) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the k highest inner products of each query with all other rows.

    Components count as floor(scale * x), x as a double; queries are the rows whose key ``every``
    divides. Ties go to the smaller key, then to the earlier row; a null key comes last and is never a query.
    Rows of one key are different rows: each may be a candidate, and each queries for itself. Null vectors and
    vectors that hold a null or a value that isn't finite take no part; shorter vectors count as
    ended with zeros; a score beyond a long is the long's end. An empty table gives an empty
    table; other columns aren't read. Keys are whole numbers under 2^63 - 1.
    """
    index = _blocks(vectors, key, vector, scale)
    blocks = index.select("block").count()
    groups = _groups(index, every, k)
    stripes = max(1, min(STRIPES, blocks // STRIPE_BLOCKS))
    wanted = _wanted(index, groups, blocks)
    fetched = wanted.join(index.select("block", "ids", "rows", "forward"), "block").select("g", F.pmod(F.xxhash64("block"), F.lit(stripes)).alias("stripe"), "bound", "ids", "rows", "forward", F.lit(None).cast("array<long>").alias("kth"), F.col("block").alias("tie"))
    heads = groups.select("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stripes - 1).cast("long"))).alias("stripe"), F.lit(float("inf")).alias("bound"), "ids", "rows", F.col("vectors").alias("forward"), "kth", F.lit(-1).cast("long").alias("tie"))
    # a group's queries stand before its blocks, these in descending order of bound
    ordered = heads.unionByName(fetched).repartition("g", "stripe").sortWithinPartitions("g", "stripe", F.desc("bound"), "tie")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query", "query_id", "vec_id", "score", "row"]
        queries = kth = own_ids = own_rows = None
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def results() -> Iterator[pa.RecordBatch]:
            if queries is not None and len(found):
                sizes = [len(s) for s, _, _ in found]
                score, ids, rows = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own_rows, sizes)), pa.array(np.repeat(own_ids, sizes)), pa.array(ids, mask=ids == _NO_ID), pa.array(score), pa.array(rows)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                ids, rows, members = _members(batch, i)
                if batch.column("kth")[i].is_valid:
                    yield from results()
                    queries, own_ids, own_rows = members, ids, rows
                    kth = batch.column("kth")[i].values.to_numpy().copy()
                    found = [(np.zeros(0, np.int64),) * 3 for _ in kth]
                    continue
                most = bounds(queries, members.min(axis=0)[None, :], members.max(axis=0)[None, :])[:, 0]
                open_now = np.flatnonzero(most >= kth.astype(np.float64))
                for q, s in zip(open_now, scores(queries[open_now], members), strict=True):
                    near = np.flatnonzero((s >= kth[q]) & (rows != own_rows[q]))
                    if len(near):
                        score, its, at = (np.concatenate(c) for c in zip(found[q], (s[near], ids[near], rows[near]), strict=True))
                        kept = best(score, its, at, k)
                        found[q] = score[kept], its[kept], at[kept]
                        if len(kept) == k:
                            kth[q] = max(kth[q], found[q][0][-1])
        yield from results()

    scored = mapped(ordered, search, "query long, query_id long, vec_id long, score long, row long")
    listed = F.slice(F.sort_array(F.collect_list(F.struct(F.bitwise_not("score").alias("down"), F.col("vec_id").isNull().alias("none"), "vec_id", "row", "score"))), 1, k)
    tops = scored.groupBy("query", "query_id").agg(listed.alias("best"))  # k of each stripe
    return tops.select("query_id", F.posexplode("best").alias("place", "hit")).select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
