"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every token has a fixed random index vector; a word's vector adds up the index
vectors of its neighbours over a bounded sample of labelled documents. A
document is the mean of its word vectors, the mean of bound neighbour pairs
(products of index vectors), and how often its words and lines repeat. A
two-layer numpy network is trained on the same sample, and a temperature fitted
on documents kept apart from training calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import mapped, written
from tessera.llm.hashing import chunks, hash_runs

#: Word buckets (hashed), vector length, neighbours on either side.
BUCKETS, WIDTH, NEAR = 1 << 15, 32, 2
#: Labelled documents that a model is fitted on, and bytes of their token ids (two each): the bounds of the driver's sample.
MAX_TRAIN, MAX_BYTES = 6_000, 128 << 20
#: Text bytes tokenised together, tokens pooled together.
CHUNK, POOL = 1 << 19, 1 << 15

#: Byte classes: 0 blank, 1 letters and all bytes of other alphabets, 2 digits, 3 punctuation, 4 line feed.
CLASS = np.full(256, 3, np.uint8)
CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 0
CLASS[0x0A] = 4
CLASS[ord("0") : ord("9") + 1] = 2
CLASS[ord("A") : ord("Z") + 1] = CLASS[ord("a") : ord("z") + 1] = 1
CLASS[128:] = 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token (runs of one byte class) of some documents, and the documents' token offsets."""
    if not len(data):
        return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
    kind = CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    real = kind[at[:-1]] != 0
    begin, end = at[:-1][real], at[1:][real]
    hashes = hash_runs(data, begin, end, kind != 0)
    return (hashes % np.uint64(BUCKETS)).astype(np.uint16), np.searchsorted(begin, offsets)


def line_repeats(data: np.ndarray, a: int, b: int) -> float:
    """Share of a document's lines that repeat an earlier one."""
    lines = [x for x in data[a:b].tobytes().split(b"\n") if x]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


def index_vectors(seed: int = 11) -> np.ndarray:
    """Sparse ternary index vectors, one per bucket."""
    draw = np.random.default_rng(seed)
    return draw.choice(np.array([-1, 0, 1], np.float32), size=(BUCKETS, WIDTH), p=[0.25, 0.5, 0.25])


def word_vectors(docs: list[np.ndarray], index: np.ndarray) -> np.ndarray:
    """Unit vectors of the words: own index vector plus those of the neighbours in the sample."""
    total = index.astype(np.float64)
    for start in range(0, len(docs), 200):
        part = docs[start : start + 200]
        ids = np.concatenate(part).astype(np.int64)
        of = np.repeat(np.arange(len(part)), [len(x) for x in part])
        for k in range(1, NEAR + 1):
            same = of[k:] == of[:-k]
            left, right = ids[:-k][same], ids[k:][same]
            pair, n = np.unique(np.concatenate([left * BUCKETS + right, right * BUCKETS + left]), return_counts=True)
            word, other = pair // BUCKETS, pair % BUCKETS
            for d in range(WIDTH):
                total[:, d] += np.bincount(word, weights=n * index[other, d], minlength=BUCKETS)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(ids: np.ndarray, repeated_lines: float, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Features of one document; of an empty one, zeros."""
    n = len(ids)
    out = np.zeros(2 * WIDTH + 4, np.float64)
    if not n:
        return out
    for a in range(0, n, POOL):
        part = ids[a : a + POOL + 1]
        out[:WIDTH] += vectors[part[:POOL]].sum(axis=0)
        if len(part) > 1:
            bound = index[part]
            out[WIDTH : 2 * WIDTH] += (bound[1:] * bound[:-1]).sum(axis=0)
    out /= n
    counts = np.bincount(ids, minlength=1)
    counts = counts[counts > 0].astype(np.float64)
    out[-4:] = np.log1p(n) / 10, np.log(len(counts)) / np.log(n + 1), np.log((counts**2).sum() / n**2), repeated_lines
    return out


def document_features(docs: DataFrame, text: str, name: str, kind: str, of: Callable[[list[tuple[np.ndarray, float]]], list]) -> DataFrame:
    """Adds the column ``name``: ``of(documents)`` over the token ids and the share of repeated lines of many texts at once."""
    schema = StructType([*docs.schema.fields]).add(name, kind)
    names, at_text, made = [*docs.columns, name], docs.columns.index(text), {"binary": pa.binary(), "double": pa.float64()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list = []
            for _, _, data, offsets in chunks(batch, at_text, CHUNK):
                ids, at = tokens(data, offsets)
                found += of([(ids[at[d] : at[d + 1]], line_repeats(data, offsets[d], offsets[d + 1])) for d in range(len(offsets) - 1)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, made)], names=names)

    return mapped(docs, run, schema)


@dataclass
class Model:
    """Word vectors, network and temperature; or a constant where the labels hold one class or none."""

    constant: float | None
    vectors: np.ndarray | None = None
    layers: tuple = ()
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        mean, scale, w1, b1, w2, b2 = self.layers
        return np.tanh(np.clip((x - mean) / scale, -6, 6) @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _train(x: np.ndarray, y: np.ndarray, hidden: int = 32, steps: int = 400, rate: float = 0.01, decay: float = 2e-3) -> tuple:
    """Adam on the cross-entropy, classes weighted alike in training."""
    draw = np.random.default_rng(5)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.clip((x - mean) / scale, -6, 6)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    params = [draw.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), draw.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(())]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        h = np.tanh(z @ params[0] + params[1])
        p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
        g = (p - y) * weight
        gh = np.outer(g, params[2]) * (1 - h**2)
        grads = [z.T @ gh + decay * params[0], gh.sum(axis=0), h.T @ g + decay * params[2], g.sum()]
        for i, d in enumerate(grads):
            m[i], v[i] = 0.9 * m[i] + 0.1 * d, 0.999 * v[i] + 0.001 * d * d
            params[i] = params[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return mean, scale, *params


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_train: int = MAX_TRAIN, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on at most ``max_train`` labelled documents, chosen by a hash of the key, and no more of them than ``max_bytes`` hold.

    Rows without key or label don't count; of repeated labels of one key the
    lowest holds. The sample's keys (bounded) are broadcast, and its token
    ids come to the driver. A fifth of the sample is kept for the temperature.
    """
    named = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(F.col(label).cast("int")).alias("_y"))
    sample = named.orderBy(F.xxhash64("_k"), "_k").limit(max_train)
    one = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(sample), F.col("_key") == F.col("_k")).select("_key", F.col("_y").cast("int").alias("_y"), "_text")
    packed = lambda found: [np.float64(r).tobytes() + ids.tobytes() for ids, r in found]
    # rows of one key count once, in a fixed order, before they leave the executors
    found = document_features(one, "_text", "f", "binary", packed).groupBy("_key", "_y").agg(F.min("f").alias("f"))
    found = written(found.withColumn("at", F.xxhash64("_key")), "quality-sample")
    last, size = (-(2**63), None), 0
    for r in found.select("at", "_key", F.length("f").alias("n")).orderBy("at", "_key").collect():
        size += r["n"]
        if size > max_bytes:
            break
        last = r["at"], r["_key"]
    within = (F.col("at") < last[0]) | ((F.col("at") == last[0]) & (F.col("_key") <= F.lit(last[1])))
    rows = found.where(within).orderBy("_key").collect()
    y = np.array([r["_y"] for r in rows], np.float64)
    if len(rows) < 10 or y.min() == y.max():
        return Model(constant=float(y.mean()) if len(y) else 0.5)
    ids = [np.frombuffer(r["f"], np.uint16, offset=8) for r in rows]
    repeats = [np.frombuffer(r["f"], np.float64, 1)[0] for r in rows]
    index = index_vectors()
    apart = np.random.default_rng(3).permutation(len(rows)) < len(rows) // 5
    vectors = word_vectors([d for d, out in zip(ids, apart, strict=True) if not out], index)
    x = np.stack([pooled(d, r, vectors, index) for d, r in zip(ids, repeats, strict=True)])
    model = Model(None, vectors, _train(x[~apart], y[~apart]))
    logits = model.logits(x[apart])
    heat = np.exp(np.linspace(-2, 3, 101))
    loss = [np.logaddexp(0, np.where(y[apart] == 1, -1, 1) * logits / t).mean() for t in heat]
    model.temperature = float(heat[int(np.argmin(loss))])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add ``score``, the probability of label 1, to every row, from its whole text alone.

    A null text counts as empty and gets the score of a document without words.
    A column of that name (not the text's) is replaced, others may have any names; an empty
    table gives an empty table.
    """
    docs = docs.drop(name)
    if model.constant is not None:
        return docs.withColumn(name, F.lit(model.constant))
    cache: dict = {}

    def probabilities(found: list[tuple[np.ndarray, float]]) -> list:
        if "index" not in cache:
            cache["index"] = index_vectors()
        return model.probability(np.stack([pooled(ids, r, model.vectors, cache["index"]) for ids, r in found])).tolist() if found else []

    return document_features(docs, text, name, "double", probabilities)


def held_out(key: Column) -> Column:
    """Documents never learned from: CRC-32 of the key as text, modulo 4, is 2."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % 4 == 2
