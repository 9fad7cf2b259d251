"""Document fingerprints: a quartile bucket digest with a bounded difference score.

Six byte triplets in every five-byte window are hashed into 1024 buckets. A
bucket's two-bit code says in which quartile of all bucket counts its own lies;
the digest is the text's length on a logarithmic scale, a checksum and the codes. Two
digests differ by their codes and lengths; the difference is cut off at what
unrelated texts show, so that a likeness lies between 0 and 1.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped

BUCKETS = 1024
#: Offsets of the triplets in a five-byte window (all that hold its first byte), with a multiplier for each byte.
TRIPLETS = [(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)]
_FACTORS = [(0x9E37, 0x79B1, 0x85EB), (0xC2B3, 0x27D5, 0x1657), (0xB54D, 0x3C6F, 0xA54F), (0x510F, 0x9B05, 0x1F83), (0xCBBB, 0x629B, 0x9159), (0x152F, 0x6733, 0x8EB5)]
#: Difference at which two digests count as unrelated: the mean of random two-bit codes, 1.25 a bucket.
BOUND = BUCKETS * 5 // 4
#: Weight and limit of the length's part of a difference.
LENGTH_WEIGHT, LENGTH_MOST = 4, 32


def digest(data: bytes) -> bytes:
    """Length byte, checksum byte and 256 bytes of codes; equal texts have equal digests."""
    b = np.frombuffer(data, np.uint8).astype(np.uint16)
    n = len(b)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, n, 1 << 20):  # long texts in runs that share four bytes
        part = b[start : start + (1 << 20) + 4]
        m = len(part) - 4
        if m > 0:
            found = np.empty((len(TRIPLETS), m), np.uint16)
            for k, ((j, l), (x, y, z)) in enumerate(zip(TRIPLETS, _FACTORS, strict=True)):
                h = part[:m] * np.uint16(x)
                h += part[j : j + m] * np.uint16(y)
                h ^= part[l : l + m] * np.uint16(z)
                h *= np.uint16(0x9E35)
                np.right_shift(h, 6, out=found[k])
            counts += np.bincount(found.ravel(), minlength=BUCKETS)
    if 0 < n < 5:
        counts[b] += 1
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4, BUCKETS // 2, 3 * BUCKETS // 4]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    four = codes.reshape(-1, 4)
    body = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    length = min(255, round(12 * math.log2(n + 1) / 1.5))
    return bytes((length, hashlib.sha256(data).digest()[0])) + body.astype(np.uint8).tobytes()


def _codes(d: bytes) -> np.ndarray:
    body = np.frombuffer(d, np.uint8, offset=2)
    return np.stack([body & 3, body >> 2 & 3, body >> 4 & 3, body >> 6], axis=1).ravel().astype(np.int16)


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 from the bound on."""
    if a == b:
        return 1.0
    difference = int(np.abs(_codes(a) - _codes(b)).sum()) + LENGTH_WEIGHT * min(LENGTH_MOST, abs(a[0] - b[0])) + (a[1] != b[1])
    return 1 - min(difference, BOUND) / BOUND


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the digest of every whole text as lowercase hex; a null text counts as empty."""

    @F.pandas_udf("string")
    def of(texts):
        return texts.map(lambda t: digest((t or "").encode("utf-8", "surrogatepass")).hex())

    return docs.withColumn(name, of(F.col(text)))


def likeness_of(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns (hex); null where either is null."""

    @F.pandas_udf("double")
    def of(x, y):
        import pandas as pd

        return pd.Series([None if p is None or q is None else likeness(bytes.fromhex(p), bytes.fromhex(q)) for p, q in zip(x, y, strict=True)], dtype=float)

    return of(a, b)


def with_next(docs: DataFrame, key: str, text: str, partitions: int) -> tuple[DataFrame, int]:
    """Rows placed so that each partition holds a run of keys in order and, after it, the row that follows.

    Returns the placed rows (``ahead``, ``key``, ``text``: sorted, those with
    ``ahead`` = 1 belong to the next run) and the number of runs. Runs are cut at
    approximate quantiles of the keys; each run's smallest key goes once more to
    the run before, and the smallest of all to the last. The driver sees two
    numbers per partition. One shuffle; null keys come first.
    """
    ids = docs.select(F.col(key).cast("long").alias("key"))
    cuts = ids.approxQuantile("key", [k / partitions for k in range(1, partitions)], min(0.01, 0.25 / partitions)) if partitions > 1 else []
    bounds = sorted({int(x) for x in cuts})

    @F.pandas_udf("int")
    def run_of(keys):
        import pandas as pd

        known = keys.fillna(-(2**63) if not bounds else bounds[0] - 1).astype("int64").to_numpy()
        return pd.Series(np.searchsorted(np.array(bounds, np.int64), known, side="right"))

    filled = F.coalesce("key", F.lit(-(2**63)))
    heads = {r["run"]: r["head"] for r in ids.select(run_of(filled).alias("run"), filled.alias("key")).groupBy("run").agg(F.min("key").alias("head")).collect()}
    runs = sorted(heads)
    before = {heads[r]: runs[i - 1] for i, r in enumerate(runs)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(bounds, np.int64)
        for batch in batches:
            keys = batch.column(0).fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            run = np.searchsorted(edges, keys, side="right").astype(np.int32)
            extra = [i for i, k in enumerate(keys.tolist()) if k in before]
            for rows, where, ahead in ((None, run, 0), (extra, np.array([before[keys[i]] for i in extra], np.int32), 1)):
                part = batch if rows is None else batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(np.full(len(where), ahead, np.int32)), *part.columns], names=["run", "ahead", "key", "text"])

    placed = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = mapped(placed, place, "run int, ahead int, key long, text string")
    n = len(bounds) + 1
    return placed.repartitionById(n, F.col("run")).sortWithinPartitions("ahead", "key", "text").select("ahead", "key", "text"), n


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", partitions: int = 8) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likenesses to the edited and to the next text.

    Returns the key, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``. The next text is that of the
    next row by key (then text; null keys first), after the last the first; a single
    row follows itself. A null text counts as empty, repeated rows follow each
    other, and an empty table gives an empty table. Keys are whole numbers. Other columns
    are not read.
    """
    placed, _ = with_next(docs, key, text, partitions)
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        out: list[tuple] = []
        ended = False

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for ahead, k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if ended:
                    continue
                t = t.as_py()
                own = digest(t.encode("utf-8", "surrogatepass"))
                if last is not None:
                    pk, pt, pd = last
                    raw = edited(pt, t).encode("utf-8", "surrogatepass")
                    new = digest(raw)
                    out.append((pk, len(pt), hashlib.sha256(raw).hexdigest(), pd.hex(), new.hex(), likeness(pd, new), likeness(pd, own)))
                    if len(out) == 1000:
                        yield batch_of(out)
                        out.clear()
                last, ended = (k, t, own), ahead == 1
        if out:
            yield batch_of(out)

    schema = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return mapped(placed, run, schema).withColumnRenamed("key", key)


def runs_for(docs: DataFrame) -> int:
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
