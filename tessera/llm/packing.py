"""Packing: token sequences cut by order-preserving dynamic programming.

The tokens of a block of documents, in their order, form one line. A cut may fall
after a document (free), after a sentence (small penalty) or, where sentences
run long, at a stride inside one (large penalty). The programme picks the cuts
that minimise padding plus penalties:

    best(j) = penalty(j) + min over i in [j - window, j) of best(i) + window - (j - i)

and a monotone queue holds the candidates i, so each cut is pushed and popped once.
"""

from __future__ import annotations

import base64
import functools
import json
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, release

#: Tokens whose cuts are chosen together; bounds a worker's memory (longer documents are blocks of their own).
BLOCK_TOKENS = 1 << 18
#: Token ids that close a document, and penalties in tokens of padding.
SEPARATOR, SENTENCE_COST, STRIDE_COST, STRIDE = 0, 2.0, 12.0, 16

SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@functools.cache
def _slow(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))


@functools.cache
def tokenizer(name: str) -> tuple[Callable[[str], np.ndarray], np.ndarray]:
    """Encoder of a public byte-level vocabulary, and for each id whether a sentence may end with it.

    The rank file holds the same vocabulary as the JSON file and encodes about
    four times as fast in less memory; the JSON file's tokenizer is loaded only
    for a text on which that encoder fails.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as file:
        special = {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as error:  # the rank encoder panics on some runs of a million characters
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(_slow(name).encode(text, add_special_tokens=False).ids, np.uint32)

    ends = np.zeros(len(ranks) + len(special) + 1, bool)
    for token, i in ranks.items():
        ends[i] = token.rstrip(b"\"')").endswith((b".", b"!", b"?", b"\n"))
    return encode, ends


def choose_cuts(positions: np.ndarray, penalties: np.ndarray, window: int) -> list[int]:
    """Positions of the cuts that minimise padding plus penalties.

    ``positions`` ascends from 0 to the line's length with no gap above
    ``window``; the last one is always cut.
    """
    at, cost = positions.tolist(), penalties.tolist()
    n = len(at)
    best, came = [0.0] * n, [0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # best(i) + position of i, ascending in both
    for j in range(1, n):
        p = at[j]
        least = p - window
        while queue[0][1] < least:
            queue.popleft()
        value, _, i = queue[0]
        best_j = value - p + window + cost[j]
        best[j], came[j] = best_j, i
        key = best_j + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


def cut_candidates(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions in a line of tokens with their penalties: documents, sentences, and strides within longer gaps."""
    cost = np.full(len(ids) + 1, -1.0)
    cost[1:][ends[ids]] = SENTENCE_COST
    cost[0] = 0.0
    cost[doc_ends] = 0.0
    marked = np.flatnonzero(cost >= 0)
    gaps = np.diff(marked)
    long = np.flatnonzero(gaps > stride)
    if len(long):
        n = (gaps[long] - 1) // stride
        first = np.repeat(marked[long], n)
        steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
        cost[first + steps * stride] = STRIDE_COST
        marked = np.flatnonzero(cost >= 0)
    return marked, cost[marked]


def _pieces(ids: np.ndarray, starts: np.ndarray, keys: list, sequence: int, ends: np.ndarray, window: int) -> tuple[list, int]:
    """Rows of one block; starts: of its documents, and the line's length."""
    cuts = np.array([0, *choose_cuts(*cut_candidates(ids, starts[1:], ends), window)])
    bounds = np.union1d(starts, cuts)
    begin, end = bounds[:-1], bounds[1:]
    doc = np.searchsorted(starts, begin, side="right") - 1
    cut = np.searchsorted(cuts, begin, side="right") - 1
    raw = ids.astype("<u4").tobytes()  # bytes, not a memoryview: an Arrow array made of views keeps their buffer for good
    tokens = np.diff(starts)
    rows = [
        [keys[d] for d in doc.tolist()], begin - starts[doc], end - begin, [raw[4 * a : 4 * b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)],
        tokens[doc], sequence + cut, begin - cuts[cut],
    ]
    return rows, sequence + len(cuts) - 1


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 1024, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """Pieces of token sequences: key, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is its text's ids and id 0; a null or empty text is id 0 alone.
    Every id lies in one piece; the pieces of a sequence follow each other from
    offset 0 and have at most ``window`` tokens together. ``ids`` holds
    little-endian unsigned 32-bit ids. Rows keep the order in which the table's
    partition lists them and no row is shuffled: every partition packs its own
    blocks of documents, and only a block's last sequence can be far from
    full. Repeated rows are packed as often as they occur, null keys pass
    through, keys may be of any type, and an empty table gives an empty table. Other columns
    are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends = tokenizer(vocabulary)
        sequence = -1
        line: list[np.ndarray] = []
        keys: list = []
        size = 0
        close = np.array([SEPARATOR], np.uint32)
        kind = pa.int64()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, size
            if not keys:
                return
            starts = np.concatenate([[0], np.cumsum([len(x) for x in line])])
            rows, sequence = _pieces(np.concatenate(line), starts, keys, sequence, ends, window)
            line.clear(), keys.clear()
            size = 0
            release()
            for a in range(0, len(rows[0]), 500):
                part = [r[a : a + 500] for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(x, {0: kind, 3: pa.binary()}.get(i, pa.int64())) for i, x in enumerate(part)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            kind = batch.column(0).type
            if sequence < 0 and batch.num_rows:
                sequence = batch.column(2)[0].as_py() << 40  # the table's own partition
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(t.as_py() or ""), close])
                if size + len(ids) > BLOCK_TOKENS:
                    yield from flush()
                line.append(ids), keys.append(k)
                size += len(ids)
        yield from flush()

    packed = mapped(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.spark_partition_id().alias("at")), run, f"doc_id {dict(docs.dtypes)[key]}, {SCHEMA}")
    return packed.withColumnRenamed("doc_id", key)
