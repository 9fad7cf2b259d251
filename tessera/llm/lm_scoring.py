"""Language-model scoring: stupid-backoff scores from n-gram count tables.

The tables hold every n-gram of the corpus, order by order, partitioned by the
n-gram's hash; the exploded n-grams of each document are joined to them, and the
logarithms are added up per document:

    S(w | context) = c(context w) / c(context)   where c(context w) >= cutoff
                   = 0.4 * S(w | shorter context) otherwise;   S(w) = c(w) / N
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.counting import count_and_finish
from tessera.llm.hashing import CHUNK, grams, words

#: Fixed value: the published backoff factor.
BACKOFF = 0.4


def _grams_of(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each n: the keys of all n-grams, and the word position of each one's last word; n = 0 counts the words."""
    hashes, at = _all_words(data, offsets)
    start = np.repeat(at[:-1], np.diff(at))
    keys, last = [np.zeros(len(hashes), np.uint64)], [np.arange(len(hashes))]
    for n in range(1, order + 1):
        ends = np.arange(n - 1, len(hashes))
        inside = ends - (n - 1) >= start[ends] if len(ends) else np.zeros(0, bool)
        keys.append(grams(hashes, n)[inside])
        last.append(ends[inside])
    return keys, last


def _all_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at, base, row, n = [], [np.zeros(1, np.int64)], 0, 0, len(offsets) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        h, o = words(data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row])
        found.append(h)
        at.append(o[1:] + base)
        base += len(h)
        row = to
    return np.concatenate(found or [np.zeros(0, np.uint64)]), np.concatenate(at)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = 3, cutoff: int = 2) -> DataFrame:
    """Key, ``n_words`` and ``log_score`` (natural logarithm, summed over the words) of every row.

    Counts come from all rows, repeated ones as often as they occur. N-grams of
    two and more words under ``cutoff`` count as unseen. A null or empty text
    has no words and score 0; an empty table gives an empty table; null keys
    pass through. Keys are whole numbers (a locator
    for others). Other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("data"))

    def keys_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return _grams_of(data, offsets, order)[0]

    def finish(ids: list, data: np.ndarray, offsets: np.ndarray, tables: list) -> list[list]:
        keys, last = _grams_of(data, offsets, order)
        n = len(keys[0])
        count = np.zeros((order + 1, n))  # of the n-gram that ends at each word; 0 where there is none
        for k in range(order + 1):
            own, totals = tables[k]
            count[k, last[k]] = totals[np.searchsorted(own, keys[k])]
        score = np.log(np.maximum(count[1], 1)) - np.log(np.maximum(count[0], 1))
        for k in range(2, order + 1):
            context = np.concatenate([np.zeros(1), count[k - 1, :-1]]) if n else count[k - 1]
            has = np.zeros(n, bool)
            has[last[k]] = True
            seen = has & (count[k] >= cutoff)
            longer = np.log(np.maximum(count[k], 1)) - np.log(np.maximum(context, 1))
            score = np.where(seen, longer, np.where(has, score + np.log(BACKOFF), score))
        at = _all_words(data, offsets)[1]
        sums = np.concatenate([[0.0], np.cumsum(score)])
        per = np.add.reduceat(np.append(score, 0.0), np.minimum(at[:-1], n)) if len(at) > 1 else sums[:0]
        per = np.where(np.diff(at) > 0, per, 0.0)
        return [ids, np.diff(at), per]

    scored = count_and_finish(rows, keys_of, finish, "id long, n_words long, log_score double", [pa.int64(), pa.int64(), pa.float64()], rows_level=6)
    return scored.withColumnRenamed("id", key)
