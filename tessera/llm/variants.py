"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

A trie of the words and a trie of the reversed words number every prefix and every
suffix that several words share. A word without its code point i is the integer pair
(node of the prefix before i, node of the suffix after i); a whole word, cut at i, is
the pair (prefix up to i, suffix from i). Two words differ by a replaced code point
where their skipped pairs at i are equal, and by an inserted one where a skipped pair
equals a whole one: two equality joins on integers, exact, without candidates to verify.

A prefix that only one word has can't be in another word's pair, so neither its node
nor its pairs are made; this is exact and leaves few pairs of long words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, written
from tessera.llm.hashing import chunks

#: A run is [A-Za-z] and U+00C0 to U+00FF, in UTF-8 the byte C3 and 80 to BF.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LEAD = 0xC3
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Distinct words of a task that are counted together before they leave it.
HELD = 400_000
#: Bytes of a word whose checksum is taken with all others' byte by byte; longer words one by one.
SHORT = 48
#: Words of one range of a trie, their bytes, and pairs of one task.
RANGE_WORDS, RANGE_BYTES, TASK_PAIRS = 200_000, 8 << 20, 1_000_000


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = _crc_table()


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of letters, and the text that it is in."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = LETTER[data]
    lead = np.flatnonzero(data == LEAD)  # in UTF-8 always followed by 80 to BF
    inside[lead] = True
    inside[lead + 1] = True
    starts = np.zeros(n + 1, bool)
    starts[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~starts[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~starts[1:]
    begin = np.flatnonzero(inside & ~before)
    return begin, np.flatnonzero(inside & ~after) + 1, np.searchsorted(offsets, begin, side="right") - 1


def checksums(data: np.ndarray, begin: np.ndarray, end: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """CRC-32 of bytes that have the CRC-32 ``heads``, followed by data[begin:end]."""
    length = end - begin
    state = heads.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] <= SHORT]
    bound = np.searchsorted(-length[order], -np.arange(SHORT), side="left")  # words with a byte k
    for k in range(int(length[order[0]]) if len(order) else 0):
        own = order[: bound[k]]
        state[own] = CRC[(state[own] ^ data[begin[own] + k]) & np.uint32(255)] ^ (state[own] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > SHORT):
        state[i] = zlib.crc32(data[begin[i] : end[i]], int(heads[i]))
    return state


def damaged_words(data: np.ndarray, offsets: np.ndarray, heads: np.ndarray, shortest: int, every: int) -> pa.StringArray:
    """The runs of ``shortest`` code points and more, lower-cased, one code point of every so many of them deleted.

    ``heads``: CRC-32 of ``<key>:`` of each text. A run whose checksum (of key and run) ``every`` divides
    loses its code point at checksum % length; runs that are then too short go.
    """
    begin, end, text = runs(data, offsets)
    data = LOWER[data]
    whole = (data & 0xC0) != 0x80  # the first byte of a code point
    point = np.concatenate([[0], np.cumsum(whole)])
    long = np.flatnonzero(point[end] - point[begin] >= shortest)
    begin, end, text = begin[long], end[long], text[long]
    points = point[end] - point[begin]
    gone = np.zeros(len(data), bool)
    if every:
        h = checksums(data, begin, end, heads[text]).astype(np.int64)
        hit = np.flatnonzero(h % every == 0)
        at = np.flatnonzero(whole)[point[begin[hit]] + h[hit] % points[hit]]
        gone[at] = True
        gone[at[data[at] == LEAD] + 1] = True
        left = np.ones(len(begin), bool)
        left[hit] = points[hit] > shortest
        begin, end = begin[left], end[left]
    step = np.zeros(len(data) + 1, np.int8)
    step[begin] += 1
    step[end] -= 1
    kept = (np.cumsum(step[:-1]) > 0) & ~gone
    upto = np.concatenate([[0], np.cumsum(kept)])
    at = np.concatenate([[0], np.cumsum(upto[end] - upto[begin])]).astype(np.int32)
    return pa.StringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(data[kept]))


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, at_least: int = 2, every: int = 31) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, of words with ``at_least`` of them.

    A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, damaged as
    ``damaged_words`` says (``every=0``: not at all). Tasks count before the shuffle, so a word that is everywhere
    costs a row a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def summed() -> pa.Table:
            return pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            keys = [zlib.crc32(f"{'' if k is None else k}:".encode()) for k in batch.column(0).to_pylist()]
            heads = np.array(keys, np.uint32)
            for a, b, data, offsets in chunks(batch, 1):
                found = damaged_words(data, offsets, heads[a:b], shortest, every).value_counts()
                held.append(pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"]))
                size += len(found)
            if size > HELD:
                table = summed()
                held, size = table.to_batches(), table.num_rows
                if size > HELD // 2:
                    yield from held
                    held, size = [], 0
        if held:
            yield from summed().to_batches()

    counted = mapped(docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")), count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)


def common(a: str, b: str) -> int:
    """Code points that both words begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1  # a[:low] == b[:low], a[:high + 1] != b[:high + 1]
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def number_nodes(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    """For each of a range's sorted distinct words its place and the nodes of the prefixes that it shares with a neighbour.

    Nodes are numbered as the range comes to them: the first word's prefix of d code
    points is node d. The range's first and last word list all their prefixes, because
    words of the ranges beside may share them.
    """
    path: list[int] = []
    made = 0
    shared = 0
    for i, word in enumerate(words):
        onward = common(word, words[i + 1]) if i + 1 < len(words) else len(word)
        upto = max(shared, onward) if i else len(word)
        del path[shared + 1 :]
        while len(path) <= upto:
            path.append(made)
            made += 1
        yield i, path[: upto + 1]
        shared = onward


def _numbered(rows: DataFrame, column: str, name: str, keep: list[str]) -> tuple[DataFrame, dict[int, list[int]]]:
    """Rows with ``<name>_part``, ``<name>_at`` and ``<name>_path`` of the trie of ``column``, and for each range the nodes that it inherits.

    Ranges of sorted words are numbered apart. Of a range the driver sees its first
    and last word and the last one's path: as many rows as ranges.
    """
    spark = rows.sparkSession
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()
    ranges = max(1, min(max(n // RANGE_WORDS, size // RANGE_BYTES) + spark.sparkContext.defaultParallelism, n))
    dealt = rows.select(*keep, column).repartitionByRange(ranges, column).sortWithinPartitions(column)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema] + [f"{name}_part int", f"{name}_at long", f"{name}_path array<int>", f"{name}_edge array<string>"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        part = TaskContext.get().partitionId()
        words = table.column(column).to_pylist()
        paths = pa.array([p for _, p in number_nodes(words)], pa.list_(pa.int32()))
        edges = pa.array([[words[0], words[-1]]] + [None] * (len(words) - 1), pa.list_(pa.string()))
        if len(words) > 1:
            edges = pa.concat_arrays([edges.slice(0, len(words) - 1), pa.array([[]], pa.list_(pa.string()))])
        table = table.append_column(f"{name}_part", pa.array(np.full(len(words), part, np.int32)))
        table = table.append_column(f"{name}_at", pa.array(np.arange(len(words)) + (part << 33)))
        yield from table.append_column(f"{name}_path", paths).append_column(f"{name}_edge", edges).to_batches(max_chunksize=20_000)

    numbered = written(mapped(dealt, number, schema), f"trie-{name}")
    marked = numbered.where(f"{name}_edge IS NOT NULL").select(f"{name}_part", f"{name}_edge", f"{name}_path").collect()
    inherited = inherited_nodes({r[0]: tuple(r[1]) for r in marked if r[1]}, {r[0]: r[2] for r in sorted(marked, key=lambda r: len(r[1]), reverse=True)})
    return numbered.drop(f"{name}_edge"), inherited


def inherited_nodes(edges: dict[int, tuple[str, str]], last: dict[int, list[int]]) -> dict[int, list[int]]:
    """For each range the numbers, in all ranges' numbering, of its first word's prefixes that the range before has too.

    ``edges``: first and last word of each range; ``last``: the path of the last word.
    """
    out: dict[int, list[int]] = {}
    before = None
    for part in sorted(edges):
        own: list[int] = []
        if before is not None:
            path = renumbered(before, last[before], out[before])
            own = path[: common(edges[before][1], edges[part][0]) + 1]
        out[part] = own
        before = part
    return out


def renumbered(part: int, path: list[int], inherited: list[int]) -> list[int]:
    """A path of a range in all ranges' numbering: the range's number on top, nodes of earlier ranges as they are there."""
    same = 0
    while same < len(path) and same < len(inherited) and path[same] == same:
        same += 1
    return inherited[:same] + [(part << 33) + node for node in path[same:]]


def pairs_of(word: str, prefixes: list[int], suffixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(prefix node, suffix node, kind) of a word; ``suffixes[k]`` is the node of its last k code points.

    Kind 0: the whole word cut there; 1: with a code point skipped; 2: skipped after the same code
    point, which gives no new shorter word.
    """
    n = len(word)
    for i in range(max(0, n - len(suffixes) + 1), min(n, len(prefixes) - 1) + 1):
        yield prefixes[i], suffixes[n - i], 0
    for i in range(max(0, n - len(suffixes)), min(n - 1, len(prefixes) - 1) + 1):
        yield prefixes[i], suffixes[n - i - 1], 2 if i and word[i] == word[i - 1] else 1


def _near(p: np.ndarray, s: np.ndarray, w: np.ndarray, n: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word, near words, the best one, its n) from all members of some pairs: one row a word and pair that has any.

    A pair has one whole word and a skipped one for each code point of the alphabet at most.
    """
    order = np.lexsort((w, -n, s, p))
    p, s, w, n, kind = p[order], s[order], w[order], n[order], kind[order]
    first = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])])
    group = np.cumsum(first) - 1
    size = np.bincount(group)
    many = size[group] > 1
    out = []
    for target, source in (((1, 2), (1, 2)), ((1,), (0,)), ((0,), (1,))):  # who is near to whom
        to, of = many & np.isin(kind, target), np.flatnonzero(many & np.isin(kind, source))
        if not to.any() or not len(of):
            continue
        there = np.bincount(group[of], minlength=len(size))
        begin = np.cumsum(there) - there
        at = np.flatnonzero(to)
        own = len(source) == 2  # a word isn't near to itself
        count = there[group[at]] - own
        best = begin[group[at]]
        if own:
            best = best + (of[np.minimum(best, len(of) - 1)] == at)
        some = count > 0
        best = of[best[some]]
        out.append((w[at[some]], count[some], w[best], n[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.zeros(0, np.int64) for _ in range(4))


def _neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words with their numbers (``word``, ``n``, ``w``: ascending in code-point order), and ``w``, ``n_near``, ``best`` (n, then -number) of those with near words."""
    forward, before = _numbered(words, "word", "f", ["n"])
    turned = forward.withColumn("reversed", F.reverse("word"))
    both, behind = _numbered(turned, "reversed", "b", ["n", "f_part", "f_at", "f_path"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("reversed", "n", "f_part", "f_at", "f_path", "b_part", "b_path")}
            out: list[list[int]] = [[], [], [], [], []]
            for word, n, f_part, at, f_path, b_part, b_path in zip(*columns.values(), strict=True):
                if len(f_path) + len(b_path) - 2 < len(word) - 1:
                    continue  # no cut has both a shared prefix and a shared suffix
                for p, s, kind in pairs_of(word[::-1], renumbered(f_part, f_path, before.get(f_part, [])), renumbered(b_part, b_path, behind.get(b_part, []))):
                    for column, x in zip(out, (p, s, at, n, kind), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64()] * 4 + [pa.int8()], strict=True)], names=["p", "s", "w", "n", "kind"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [[c.to_numpy() for c in batch.columns] for batch in batches]
        if found:
            p, s, w, n, kind = (np.concatenate(c) for c in zip(*found, strict=True))
            del found
            near = _near(p, s, w, n, kind)
            for i in range(0, len(near[0]), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 50_000]) for c in near], names=["w", "near", "best", "best_n"])

    listed = mapped(both, pairs, "p long, s long, w long, n long, kind byte")
    shared = both.agg(F.sum(F.size("f_path") + F.size("b_path"))).first()[0] or 0
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, shared // TASK_PAIRS + 1)
    near = mapped(listed.repartition(tasks, "p", "s"), meet, "w long, near long, best long, best_n long")
    best = F.max(F.struct(F.col("best_n").alias("n"), (-F.col("best")).alias("w"))).alias("best")
    return forward.select("word", "n", F.col("f_at").alias("w")), near.groupBy("w").agg(F.sum("near").alias("n_near"), best)


def group_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of distinct ``words`` (``word``, ``n``).

    A word's form is its near word with the largest n (of equal ones the first in code-point
    order), if that is at least ``times`` (2 or more) its own; its root is where its forms lead. Words without near words have
    null ``form`` and are their own root. Null words go; an empty table gives an empty table; ``word`` has to be distinct.
    """
    words = written(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "words")
    numbered, near = _neighbours(words)
    known = numbered.join(near, "w", "left")
    formed = F.col("best.n") >= times * F.col("n")
    known = written(known.select("w", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, -F.col("best.w")).alias("form"), F.when(formed, F.col("best.n")).alias("form_n")), "near-words")
    leads = roots(known.where("form IS NOT NULL").select("w", F.col("form").alias("to")), words.agg(F.max("n")).first()[0] or 1, times)
    names = known.select(F.col("w").alias("named"), "word")
    roots_of = leads.join(names, F.col("to") == F.col("named")).select(F.col("w").alias("of"), F.col("word").alias("root"))
    forms = known.where("form IS NOT NULL").join(names.withColumnRenamed("word", "form_word"), F.col("form") == F.col("named")).select(F.col("w").alias("x"), "form_word")
    changed = forms.join(roots_of, F.col("x") == F.col("of")).drop("of")
    return known.join(changed, F.col("w") == F.col("x"), "left").select("word", F.col("form_word").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame, largest: int, times: int = 10) -> DataFrame:
    """``w`` and where its links (``w``, ``to``) end.

    Counts grow by ``times`` from link to link, so a chain has at most log(largest) of them, and the
    links, doubled in each round, are through it in the logarithm of that.
    """
    steps = 1
    while steps < math.log(max(largest, 2), max(times, 2)) + 1:
        ahead = links.select(F.col("w").alias("a"), F.col("to").alias("beyond"))
        links = written(links.join(ahead, F.col("to") == F.col("a"), "left").select("w", F.coalesce("beyond", "to").alias("to")), "roots")
        steps *= 2
    return links
