"""External induced sorting of the suffixes of a text, with common-prefix values.

The suffixes that start a rising stretch (S* suffixes) are ranked first: their
substrings are sorted and named, and the suffixes of the text of names are ranked in
turn, by the same steps (recursion) until the names fit in memory. All others are
induced: a suffix's place follows from that of the suffix one symbol on. Tuples
(position, common prefix) wait in priority queues that are keyed by first symbol and
arrival and move to disk when they outgrow their memory; common prefixes are carried
through them, since that of two induced suffixes is one more than the smallest between
their inducers. The text, the types and the orders are arrays that live on disk beyond
the memory allowed, so a text may be far larger than memory. Order and common prefixes
are exact up to ``depth`` bytes.
"""

from __future__ import annotations

import heapq
import itertools
import marshal
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

#: Values of the text's end and of separators; UTF-8 never uses the bytes that map to them.
END, SEPARATOR = 0, 1
#: Bytes that sorting one shard may hold in memory; beyond, its arrays and queues go to disk.
MEMORY = 256 << 20
#: Bytes of memory that go with a tuple in a queue, with a name sorted in memory, and with a place taken at a time.
TUPLE_BYTES, NAME_BYTES, STEP_BYTES = 64, 256, 256
#: Names of which three ranks fit in a sort key of 63 bits.
TRIPLE_NAMES = (1 << 21) - 1


class Space:
    """Arrays in memory up to a budget; beyond it they are files of the task, gone when it ends."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.left, self.folder = memory, memory // 2, None
        self.tuples = max(2, memory // (8 * TUPLE_BYTES))
        self.names = max(2, memory // NAME_BYTES)
        self.step = max(16, memory // STEP_BYTES)

    def array(self, n: int, kind: type) -> np.ndarray:
        size = n * np.dtype(kind).itemsize
        if size <= self.left:
            self.left -= size
            return np.zeros(n, kind)
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="induced-", dir=os.environ.get("TMPDIR"))
        handle, path = tempfile.mkstemp(dir=self.folder.name)
        os.close(handle)
        return np.memmap(path, kind, "w+", shape=(n,))

    def steps(self, n: int) -> Iterator[tuple[int, int]]:
        return ((a, min(n, a + self.step)) for a in range(0, n, self.step))

    def close(self) -> None:
        if self.folder is not None:
            self.folder.cleanup()


class TupleQueue:
    """Priority queue of tuples; when it outgrows ``limit``, its larger half becomes a sorted run on disk.

    Sixteen runs of a level are merged into one of the next, so few files are open however long the queue is.
    """

    FAN, CHUNK = 16, 100

    def __init__(self, limit: int):
        self.limit, self.heap, self.spilled = limit, [], 0
        self.runs: list[tuple] = []  # (least tuple, number, level, rest of the run)

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self.heap.sort()
            moved, self.heap = self.heap[self.limit // 2 :], self.heap[: self.limit // 2]
            level, run = 0, iter(moved)
            while True:
                self._forward(self._on_disk(run), level)
                full = [r for r in self.runs if r[2] == level]
                if len(full) < self.FAN:
                    break
                self.runs = [r for r in self.runs if r[2] != level]
                heapq.heapify(self.runs)
                level, run = level + 1, heapq.merge(*(itertools.chain([least], rest) for least, _, _, rest in full))

    def _on_disk(self, run: Iterator[tuple]) -> Iterator[tuple]:
        file = tempfile.TemporaryFile(prefix="induced-", dir=os.environ.get("TMPDIR"))
        while part := list(itertools.islice(run, self.CHUNK)):
            marshal.dump(part, file)
        file.seek(0)
        return self._read(file)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    part = marshal.load(file)
                except EOFError:
                    return
                yield from part

    def _forward(self, run: Iterator[tuple], level: int) -> None:
        for least in run:
            self.spilled += 1
            heapq.heappush(self.runs, (least, self.spilled, level, run))
            return

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)

    def least(self) -> tuple:
        if not self.runs or self.heap and self.heap[0] < self.runs[0][0]:
            return self.heap[0]
        return self.runs[0][0]

    def pop(self) -> tuple:
        if not self.runs or self.heap and self.heap[0] < self.runs[0][0]:
            return heapq.heappop(self.heap)
        least, _, level, run = heapq.heappop(self.runs)
        self._forward(run, level)
        return least

    def drained(self) -> Iterator[tuple]:
        while self:
            yield self.pop()


class MonotoneQueue:
    """First-in-first-out queues of (position, common prefix) under one byte each; popped byte by byte, in one direction.

    Since the scan that fills it goes through the suffixes in order, arrival under a byte is
    suffix order: taking the next byte's queue is taking the least tuples.
    """

    def __init__(self, limit: int):
        self.limit, self.held, self.file, self.size = limit, 0, None, 0
        self.parts: list[list] = [[] for _ in range(256)]

    def push(self, byte: int, positions: np.ndarray, common: np.ndarray) -> None:
        self.parts[byte].append((positions, common))
        self.held += len(positions)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="induced-", dir=os.environ.get("TMPDIR"))
        self.file.seek(self.size)
        for queue in self.parts:
            for i, part in enumerate(queue):
                if part is not None and not isinstance(part[0], int):
                    positions, common = part
                    self.file.write(positions.tobytes())
                    self.file.write(common.tobytes())
                    queue[i] = (self.size, len(positions))
                    self.size += positions.nbytes + common.nbytes
        self.held = 0

    def _load(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if not isinstance(part[0], int):
            self.held -= len(part[0])
            return part
        at, n = part
        self.file.seek(at)
        raw = self.file.read(n * 10)
        return np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.uint16, n, 8 * n)

    def pop(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The tuples under a byte in order of arrival, those that arrive meanwhile included."""
        queue, i = self.parts[byte], 0
        while i < len(queue):
            found, size = [], 0
            while i < len(queue) and (not found or size < self.limit):
                found.append(self._load(queue[i]))
                size += len(found[-1][0])
                queue[i] = None
                i += 1
            yield np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
        queue.clear()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _types(text: np.ndarray, space: Space) -> np.ndarray:
    """Whether each suffix is S (smaller than the next one); the last is not."""
    n = len(text)
    s = space.array(n, np.bool_)
    after = False
    for a, b in reversed(list(space.steps(n - 1))):
        here, then = text[a:b], text[a + 1 : b + 1]
        at = np.where(here != then, np.arange(b - a), b - a)  # an equal neighbour has the type of the next that differs
        at = np.minimum.accumulate(at[::-1])[::-1]
        s[a:b] = np.where(at < b - a, (here < then)[np.minimum(at, b - a - 1)], after)
        after = bool(s[a])
    return s


def _stars(s: np.ndarray, space: Space) -> np.ndarray:
    """The S suffixes that follow an L suffix, in their order of place."""
    last = len(s) - 1
    out, at = space.array(sum(int((s[a + 1 : b + 1] & ~s[a:b]).sum()) for a, b in space.steps(last)), np.int64), 0
    for a, b in space.steps(last):
        found = np.flatnonzero(s[a + 1 : b + 1] & ~s[a:b]) + (a + 1)
        out[at : at + len(found)] = found
        at += len(found)
    return out


def _run_length(text: np.ndarray, at: int, most: int) -> int:
    """Length, up to ``most``, of the run of one byte from a place on."""
    part = np.asarray(text[at : at + most])
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def _range_min(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of values[a..b] for many a <= b, from the minima of all runs of 1, 2, 4, ... values up to the longest asked for."""
    n = len(values)
    k = np.frexp((b - a + 1).astype(np.float64))[1].astype(np.int64) - 1
    levels = np.empty((int(k.max()) + 1, n), values.dtype)
    levels[0] = values
    for i in range(1, len(levels)):
        half = 1 << (i - 1)
        np.minimum(levels[i - 1, :-half], levels[i - 1, half:], out=levels[i, :-half])
    flat, row = levels.ravel(), k * n
    return np.minimum(flat[row + a], flat[row + b + 1 - (np.int64(1) << k)])


class _Induction:
    """Sends suffixes on to the queue of the byte before them and carries the common prefixes."""

    def __init__(self, text: np.ndarray, s: np.ndarray, wanted: bool, queue: MonotoneQueue, depth: int):
        self.text, self.s, self.wanted, self.queue, self.depth = text, s, wanted, queue, depth
        self.low = np.full(256, 0, np.uint16)  # smallest common prefix since the last tuple sent to each byte
        self.fresh = np.ones(256, bool)

    def feed(self, positions: np.ndarray, common: np.ndarray) -> None:
        """Take suffixes in the scan's order, each with the common prefix with the one before."""
        n = len(positions)
        if not n:
            return
        before = positions - 1
        ok = before >= 0
        ok[ok] = self.s[before[ok]] == self.wanted
        at = np.flatnonzero(ok)
        whole = common.min()
        if len(at):
            sent = before[at]
            byte = self.text[sent]
            order = np.argsort(byte, kind="stable")
            at, sent, byte = at[order], sent[order], byte[order]
            first = np.concatenate([[True], byte[1:] != byte[:-1]])
            heads = np.flatnonzero(first)
            smallest = np.empty(len(at), np.uint16)
            if len(at) > len(heads):
                rest = np.flatnonzero(~first)
                smallest[rest] = _range_min(common, at[rest - 1] + 1, at[rest])
            upto = np.minimum.accumulate(common)
            names = byte[heads]
            smallest[heads] = np.minimum(np.where(self.fresh[names], 0, self.low[names]), upto[at[heads]])
            carried = np.minimum(smallest + np.uint16(1), np.uint16(self.depth))
            carried[heads[self.fresh[names]]] = 0
            tails = np.append(heads[1:], len(at)) - 1
            after = np.minimum.accumulate(common[::-1])[::-1]
            end = np.where(at[tails] + 1 < n, after[np.minimum(at[tails] + 1, n - 1)], np.uint16(65535))
            self.low = np.minimum(self.low, whole)
            self.low[names] = end
            self.fresh[names] = False
            for b, x, y in zip(names.tolist(), heads.tolist(), (tails + 1).tolist(), strict=True):
                self.queue.push(b, sent[x:y], carried[x:y])
        else:
            self.low = np.minimum(self.low, whole)


def _names(text: np.ndarray, s: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Rank of each S* substring (bytes and types up to the next S* byte), equal ones alike."""
    m = len(stars)
    stop = np.append(stars[1:], len(text) - 1)
    length = stop - stars + 1
    rank = np.zeros(m, np.int64)
    symbols = np.append((text.astype(np.uint16) << 1 | s) + 1, np.uint16(0))
    open_ = np.arange(m)
    step = 0
    while len(open_):
        word = np.zeros(len(open_), np.int64)
        begin, left = stars[open_] + 6 * step, length[open_] - 6 * step
        for k in range(6):
            word = word << 10 | np.where(k < left, symbols[np.minimum(begin + k, len(text))], 0)
        order = np.lexsort((word, rank[open_])) if step else np.argsort(word)
        members, word = open_[order], word[order]
        group = rank[members]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new = new_group | np.concatenate([[True], word[1:] != word[:-1]])
        starts = np.flatnonzero(new)
        base = np.flatnonzero(new_group)
        within = np.arange(len(members)) - base[np.cumsum(new_group) - 1]
        rank[members] = group + within[starts][np.cumsum(new) - 1]
        step += 1
        size = np.diff(np.append(starts, len(members)))
        longer = np.maximum.reduceat(length[members], starts) > 6 * step
        keep = np.repeat((size > 1) & longer, size)
        open_ = members[keep]
    return rank


def _sorted_names(rank: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of the text of names, by tripling (doubling from ``TRIPLE_NAMES`` on) over the groups still open; exact to ``depth`` names.

    ``rank``: for each name the number of smaller ones. Suffixes that are equal to ``depth`` come in their order of place.
    """
    m = len(rank)
    if m < 2:
        return np.arange(m)
    rank, order = rank.copy(), np.argsort(rank)
    reach = 3 if m < TRIPLE_NAMES else 2
    at, ordered, h = np.arange(m), rank[order], 1  # places of the order that are open, and what they are ordered by
    while True:
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(ordered)))
        group = np.repeat(at[starts], size)
        rank[order[at]] = group
        many = np.repeat(size > 1, size)
        at, group = at[many], group[many]
        members = order[at]
        if not len(at) or h >= depth:
            break
        key = group
        for step in range(h, reach * h, h):
            following = members + step
            key = key * np.int64(m + 1) + np.where(following < m, rank[np.minimum(following, m - 1)] + 1, 0)
        inner = np.argsort(key)
        order[at], ordered = members[inner], key[inner]
        h *= reach
    order[at] = members[np.argsort(group * np.int64(m + 1) + members)]
    return order


def _ranked_on_disk(text: np.ndarray, s: np.ndarray, stars: np.ndarray, depth: int, space: Space) -> np.ndarray:
    """Name of each S* substring (symbols and types up to the next one's first), by a sort on disk; exact to ``depth`` symbols."""
    queue, names = TupleQueue(space.tuples), space.array(len(stars), np.int64)
    for i in range(len(stars)):
        a = int(stars[i])
        b = min(int(stars[i + 1]) + 1 if i + 1 < len(stars) else len(text), a + depth + 2)
        queue.push(((np.asarray(text[a:b], np.int64) * 2 + s[a:b] + 1).astype(">i8").tobytes(), i))
    name, last = -1, None
    for key, i in queue.drained():
        if key != last:
            name, last = name + 1, key
        names[i] = name
    return names


def sorted_on_disk(text: np.ndarray, depth: int, space: Space) -> np.ndarray:
    """Order of the suffixes of a text of numbers, exact to ``depth`` of them: induced from its S* suffixes, which are sorted by recursion.

    A suffix that is the beginning of another comes first.
    """
    n = len(text)
    if n <= space.names:
        return _sorted_names(np.searchsorted(np.sort(text), text), depth)
    s = _types(text, space)
    stars = _stars(s, space)
    order = sorted_on_disk(_ranked_on_disk(text, s, stars, depth, space), depth // 2 + 2, space)
    falling, out = space.array(n, np.int64), space.array(n, np.int64)

    def send(at: int, wanted: bool, sign: int) -> None:
        nonlocal arrival
        if at and s[at - 1] == wanted:
            queue.push((sign * int(text[at - 1]), arrival, at - 1))
            arrival += 1

    queue, arrival, count, seed = TupleQueue(space.tuples), 0, 0, 0
    send(n, False, 1)  # the empty suffix is the least
    while queue or seed < len(order):
        at = int(stars[order[seed]]) if seed < len(order) else n
        if queue and (at == n or queue.least()[0] <= text[at]):
            at = queue.pop()[2]
            falling[count] = at
            count += 1
        else:
            seed += 1
        send(at, False, 1)
    queue, arrival, place, left = TupleQueue(space.tuples), 0, n, count
    while queue or left:
        at = int(falling[left - 1]) if left else n
        if queue and (not left or -queue.least()[0] >= text[at]):
            at = queue.pop()[2]
        else:
            left -= 1
        place -= 1
        out[place] = at
        send(at, True, -1)
    return out


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of the suffixes at a and b, up to depth; the text has depth + 8 bytes after its end."""
    words = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(0, depth, 8):
        x = words[a[live] + k] ^ words[b[live] + k]
        differs = x != 0
        out[live] += 8
        if differs.any():
            low = x[differs] & (~x[differs] + np.uint64(1))
            out[live[differs]] += (np.log2(low.astype(np.float64)).astype(np.int64) >> 3) - 8
            live = live[~differs]
        if not len(live):
            break
    return np.minimum(out, depth).astype(np.uint16)


def _common_in_order(padded: np.ndarray, stars: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, up to depth, of each suffix in ``order`` with the one before it.

    Where the neighbours of two successive stars are as far apart as the stars and the bytes between
    agree, both end at the same byte, so only the last star of such a stretch is compared to the end.
    """
    m = len(stars)
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    other = np.empty(m, np.int64)
    other[order[1:]], other[order[0]] = stars[order[:-1]], -1
    gap = np.diff(stars)
    held = np.append((np.diff(other) == gap) & (gap <= 8) & (other[:-1] >= 0) & (other[1:] >= 0), False)
    at = np.flatnonzero(held)
    differs = (words[stars[at]] ^ words[other[at]]) << (64 - 8 * gap[at]).astype(np.uint64)
    held[at[differs != 0]] = False
    ends = np.flatnonzero(~held & (other >= 0))
    upto = np.zeros(m, np.int64)
    upto[ends] = stars[ends] + _common(padded, stars[ends], other[ends], depth)
    last = np.minimum.accumulate(np.where(held, m - 1, np.arange(m))[::-1])[::-1]
    return np.minimum(upto[last] - stars, depth).clip(0).astype(np.uint16)[order]


def suffixes(text: np.ndarray, depth: int, space: Space) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (positions, common prefix with the suffix before, up to depth), from the largest suffix to the smallest.

    ``text`` ends with ``END`` and depth + 8 zero bytes after it. In this direction the
    common prefix of a suffix is with the one given before it, which is larger.
    """
    padded, text = text, text[: len(text) - depth - 8]
    s = _types(text, space)
    inner = _stars(s, space)
    stars = space.array(len(inner) + 1, np.int64)
    stars[:-1], stars[-1] = inner, len(text) - 1  # the end is the least S* suffix
    if len(stars) <= space.names:
        order = _sorted_names(_names(text, s, np.asarray(stars)), depth // 2 + 2)
        near = _common_in_order(padded, np.asarray(stars), order, depth)
    else:
        order, near = sorted_on_disk(_ranked_on_disk(text, s, stars, depth, space), depth // 2 + 2, space), None
    seeds, firsts = space.array(len(stars), np.int64), np.zeros(256, np.int64)
    for a, b in space.steps(len(stars)):
        seeds[a:b] = stars[order[a:b]]
        firsts += np.bincount(text[seeds[a:b]], minlength=256)
    edges = np.concatenate([[0], np.cumsum(firsts)])
    rising, falling = MonotoneQueue(space.tuples), MonotoneQueue(space.tuples)
    kept = MonotoneQueue(space.tuples)  # L suffixes of each byte, for the second scan

    def at_edge(last: int, at: int) -> int:
        return min(_run_length(text, last, depth), _run_length(text, at, depth))

    try:
        first = _Induction(text, s, False, rising, depth)
        for byte in range(256):
            last = None
            for positions, common in rising.pop(byte):
                kept.push(byte, positions, common)
                first.feed(positions, common)
                last = int(positions[-1])
            for a, b in space.steps(int(firsts[byte])):
                a, b = a + int(edges[byte]), b + int(edges[byte])
                own = np.asarray(seeds[a:b])
                common = np.zeros(b - a, np.uint16)
                common[1:] = _common(padded, own[:-1], own[1:], depth) if near is None else near[a + 1 : b]
                if a > edges[byte]:
                    common[:1] = _common(padded, np.asarray(seeds[a - 1 : a]), own[:1], depth)
                elif last is not None:
                    common[0] = at_edge(last, int(own[0]))
                first.feed(own, common)
        second = _Induction(text, s, True, falling, depth)
        for byte in range(255, -1, -1):
            last = None
            for positions, common in falling.pop(byte):
                second.feed(positions, common)
                yield positions, common
                last = int(positions[-1])
            batches = list(kept.parts[byte])
            above = np.uint16(0)  # common prefix of the batch's largest with the one given before it
            for part in reversed(batches):
                positions, common = kept._load(part)
                back = positions[::-1]
                shifted = np.concatenate([[above], common[:0:-1]]).astype(np.uint16)
                if last is not None and part is batches[-1]:
                    shifted[0] = at_edge(last, int(back[0]))
                second.feed(back, shifted)
                yield back, shifted
                above = common[0]
            kept.parts[byte] = []
    finally:
        for queue in (rising, falling, kept):
            queue.close()


def as_text(raw: Iterable[bytes], size: int, depth: int, space: Space) -> np.ndarray:
    """The text of ``size`` bytes, each part of it followed by 255, as ``suffixes`` takes it."""
    text, at = space.array(size + 1 + depth + 8, np.uint8), 0
    for part in raw:
        text[at : at + len(part)] = np.frombuffer(part, np.uint8) + np.uint8(2)
        at += len(part)
    return text  # its end is the first of the zeros


def repeated_starts(raw: Iterable[bytes], lengths: np.ndarray, weights: np.ndarray, depth: int, memory: int = MEMORY) -> Iterator[np.ndarray]:
    """For each part, which starts of ``depth`` bytes begin a string that occurs at another start, too.

    ``raw``: the parts, each followed by the byte 255, in pieces of any size.
    ``weights``: how many places of the corpus a part stands for (2 and more count alike);
    a part has length - depth + 1 starts.
    """
    space = Space(memory)
    try:
        first = np.cumsum(lengths + 1) - lengths - 1
        size = int(lengths.sum()) + len(lengths)
        weight, hit = space.array(size + 1, np.uint8), space.array(size + 1, np.bool_)
        for a, n, w in zip(first.tolist(), lengths.tolist(), weights.tolist(), strict=True):
            weight[a : a + max(0, n - depth + 1)] = min(w, 2)
        text = as_text(raw, size, depth, space)
        pending: list[np.ndarray] = []
        held = 0
        for positions, common in suffixes(text, depth, space):
            cuts = np.flatnonzero(common < depth)
            begins = np.concatenate([[0], cuts]) if not len(cuts) or cuts[0] else cuts
            w = weight[positions].astype(np.int64)
            sums = np.add.reduceat(w, begins)
            stops = np.append(begins[1:], len(positions))
            joined = len(begins) > 0 and common[0] >= depth
            if joined:
                sums[0] += held
            many = sums >= 2
            marked = np.repeat(many, stops - begins)
            hit[positions[marked & (w > 0)]] = True
            if joined and many[0]:
                for x in pending:
                    hit[x] = True
                pending = []
            tail = positions[begins[-1] : stops[-1]]
            if len(begins) > 1 or not joined:
                pending = []
            pending = [] if many[-1] else [*pending, tail[weight[tail] > 0]]
            held = int(min(sums[-1], 2))
        for a, n in zip(first.tolist(), lengths.tolist(), strict=True):
            yield np.asarray(hit[a : a + max(0, n - depth + 1)])
    finally:
        space.close()
