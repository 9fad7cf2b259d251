import collections
import random

import numpy as np
import pytest

from tessera.llm import induced, repeats
from tests.llm.tables import documents, empty


def check_order(text, depth, memory):
    space = induced.Space(memory)
    parts = [bytes(text)]
    padded = induced.as_text([p + b"\xff" for p in parts], len(text) + 1, depth, space)
    got = list(induced.suffixes(padded, depth, space))
    space.close()
    at, common = (np.concatenate([x[k] for x in got]) for k in (0, 1))
    raw = bytes(padded[: len(padded) - depth - 8])
    assert sorted(at.tolist()) == list(range(len(raw) - 1))
    for i in range(1, len(at)):
        x, y = raw[at[i - 1] :][:depth], raw[at[i] :][:depth]
        assert x >= y
        assert common[i] == next((k for k, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))


@pytest.mark.parametrize("memory", [600, 20_000, 1 << 26])
def test_induced_order_and_common_prefixes(memory):
    """With 600 bytes of memory the names recurse and queues, texts and orders are on disk."""
    draw = random.Random(memory)
    for _ in range(60):
        letters = draw.choice([b"a", b"ab", b"abcdefgh", bytes(range(0, 200, 7))])
        depth = draw.choice([1, 2, 5, 20])
        parts = [bytes(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(draw.randint(1, 6))]
        check_order(b"\xff".join(p + draw.choice(parts)[:30] + p[:9] for p in parts), depth, memory)


@pytest.mark.parametrize("triple", [0, induced.TRIPLE_NAMES])
def test_long_common_prefixes_are_compared_once(monkeypatch, triple):
    """Of suffixes whose neighbours move on with them only the last is compared to the end; order and prefixes stay exact."""
    compared = []
    plain = induced._common
    monkeypatch.setattr(induced, "TRIPLE_NAMES", triple)
    monkeypatch.setattr(induced, "_common", lambda text, a, b, depth: compared.append(len(a)) or plain(text, a, b, depth))
    draw = random.Random(5)
    letters = b"abcdefghijklmnopqrstuvwxyz     "
    parts = [bytes(draw.choice(letters) for _ in range(700)) for _ in range(3)]
    parts += [parts[0][20:600], parts[1][:350] + b"#" + parts[1][351:], parts[0], b"ab" * 90 + b"z" * 40 + bytes(range(97, 120)) * 5]
    text = b"\xff".join(parts)
    check_order(text, 400, 1 << 26)
    stars = sum(1 for i in range(1, len(text) - 1) if text[i - 1] > text[i] < text[i + 1])
    assert sum(compared) < 0.7 * stars


def test_a_block_is_searched_once_for_counting_and_finishing(monkeypatch):
    taken, calls = {}, []

    class Taken(Exception):
        pass

    def take(rows, keys_of, finish, *rest):
        taken.update(keys_of=keys_of, finish=finish)
        raise Taken

    plain = repeats.anchors
    monkeypatch.setattr(repeats, "count_and_finish", take)
    monkeypatch.setattr(repeats, "anchors", lambda *block: calls.append(len(block[0])) or plain(*block))
    with pytest.raises(Taken):
        repeats._candidates(None, 40, 2000)
    draw = random.Random(9)
    results = []
    for n in (300, 300):  # two blocks of one size: the second doesn't get the first one's anchors
        text = bytes(draw.choice(b"abcdef ") for _ in range(n)) * 2
        block = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        own, counts = np.unique(taken["keys_of"](*block)[0], return_counts=True)
        results.append(taken["finish"]([0], *block, [(own, counts)]))
        assert all(piece in text for piece in results[-1][2]) and results[-1][2]
    assert calls == [600, 600]
    again = taken["finish"]([0], *block, [(own, counts)])  # without a count before it
    assert again == results[1] and len(calls) == 3


def test_shard_larger_than_memory():
    """An in-memory sort takes over 40 bytes a byte of text; with 128 KB of memory, 250 KB of pieces stay far below that."""
    import tracemalloc

    draw = np.random.default_rng(2)
    words = [bytes(draw.integers(97, 123, 7).astype(np.uint8)) for _ in range(3000)]
    parts = [b" ".join(words[i] for i in draw.integers(0, 3000, 1000)) for _ in range(30)]
    parts += [parts[3][100:700], parts[9][500:1900], parts[9][1000:2000]]
    lengths, weights = np.array([len(p) for p in parts]), np.ones(len(parts), np.int64)
    tracemalloc.start()
    got = list(induced.repeated_starts((p + b"\xff" for p in parts), lengths, weights, 400, memory=128 << 10))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen = collections.Counter(p[k : k + 400] for p in parts for k in range(len(p) - 399))
    for p, hit in zip(parts, got, strict=True):
        assert hit.tolist() == [seen[p[k : k + 400]] > 1 for k in range(len(p) - 399)]
    assert peak < 10 * lengths.sum()


def test_names_are_sorted_on_disk_by_recursion():
    draw = random.Random(8)
    for _ in range(40):
        names = np.array([draw.randint(0, draw.choice([1, 3, 50])) for _ in range(draw.randint(1, 150))])
        got = induced.sorted_on_disk(names, 200, induced.Space(300)).tolist()
        assert got == sorted(range(len(names)), key=lambda i: names[i:].tolist())


def brute(rows, depth):
    seen = collections.Counter(t[k : k + depth] for _, t in rows for k in range(len(t) - depth + 1))
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - depth + 1):
            if seen[t[k : k + depth]] > 1:
                gone[k : k + depth] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((str(i), len(t), list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)), bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out)


@pytest.mark.parametrize(("depth", "shard", "common"), [(400, 1 << 20, 2000), (400, 500, 1), (90, 2000, 3), (30, 1 << 20, 2000), (30, 1 << 20, 1)])
def test_against_brute_force(spark, tmp_path, depth, shard, common):
    docs = documents(spark, tmp_path)
    got = sorted((str(r["key" if "key" in r else "doc_id"]), r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in repeats.remove_repeats(docs, depth=depth, shard_bytes=shard, common=common).collect())
    assert got == brute([(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()], depth)


def test_long_documents_in_segments(monkeypatch):
    draw = random.Random(4)
    text = bytes(draw.choice(b"abcdefghij ") for _ in range(30000))
    data = np.frombuffer(text + text[200:9000], np.uint8)
    monkeypatch.setattr(repeats, "SEGMENT_BITS", 12)
    repeats._powers.clear()
    first, last, _ = repeats.anchors(data, np.array([0, len(data)]), 400)
    repeats._powers.clear()
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
    assert sorted(starts.tolist()) == list(range(len(data) - 399))


def test_depth_beyond_a_segment(monkeypatch):
    draw = random.Random(7)
    text = bytes(draw.choice(b"abcdefghij ") for _ in range(9000))
    monkeypatch.setattr(repeats, "SEGMENT_BITS", 9)
    repeats._powers.clear()
    first, last, _ = repeats.anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 700)
    repeats._powers.clear()
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
    assert sorted(starts.tolist()) == list(range(len(text) - 699))


def test_reads_in_different_splits_agree(spark, tmp_path):
    """The pieces are written when the query is built; its text is read again when it runs, here in other splits."""
    docs = documents(spark, tmp_path)
    want = brute([(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()], 90)
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    cut = repeats.remove_repeats(spark.read.parquet(str(tmp_path / "documents")), depth=90)
    try:
        for n in names:
            spark.conf.set(n, "2000")
        got = sorted((str(r["doc_id"]), r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in cut.collect())
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert got == want


def test_common_anchor_and_string_keys(spark):
    """A passage in every text, long copies within one text, and keys that are no numbers."""
    draw = random.Random(6)
    passage = "".join(draw.choice("abcdef ") for _ in range(130))
    rows = [(f"k{i}", "".join(draw.choice("ghijkl ") for _ in range(200)) + passage + "".join(draw.choice("mnopq ") for _ in range(150))) for i in range(60)]
    rows.append(("long", rows[0][1] * 40))
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    for common in (2, 2000):
        got = sorted((r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in repeats.remove_repeats(docs, depth=100, common=common, shard_bytes=900, memory=4000).collect())
        assert got == brute([(i, t.encode()) for i, t in rows], 100)


def test_empty_table(spark, tmp_path):
    assert repeats.remove_repeats(empty(spark, tmp_path)).collect() == []
