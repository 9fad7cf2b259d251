import collections
import random
import re

import pytest

from tessera.llm import components, jaccard
from tests.llm.tables import documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            root = find(i)
            least[root] = min(k, least.get(root, k))
    return sorted((str(k), len(sets[i]), str(least.get(find(i)))) for i, (k, _) in enumerate(rows))


def found(docs):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard.near_copies(docs).collect())


def test_awkward_rows_against_brute_force(spark, tmp_path):
    docs = documents(spark, tmp_path)
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_and_groups_of_near_copies(spark, tmp_path, seed):
    draw = random.Random(seed)
    rows = []
    for family in range(12):
        words = [f"w{draw.randint(0, 400)}" for _ in range(draw.choice([12, 40, 90]))]
        for _ in range(draw.randint(1, 25)):
            rows.append(" ".join(words))
            if draw.random() < 0.7:
                words = list(words) if draw.random() < 0.5 else words
                words[draw.randrange(len(words))] = f"v{draw.randint(0, 30)}"
            if draw.random() < 0.3:
                words = words[draw.randint(0, 2) :] + ["tail"] * draw.randint(0, 2)
    draw.shuffle(rows)
    table = [(100 + i, t, "en", "s") for i, t in enumerate(rows)]
    docs = documents(spark, tmp_path, table)
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_members_link_where_their_heads_fail_the_bitmap_bound(spark, tmp_path):
    rows = []
    for family in range(30):
        words = [f"f{family}w{i}" for i in range(104)]

        def edited(*places):
            return " ".join(f"{w}x{len(rows)}" if i in places else w for i, w in enumerate(words))  # noqa: B023

        # two sets of one prefix; the third links only with the second, and the head is either
        for places in ((15,), (35,), (35, 55)):
            rows.append(edited(*places))
        rows += [" ".join(words[:n]) for n in (80, 79, 78, 77)]  # the edited places are common, the rare rest is whole
    table = [(i, t, "en", "s") for i, t in enumerate(rows)]
    docs = documents(spark, tmp_path, table)
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_one_of_each_keeps_columns(spark, tmp_path):
    docs = documents(spark, tmp_path)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == {r["component_id"] for r in jaccard.near_copies(docs).collect() if r["component_id"] is not None}


def test_one_row_of_each_component_whatever_its_keys(spark, tmp_path):
    def near(tag, end):
        return " ".join(f"{tag}{i}" for i in range(60)) + f" end{end}"

    keys = {"a": (5, None), "b": (None, None), "c": (7, 7), "d": (3, 7), "e": (None, 7, 7, 9)}
    table = [(k, near(tag, i), tag, "s") for tag, own in keys.items() for i, k in enumerate(own)]
    docs = documents(spark, tmp_path, [*table, (None, "", "none", "s"), (None, None, "none", "s"), (7, " ", "none", "s")])
    kept = sorted((r["lang"], str(r["doc_id"])) for r in jaccard.one_of_each(docs).collect())
    assert kept == [("a", "5"), ("b", "None"), ("c", "7"), ("d", "3"), ("e", "7"), ("none", "7"), ("none", "None"), ("none", "None")]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    roots = collections.defaultdict(set)
    for r in components.components(edges).collect():
        roots[r["root"]].add(r["node"])
    assert roots == {0: set(range(61)), 100: {100, 101}}


def test_empty_table(spark, tmp_path):
    assert jaccard.near_copies(empty(spark, tmp_path)).collect() == []
