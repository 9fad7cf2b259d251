import collections
import random
import re
import zlib

import pytest

from tessera.llm import queries, variants
from tests.llm.tables import documents, empty


def counted(rows, shortest=7, at_least=2, every=31):
    n = collections.Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= shortest:
                n[word] += 1
    return {w: c for w, c in n.items() if c >= at_least}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(n, times=10):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and is_near(v, w)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize(("alphabet", "ranges"), [("ab", 3), ("ab", 10**6), ("aàé÷", 7), ("abcdefgh", 4)])
def test_groups_against_brute_force(spark, monkeypatch, alphabet, ranges):
    monkeypatch.setattr(variants, "RANGE_WORDS", ranges)
    monkeypatch.setattr(variants, "TASK_PAIRS", 50)
    draw = random.Random(len(alphabet) + ranges)
    words = {"".join(draw.choice(alphabet) for _ in range(draw.randint(1, 7))) for _ in range(250)} | {"a" * k for k in range(1, 40, 3)} | {"a" * 3000, "a" * 3001, "a" * 1500 + "b" + "a" * 1500, "￿", "\U0001f600", "\U0001f600￿"}
    n = {w: draw.choice([2, 2, 3, 20, 25, 250, 3000]) for w in sorted(words)}
    table = spark.createDataFrame([(w, c, "x", 1) for w, c in n.items()] + [(None, 5, "x", 1)], "word string, n int, form string, w int")
    assert rows_of(variants.group_variants(table)) == grouped(n)


def test_chains_lead_to_their_root(spark):
    n = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "aabbbbb": 200000, "abbbbbb": 2000000}
    got = rows_of(variants.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == grouped(n) and {r[2] for r in got} == {"abbbbbb"}


@pytest.mark.parametrize("every", [31, 2, 1, 0])
def test_words_against_brute_force(spark, tmp_path, monkeypatch, every):
    monkeypatch.setattr(variants, "HELD", 50)
    draw = random.Random(every)
    word = lambda: "".join(draw.choice("abcXYZàÀ×ß") for _ in range(draw.randint(5, 12)))
    pool = [word() for _ in range(60)] + ["b" * 47, "b" * 48, "b" * 49, "é" * 24, "é" * 25, "c" * 4000]
    texts = [draw.choice([" ", ".", "ā", "1", "Ɓ"]).join(draw.choice(pool) for _ in range(draw.randint(0, 60))) for _ in range(80)]
    docs = documents(spark, tmp_path, [(i if i % 9 else None, t if i % 11 else None, "en", "s") for i, t in enumerate(texts)] + [(3, "", "en", "s"), (3, texts[3], "en", "s"), (3, texts[3], "en", "s")])
    got = {r["word"]: r["n"] for r in variants.count_words(docs, every=every).collect()}
    assert got == counted(docs.collect(), every=every)


def test_query_against_brute_force(spark, tmp_path):
    docs = documents(spark, tmp_path)
    (tmp_path / "documents").rename(tmp_path / "documents.parquet")
    rows = spark.read.parquet(str(tmp_path / "documents.parquet")).collect()
    assert rows_of(queries.op12_spelling_variants(spark, str(tmp_path))) == grouped(counted(rows))
    assert docs.columns


def test_empty_table(spark, tmp_path):
    assert variants.group_variants(variants.count_words(empty(spark, tmp_path))).collect() == []
