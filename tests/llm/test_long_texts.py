"""One text that is longer than the operators' blocks, chunks and batches, beside short ones."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import counting, exact_dedup, hashing, jaccard, lm_scoring, packing, quality, variants
from tests.llm.test_lm_scoring import brute


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    draw = random.Random(8)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) + draw.choice(["", "", "."]) for _ in range(4000)]
    long = " ".join(draw.choices(vocabulary, k=1_500_000))
    near = long.replace(vocabulary[7] + " ", "changed ", 1)
    rows = [(1, long), (2, "short text."), (3, near), (4, long), (5, ""), (6, " ".join(draw.choices(vocabulary, k=50)))]
    path = str(tmp_path_factory.mktemp("long") / "documents")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(path)
    assert len(long) > counting.BLOCK_BYTES > hashing.CHUNK
    return spark.read.parquet(path)


def test_scores_of_the_language_model(docs):
    rows = docs.collect()
    got = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in lm_scoring.score_documents(docs).collect()}
    for doc_id, n, score in brute(rows, 3, 2):
        assert got[doc_id][0] == n and got[doc_id][1] == pytest.approx(score, rel=1e-9)


def test_near_copies_and_exact_copies(docs):
    near = {r["doc_id"]: r["component_id"] for r in jaccard.near_copies(docs).collect()}
    assert near[1] == near[3] == near[4] == 1 and near[2] == 2 and near[6] == 6
    exact = {r["doc_id"]: r for r in exact_dedup.dedup(docs).collect()}
    assert [exact[k]["keep_id"] for k in range(1, 7)] == [4, 2, 3, 4, 5, 6]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(exact[k]["text_sha256"] == hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items())


def test_packing_of_more_tokens_than_a_block(docs):
    pieces = packing.pack(docs.where("doc_id <= 2")).select("doc_id", "start", "length", "doc_tokens", "sequence_id").collect()
    by = collections.defaultdict(list)
    for p in pieces:
        by[p["doc_id"]].append((p["start"], p["length"], p["doc_tokens"]))
    assert sum(n for _, n, _ in by[1]) == by[1][0][2] > packing.BLOCK_TOKENS
    for own in by.values():
        at = 0
        for start, n, _ in sorted(own):
            assert start == at
            at += n
    full = collections.Counter()
    for p in pieces:
        full[p["sequence_id"]] += p["length"]
    assert max(full.values()) <= 1024 and np.mean(list(full.values())) > 1000


def test_runs_of_a_million_characters_have_the_slow_tokenizers_ids():
    """The rank encoder gives up on some; the other one takes over."""
    encode, _ = packing.tokenizer("byte_bpe_50k")
    text = "a" * 1_200_000 + " end."
    assert pa.array(encode(text)).to_pylist() == packing._slow("byte_bpe_50k").encode(text, add_special_tokens=False).ids


def test_quality_scores_and_words(spark, docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 7)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(scored) == 6 and all(0 <= r["score"] <= 1 for r in scored)
    got = {r["word"]: r["n"] for r in variants.count_words(docs, every=0).collect()}
    want = collections.Counter(w for r in docs.collect() for w in r["text"].replace(".", "").split() if len(w) >= 7)
    assert got == {w: n for w, n in want.items() if n >= 2}
