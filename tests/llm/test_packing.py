import itertools
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import packing
from tests.llm.tables import documents, empty


def exhaustive(positions, penalties, window):
    n = len(positions)
    best = {0: 0.0}
    for j in range(1, n):
        options = [best[i] + window - (positions[j] - positions[i]) + penalties[j] for i in range(j) if positions[j] - positions[i] <= window and i in best]
        if options:
            best[j] = min(options)
    return best[n - 1]


def cost(cuts, positions, penalties, window):
    charge = dict(zip(positions.tolist(), penalties.tolist(), strict=True))
    return sum(window - (b - a) + charge[b] for a, b in itertools.pairwise([0, *cuts]))


def test_cuts_are_optimal():
    draw = np.random.default_rng(0)
    for _ in range(200):
        gaps = draw.integers(1, 9, draw.integers(1, 40))
        positions = np.concatenate([[0], np.cumsum(gaps)])
        penalties = draw.choice([0.0, 2.0, 48.0], len(positions))
        cuts = packing.choose_cuts(positions, penalties, 12)
        assert cuts[-1] == positions[-1]
        assert max(b - a for a, b in itertools.pairwise([0, *cuts])) <= 12
        assert abs(cost(cuts, positions, penalties, 12) - exhaustive(positions, penalties, 12)) < 1e-9


def test_every_id_in_one_piece_and_full_windows(spark, tmp_path):
    docs = documents(spark, tmp_path)
    pieces = packing.pack(docs, window=128).collect()
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple([*slow.encode(r["text"] or "", add_special_tokens=False).ids, 0])) for r in docs.collect())
    got, current = [], []
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"]
        current = [*(current if p["start"] else []), *ids]
        if p["start"] + p["length"] == p["doc_tokens"]:
            got.append((p["doc_id"] is None, p["doc_id"] or 0, tuple(current)))
    assert sorted(got) == want
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(p["length"] for p in pieces)
    assert total / (128 * len(sequences)) > 0.93


def test_special_token_text_as_the_tokenizer_reads_it():
    encode, _ = packing.tokenizer("byte_bpe_50k")
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a<|endoftext|>b", "  x\n\n y", "Ünï 123 !!", "\u3000\u2003 wide", "a'll we'd", "x" * 3000, " " * 3000 + "z"):
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_ids_checksum_layout():
    assert zlib.crc32(np.array([1, 256], "<u4").tobytes()) == zlib.crc32(bytes([1, 0, 0, 0, 0, 1, 0, 0]))


def test_empty_table(spark, tmp_path):
    assert packing.pack(empty(spark, tmp_path)).collect() == []
