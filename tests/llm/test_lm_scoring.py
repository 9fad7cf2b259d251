import collections
import math
import re

import pytest

from tessera.llm import lm_scoring
from tests.llm.tables import documents, empty


def brute(rows, order, cutoff):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") for r in rows]
    count = collections.Counter(tuple(w[i : i + n]) for w in docs for n in range(order + 1) for i in range(len(w) - n + (n > 0)))
    total = sum(map(len, docs))

    def score(gram):
        if len(gram) == 1:
            return math.log(count[gram] / total)
        return math.log(count[gram] / count[gram[:-1]]) if count[gram] >= cutoff else math.log(0.4) + score(gram[1:])

    return [(r["doc_id"], len(w), sum(score(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w)))) for r, w in zip(rows, docs, strict=True)]


@pytest.mark.parametrize(("order", "cutoff"), [(1, 2), (2, 2), (3, 2), (4, 3)])
def test_against_brute_force(spark, tmp_path, order, cutoff):
    docs = documents(spark, tmp_path)
    got = sorted((str(r["doc_id"]), r["n_words"], round(r["log_score"], 5)) for r in lm_scoring.score_documents(docs, order=order, cutoff=cutoff).collect())
    want = sorted((str(i), n, round(s, 5)) for i, n, s in brute(docs.collect(), order, cutoff))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1e-4)


def test_empty_table(spark, tmp_path):
    assert lm_scoring.score_documents(empty(spark, tmp_path)).collect() == []
