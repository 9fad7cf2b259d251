import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, conv long, at long, piece int, kind string, audit string, cost long, state int"
EXTRA = (7, 8, 9, "k", "a", 1, 2)


def table(spark, tmp_path, rows):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        cut = text.rstrip(" \t\n\x0b\f\r")
        out.append("blank" if not cut else "duplicate" if (role, text) in seen else "fine" if cut[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def in_order(rows):
    """Rows (turn, role, text) with nulls as one space, in their order."""
    return sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def shortest(rows):
    """(cost, audit, repaired) by trying every edit from the front, without a grammar."""
    faults = faults_of(rows)

    @functools.cache
    def best(i, need, started, led, inserted):
        found = [(0, "", ())] if i == len(rows) and need == "u" and (started or not led) else []
        if inserted < 3:
            c, a, out = best(i, "a" if need == "u" else "u", True, led, inserted + 1)
            found.append((c + 2, "I" + a, (({"u": "user", "a": "assistant"}[need], ""), *out)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, out = best(i + 1, need, started, led, 0)
            found.append((c + 3, "D" + a, out))
            if faults[i] not in ("blank", "duplicate"):
                more, after = int(faults[i] == "truncated"), "a" if need == "u" else "u"
                c, a, out = best(i + 1, after, True, led, 0)
                found.append((c + 2 + more, "R" + a, (({"u": "user", "a": "assistant"}[need], text), *out)))
                if role[:1] == need:
                    found.append((c + more, "K" + a, ((role, text), *out)))
                if role[:1] == "s" and not started and not led:
                    c, a, out = best(i + 1, "u", False, True, 0)
                    found.append((c + more, "K" + a, ((role, text), *out)))
        return min(found, default=(10**6, "", ()))

    return best(0, "u", False, False, 0)


def expected(rows):
    rows = in_order(rows)
    faults, turns = faults_of(rows), [t for t, _, _ in rows if t is not None]
    cost, audit, out = shortest(tuple(rows))
    legal = [a[1][:1] + b[1][:1] in ("su", "ua", "au") for a, b in itertools.pairwise(rows)]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"), "illegal": legal.count(False), "cost": cost, "audit": audit, "out": list(out),
    }


def conversations(seed, n):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(draw.randint(1, 9)):
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "s", "ü"])
            text = draw.choice(["Yes.", "No", "", " \t\n\x0b", None, "what?\n", "end.\u0085", "a" * 3000 + "!", "Ok. ", f"{draw.random()}."])
            rows.append((c if c else None, draw.choice([t, t, t, t + 3, 0, None]), role, text))
    return [*rows, rows[0], rows[0], rows[5]]


@pytest.mark.parametrize("bits", [11, 1])
def test_against_brute_force(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(repair, "PIECE_BITS", bits)
    monkeypatch.setattr(repair, "LEAVES", 40)
    rows = conversations(bits, 120)
    found = repair.repair(table(spark, tmp_path, rows))
    got = {r["conv"]: r.asDict() for r in found.summary.collect()}
    turns = {}
    for r in repair.repaired_turns(found.turns, found.audits).orderBy("at", "number").collect():
        turns.setdefault(r["conv"], []).append((r["role"], r["text"]))
    shas = {r["conv"]: r["repaired_sha256"] for r in repair.repaired_digests(found.turns, found.audits).collect()}
    groups = {}
    for c, *r in rows:
        groups.setdefault(c, []).append(tuple(r))
    assert set(got) == set(groups)
    for c, own in groups.items():
        want = expected(own)
        out = want.pop("out")
        assert {k: got[c][k] for k in want} == want
        assert turns.get(c, []) == out
        assert shas.get(c) == (hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest() if out else None)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))


def test_a_conversation_of_many_pieces(spark, tmp_path):
    """One conversation holds nearly all rows; it is parsed in pieces of several ranges."""
    draw = random.Random(4)
    rows = [(1, t, draw.choice(["user", "assistant", "assistant"]), draw.choice(["Yes.", "No", f"{t}.", f"{t}"])) for t in range(9000)] + [(2, 0, "user", "Hi.")]
    found = repair.repair(table(spark, tmp_path, rows))
    assert found.audits.where("conv = 1").count() >= 5
    row = found.summary.where("conv = 1").first()
    best = {repair.START: (0, "")}
    ordered = in_order([r[1:] for r in rows if r[0] == 1])
    for fault, (_, role, _) in zip(faults_of(ordered), ordered, strict=True):
        kind = "sua".find(role[:1]) * 4 + ["fine", "blank", "duplicate", "truncated"].index(fault)
        step = {}
        for p, (c, a) in best.items():
            for q, cell in enumerate(repair.LEAF[kind][p]):
                if cell:
                    step[q] = min(step.get(q, (10**9, "")), (c + cell[0], a + cell[1]))
        best = step
    want = min((c + 2 * int(repair.CLOSING[q]), a + "I" * int(repair.CLOSING[q])) for q, (c, a) in best.items())
    assert (row["cost"], row["audit"]) == want


def test_spans_of_any_split_have_the_same_cell():
    """The textbook parse over every split of every span gives the cells that one split gives."""
    draw = random.Random(1)
    for _ in range(30):
        kinds = [draw.randrange(16) for _ in range(draw.randint(1, 9))]
        n = len(kinds)
        cells = {(i, i + 1): repair.LEAF[k] for i, k in enumerate(kinds)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                j = i + length
                cells[i, j] = [[min((((a[0] + b[0]), a[1] + b[1]) for m in range(i + 1, j) for q in range(4) if (a := cells[i, m][p][q]) and (b := cells[m, j][q][r])), default=None) for r in range(4)] for p in range(4)]
        found = repair.Parse(repair.LEAF_COST[kinds], repair.LEAF_RANK[kinds], repair.np.array([n]))
        for p in range(4):
            for r in range(4):
                cell = cells[0, n][p][r]
                if cell is None:
                    assert found.cost[0, p, r] == repair.NEVER
                    continue
                enter, leave = found.leaves(repair.np.array([p]), repair.np.array([r]))
                audit = "".join(repair.LEAF[k][a][b][1] for k, a, b in zip(kinds, enter, leave, strict=True))
                assert (int(found.cost[0, p, r]), audit) == cell


def test_query_against_brute_force(spark, tmp_path):
    rows = conversations(9, 200)
    table(spark, tmp_path, rows)
    got = {r["conv_id"]: r.asDict() for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    groups = {}
    for c, t, role, text in rows:
        own = groups.setdefault(c, [])
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        own += [(t, "user" if what == 4 else role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    assert set(got) == set(groups)
    assert any(not own for own in groups.values())
    for c, own in groups.items():
        want = expected(own)
        want["repaired_sha256"] = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in want.pop("out")).encode()).hexdigest()
        assert got[c] == {"conv_id": c, **want}


def test_empty_table(spark, tmp_path):
    rows = table(spark, tmp_path, [(1, 0, "user", "x")]).where(F.lit(False))
    found = repair.repair(rows)
    assert found.summary.collect() == [] and repair.repaired_turns(found.turns, found.audits).collect() == []
    rows.write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert queries.op13_conversation_repair(spark, str(tmp_path / "none")).collect() == []
