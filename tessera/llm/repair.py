"""Conversation repair by weighted CYK parsing.

The rows of a conversation, in order, are the words of a sentence. The repaired
role initials must form ``(s?(ua)+)?``, whose automaton has the states start, s, u
and ua. The Chomsky-normal-form grammar has one nonterminal for each pair of states,
the rules ``[p, r] -> [p, q] [q, r]``, and a terminal rule for each edit of a row,
closed under insertions before it. A cell holds, for each nonterminal, the least
(cost, audit) of its span; spans are combined bottom-up by length.

Every way to split a span derives the same nonterminals (any parse passes some state
at any place), so one split a span is enough: spans double in length from level to
level, and a conversation of n rows needs n cells. An audit has one letter other than
``I`` a row and ends with one, so that of two audits of a span neither begins the
other; their order is therefore decided inside the span, and a cell needs only the
rank of its audit among those that start in the same state. The audits themselves
are read off top-down. Long conversations are parsed in pieces by many tasks' rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, written

#: What each edit costs, and what a kept truncated row adds.
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
#: A row's first fault.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: White space, whose removal shows the last character that counts.
SPACE = " \t\n\x0b\f\r"

#: States of the automaton, and the letter that a row needs to go on from each.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ROLE = {"u": "user", "a": "assistant"}
NEVER = np.int64(1 << 60)
#: Insertions that complete a conversation from each state; only START and ASSISTANT are complete.
CLOSING = np.array([0, 2, 1, 0])

#: log2 of the rows that one piece has at most.
PIECE_BITS = 11
#: Rows parsed together.
LEAVES = 1 << 17


def _leaf(initial: int, fault: int) -> list[list[tuple[int, str] | None]]:
    """The least (cost, audit) of one row between any two states: insertions, then the row's edit."""
    best: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    more = UNFINISHED if fault == TRUNCATED else 0
    for p in range(4):
        state = p
        for k in range(4):
            letter, after = NEXT[state]
            edits = [(DELETE, "D", state)]
            if fault not in (BLANK, DUPLICATE):
                edits.append((REROLE + more, "R", after))
                if "sua"[initial : initial + 1] == letter:
                    edits.append((more, "K", after))
                if initial == 0 and state == START:
                    edits.append((more, "K", SYSTEM))
            for cost, name, q in edits:
                found = (INSERT * k + cost, "I" * k + name)
                best[p][q] = min(best[p][q] or found, found)
            state = after
    return best


#: For each kind of row (4 * initial + fault; initials s, u, a, others): cells and their audits.
LEAF = [_leaf(i, f) for i in range(4) for f in range(4)]


def _leaf_tables() -> tuple[np.ndarray, np.ndarray]:
    cost = np.full((16, 4, 4), NEVER, np.int64)
    rank = np.full((16, 4, 4), 3, np.int64)
    for kind, cells in enumerate(LEAF):
        for p in range(4):
            audits = sorted(c[1] for c in cells[p] if c)
            for q in range(4):
                if cells[p][q]:
                    cost[kind, p, q], rank[kind, p, q] = cells[p][q][0], audits.index(cells[p][q][1])
    return cost, rank


LEAF_COST, LEAF_RANK = _leaf_tables()


def combine(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (cost, rank) of joined spans, and the state in the middle of each nonterminal's best parse."""
    (lc, lr), (rc, rr) = left, right
    total = np.minimum(lc[:, :, :, None] + rc[:, None, :, :], NEVER)
    middle = np.argmin(total * 4 + lr[:, :, :, None], axis=2)
    cost = np.take_along_axis(total, middle[:, :, None, :], axis=2)[:, :, 0, :]
    span = np.arange(len(lc))[:, None, None]
    order = lr[span, np.arange(4)[None, :, None], middle] * 4 + rr[span, middle, np.arange(4)[None, None, :]]
    order = np.where(cost < NEVER, order, 99)
    rank = (order[:, :, None, :] < order[:, :, :, None]).sum(axis=3)
    return cost, rank, middle.astype(np.int8)


class Parse:
    """Bottom-up cells of many sentences at once: sentence i has ``sizes[i]`` leaves, one at least, in order."""

    def __init__(self, cost: np.ndarray, rank: np.ndarray, sizes: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while (sizes > 1).any():
            begin = np.cumsum(sizes) - sizes
            halves = sizes // 2
            above = (sizes + 1) // 2
            first = np.repeat(begin - 2 * (np.cumsum(above) - above), above) + 2 * np.arange(int(above.sum()))
            paired = np.arange(int(above.sum())) - np.repeat(np.cumsum(above) - above, above) < np.repeat(halves, above)
            at = first[paired]
            joined = combine((cost[at], rank[at]), (cost[at + 1], rank[at + 1]))
            cost, rank = cost[first], rank[first]
            cost[paired], rank[paired] = joined[0], joined[1]
            self.levels.append((first, paired, joined[2]))
            sizes = above
        self.cost, self.rank = cost, rank

    def leaves(self, enter: np.ndarray, leave: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states before and after each leaf in the best parses of ``[enter, leave]``."""
        for first, paired, middle in reversed(self.levels):
            n = int(first[-1] + 1 + paired[-1])
            before, after = np.empty(n, np.int64), np.empty(n, np.int64)
            before[first], after[first] = enter, leave
            q = middle[np.arange(len(middle)), enter[paired], leave[paired]]
            after[first[paired]], before[first[paired] + 1], after[first[paired] + 1] = q, q, leave[paired]
            enter, leave = before, after
        return enter, leave


def _parsed(pieces: list[np.ndarray], of: np.ndarray) -> list[tuple[str, int, int, int]]:
    """(audit, state before, cost, illegal pairs) of pieces of whole conversations; ``of``: ascending conversation numbers.

    Costs stand at a conversation's first piece. Pieces are parsed twice, so that only
    their tops are held at once.
    """
    sizes = np.array([len(p) for p in pieces])
    runs = np.split(np.arange(len(pieces)), np.flatnonzero(np.diff(np.cumsum(sizes) // LEAVES)) + 1)

    def parse(run: np.ndarray) -> tuple[Parse, np.ndarray]:
        kinds = np.concatenate([pieces[i] for i in run])
        return Parse(LEAF_COST[kinds], LEAF_RANK[kinds], sizes[run]), kinds

    tops = [(found.cost, found.rank) for found, _ in map(parse, runs)]
    whole = Parse(np.concatenate([c for c, _ in tops]), np.concatenate([r for _, r in tops]), np.bincount(of)[np.unique(of)])
    end = np.argmin((whole.cost[:, START] + INSERT * CLOSING) * 4 + whole.rank[:, START], axis=1)
    first = np.concatenate([[True], of[1:] != of[:-1]])
    last = np.concatenate([first[1:], [True]])
    enter, leave = whole.leaves(np.zeros(len(end), np.int64), end)
    cost = np.zeros(len(pieces), np.int64)
    cost[first] = whole.cost[np.arange(len(end)), START, end] + INSERT * CLOSING[end]
    out, seen = [], 3
    for run in runs:
        found, kinds = parse(run)
        p, q = found.leaves(enter[run], leave[run])
        letters = [LEAF[k][a][b][1] for k, a, b in zip(kinds.tolist(), p.tolist(), q.tolist(), strict=True)]
        initials, at = kinds // 4, 0
        for i in run:
            own = initials[at : at + sizes[i]]
            pair = np.concatenate([own[:0] if first[i] else [seen], own])
            legal = (pair[1:] == 1) & (np.isin(pair[:-1], (0, 2))) | (pair[1:] == 2) & (pair[:-1] == 1)
            audit = "".join(letters[at : at + sizes[i]]) + "I" * int(CLOSING[leave[i]] * last[i])
            out.append((audit, int(enter[i]), int(cost[i]), int((~legal).sum())))
            seen, at = own[-1], at + sizes[i]
    return out


def with_faults(rows: DataFrame, role: str = "role", text: str = "text") -> list[Column]:
    """``initial`` and whether a row is ``blank`` or ``truncated``, of its role and text."""
    end = F.rtrim(F.col(text), F.lit(SPACE))
    first = F.substring(role, 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return [initial.alias("initial"), (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated")]


def ordered_turns(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` (nulls: one space) and ``at``, which ascends with the rows of each conversation.

    Rows stand by turn, nulls first, rows of one turn by role and text. Ranges of rows, not
    conversations, are dealt to tasks, so a conversation may have any number of rows. Written,
    because ``at`` is where a row stands in its range.
    """
    own = rows.select(F.col("conv"), F.col("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    keys = [F.col("conv"), F.col("turn"), F.col("role"), F.substring("text", 1, 64)]
    dealt = own.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions("conv", "turn", "role", "text")
    return written(dealt.withColumn("at", F.monotonically_increasing_id()), "turns")


def parse_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``ordered_turns``: a row per piece (``conv``, ``piece``, ``audit``, ``state``, ``cost``, ``illegal``) and a row per conversation's faults.

    A row that repeats role and text of an earlier one of its conversation is found by
    counting (SHA-256 of the text), combined before the shuffle; texts don't travel.
    """
    small = turns.select("conv", "turn", "role", "at", F.unhex(F.sha2("text", 256)).alias("digest"), *with_faults(turns))
    firsts = small.groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    of = firsts.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    joined = small.join(of, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("at") > F.col("first"), DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(FINE)
    marked = joined.select("conv", "turn", "at", (F.col("initial") * 4 + fault).cast("int").alias("kind"))
    listed = F.sort_array(F.collect_list(F.struct("at", "kind")))  # a piece's rows, at most 2 ** PIECE_BITS
    pieces = marked.groupBy("conv", F.shiftright("at", PIECE_BITS).alias("piece")).agg(F.transform(listed, lambda x: x["kind"]).alias("kinds"), *[F.count_if(F.col("kind") % 4 == f).alias(name) for f, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))])
    pieces = written(pieces, "pieces")
    faults = pieces.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, int, np.ndarray]] = []
        leaves, names = 0, ["conv", "piece", "audit", "state", "cost", "illegal"]

        def settled(done: list[tuple[int | None, int, np.ndarray]]) -> pa.RecordBatch:
            convs = [c for c, _, _ in done]
            found = _parsed([k for _, _, k in done], np.cumsum([0, *(a != b for a, b in zip(convs[1:], convs, strict=False))]))
            columns = [convs, [p for _, p, _ in done], *zip(*found, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()], strict=True)], names=names)

        for batch in batches:
            kinds = batch.column(2)
            for conv, piece, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), kinds, strict=True):
                if leaves >= LEAVES and held[-1][0] != conv:
                    yield settled(held)
                    held, leaves = [], 0
                held.append((conv, piece, own.values.to_numpy().astype(np.int8)))
                leaves += len(held[-1][2])
        if held:
            yield settled(held)

    dealt = pieces.select("conv", "piece", "kinds").repartition("conv").sortWithinPartitions("conv", "piece")
    audits = mapped(dealt, parse, "conv long, piece long, audit string, state int, cost long, illegal long")
    return written(audits, "audits"), faults


Replayed = tuple[int | None, int, int, str, str, str]


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Replayed]]:
    """(conv, at, number, edit, role, text) of repaired rows, a list for each batch; a piece's audit stands before its rows."""
    edits, place, closing, state = "", 0, 0, START

    def inserted(conv: int | None, at: int, number: int) -> list[Replayed]:
        nonlocal place, state
        out: list[Replayed] = []
        while place < len(edits) and edits[place] == "I":
            letter, state = NEXT[state]
            out.append((conv, at, number + len(out), "I", ROLE[letter], ""))
            place += 1
        return out

    for batch in batches:
        rows: list[Replayed] = []
        for conv, at, role, text, audit, entered in zip(*[batch.column(c).to_pylist() for c in ("conv", "at", "role", "text", "edits", "state")], strict=True):
            if audit is not None:
                edits, place, closing, state = audit, 0, len(audit.rstrip("I")), entered
                continue
            before = inserted(conv, at, 0)
            rows += before
            edit = edits[place]
            place += 1
            if edit == "K":
                state = SYSTEM if state == START and role[:1] == "s" else NEXT[state][1]
                rows.append((conv, at, len(before), edit, role, text))
            elif edit == "R":
                letter, state = NEXT[state]
                rows.append((conv, at, len(before), edit, ROLE[letter], text))
            if place == closing:  # what completes the conversation follows its last row
                rows += inserted(conv, at, len(before) + 1)
        yield rows


def _with_audits(turns: DataFrame, audits: DataFrame, *keys: str) -> DataFrame:
    """Turns and audits, dealt by ``keys`` and sorted so that each piece's audit stands before its rows."""
    rows = turns.select("conv", F.shiftright("at", PIECE_BITS).alias("piece"), "at", "role", "text", F.lit(None).cast("string").alias("edits"), F.lit(0).alias("state"))
    heads = audits.select("conv", "piece", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.lit("").alias("text"), F.col("audit").alias("edits"), "state")
    return rows.unionByName(heads).repartition(*keys).sortWithinPartitions("conv", "piece", "at").drop("piece")


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``conv``, ``at`` and ``number`` (their order), ``edit``, ``role``, ``text``.

    Pieces are replayed apart, so that a long conversation spreads over tasks.
    """

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _replayed(batches):
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()], strict=True)], names=["conv", "at", "number", "edit", "role", "text"])

    return mapped(_with_audits(turns, audits, "conv", "piece"), replay, "conv long, at long, number int, edit string, role string, text string")


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv`` and ``repaired_sha256`` of its ``role:text``, joined by line feeds; no row for a conversation without repaired rows.

    SHA-256 reads a conversation from front to end, so its rows stream through one task,
    which holds a batch of them.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_conv, found = None, None
        for rows in _replayed(batches):
            done = []
            for conv, _, _, _, role, text in rows:
                if found is None or conv != open_conv:
                    done += [] if found is None else [(open_conv, found.hexdigest())]
                    open_conv, found = conv, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    found.update(f"\n{role}:{text}".encode())
            yield _digests(done)
        yield _digests([] if found is None else [(open_conv, found.hexdigest())])

    return mapped(_with_audits(turns, audits, "conv"), digest, "conv long, repaired_sha256 string")


def _digests(done: list[tuple[int | None, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], names=["conv", "repaired_sha256"])


@dataclass(frozen=True)
class Repair:
    """What a repair gives: ``summary`` (a row per conversation), its ordered ``turns`` and the ``audits`` of their pieces."""

    summary: DataFrame
    turns: DataFrame
    audits: DataFrame


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Repair every conversation of ``rows`` at the least (cost, audit).

    ``summary`` has ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit``;
    ``repaired_turns`` gives the repaired rows and ``repaired_digests`` their digests. Null roles and texts
    count as one space, rows with null turns come first, rows with null keys are one conversation, repeated rows
    are duplicates, an empty table gives empty tables. Keys and turns are whole numbers; other columns
    aren't read. An audit is one value, so a conversation's audit is gathered in one row.
    """
    own = rows.select(F.col(key).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    turns = ordered_turns(own)
    audits, faults = parse_turns(turns)
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = turns.groupBy("conv").agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))
    parts = F.sort_array(F.collect_list(F.struct("piece", "audit")))
    parsed = audits.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.transform(parts, lambda x: x["audit"]), "").alias("audit"))
    return Repair(joined_on_conv(joined_on_conv(gaps, faults), parsed), turns, audits)


def joined_on_conv(left: DataFrame, right: DataFrame) -> DataFrame:
    """A left join on ``conv`` in which null is a conversation like others."""
    other = right.withColumnRenamed("conv", "_conv")
    return left.join(other, left["conv"].eqNullSafe(other["_conv"]), "left").drop("_conv")
