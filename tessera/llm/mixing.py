"""Mixing sources to target weights by Sainte-Lague apportionment.

A source's rows form a stream in a fixed pseudo-random order; the stream is cut
into blocks of equally many words, and a seeded permutation numbers a source's blocks.
The highest quotients target / (2 k + 1) give the seats of the mix, shard after shard,
so each shard has an integer quota of every source; a source's j-th seat is its block
of number j (the first again after the last), which goes to the shard that holds the seat.

Sources are rows of a table at every step (targets, divisors, quotas), so there may be
any number of them; the driver sees sums, a few for each round of a search.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, bounded_batches, written

#: A row's place in its source's stream is a hash of so many bits; rows of a stretch of hashes are numbered together.
SPOT_BITS, STRETCH_ROWS = 24, 20_000
#: Steps of the block permutation: the first of these primes that doesn't divide the number of blocks.
STEPS = (1_000_003, 999_983)
#: Places tried together in a round of a search.
TRIED = 31


def _positions(sources: DataFrame) -> DataFrame:
    """Adds ``pos``, the place of each source by code point, null last: numbers within a sorted partition, plus those before it."""
    ordered = sources.orderBy(F.col("source").isNull(), "source")
    tagged = written(ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition of the sort
    firsts = tagged.groupBy("part").agg(F.count("*").alias("n")).select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return tagged.join(F.broadcast(firsts), F.col("part") == F.col("p")).withColumn("pos", F.col("first") + F.col("at") - F.shiftleft("part", 33)).drop("at", "part", "p", "first")


def water_level(sources: DataFrame, total: float) -> float:
    """The level at which ``least(cap, level * weight)`` adds up to ``total``; infinite if all caps together are less.

    Each round shares out what the sources that are full leave over; a source that is full
    stays so, and a round in which none becomes full is the last.
    """
    level, full = 0.0, -1
    while True:
        is_full = F.col("cap") < F.lit(level) * F.col("weight") if level else F.col("cap") <= 0
        row = sources.agg(F.count_if(is_full).alias("full"), F.sum(F.when(is_full, F.col("cap"))).alias("held"), F.sum(F.when(~is_full, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            return float("inf")
        if row["full"] == full:
            return level
        full, level = row["full"], (total - (row["held"] or 0)) / row["open"]


def _searched(goals: list[int], high: int, counts: Callable[[list[int]], list[int]]) -> tuple[list[int], list[int]]:
    """For each goal the least place in (0, high] whose count is at most the goal, and that count.

    ``counts`` gives, for each goal's places in turn, a count that falls as the place rises
    and is at most the goal at ``high``.
    """
    low, top, held = [0] * len(goals), [high] * len(goals), [0] * len(goals)
    known = False
    while not known or any(b - a > 1 for a, b in zip(low, top, strict=True)):
        tried = [[max(1, a + (b - a) * k // (TRIED + 1)) for k in range(1, TRIED + 1)] + [b] for a, b in zip(low, top, strict=True)]
        found = counts([p for own in tried for p in own])
        for i, own in enumerate(tried):
            for p, n in zip(own, found[i * (TRIED + 1) : (i + 1) * (TRIED + 1)], strict=True):
                if p <= low[i]:
                    continue
                if n <= goals[i]:
                    top[i], held[i] = p, n
                    break
                low[i] = p
        known = True
    return top, held


def _over(divisor: Column) -> Column:
    """How many of a source's quotients target / (2 k + 1), k under ``seats``, are over the divisor."""
    target = F.col("target")
    about = F.floor(F.least(F.col("seats").cast("double"), F.greatest(F.lit(0.0), (target / divisor - 1) / 2)))
    base = F.greatest(F.lit(0).cast("long"), about - 1)
    exact = base + sum(((target / (2 * (base + k) + 1) > divisor).cast("long") for k in range(1, 4)), (target / (2 * base + 1) > divisor).cast("long"))
    return F.when(target > 0, F.least("seats", exact)).otherwise(F.lit(0).cast("long"))


def _double(bits: int) -> float:
    return struct.unpack("<d", struct.pack("<q", bits))[0]


def with_quotas(sources: DataFrame, goals: list[int]) -> DataFrame:
    """Adds ``quotas``: what each source (``pos``, ``target``, ``seats`` at most) has of the first ``goals[i]`` seats, for every i.

    Seats go by the highest quotients ``target / (2 k + 1)``, equal ones to the earlier
    source; ``goals`` ascends. The least quotient that is served whole is found by a search
    over the ordered bits of doubles, many tried in each round, so the work follows
    the sources and not the seats.
    """
    summary = sources.agg(F.max("target").alias("most"), F.sum(F.when(F.col("target") > 0, F.col("seats"))).alias("seats")).first()
    if not summary["most"]:
        return sources.withColumn("quotas", F.array_repeat(F.lit(0).cast("long"), len(goals)))
    goals = [min(g, summary["seats"]) for g in goals]

    def counted(values: list, of: Callable[[Column], Column]) -> list[int]:
        rows = sources.select("pos", "target", "seats", F.posexplode(F.lit(values)).alias("at", "tried")).groupBy("at").agg(F.sum(of(F.col("tried"))).alias("n")).collect()
        found = {r["at"]: r["n"] for r in rows}
        return [found[i] for i in range(len(values))]

    top = struct.unpack("<q", struct.pack("<d", float(summary["most"])))[0]
    bits, held = _searched(goals, top, lambda places: counted([_double(p) for p in places], _over))
    divisors = [_double(b) for b in bits]

    def margin(divisor: Column) -> Column:
        n = _over(divisor)
        return (F.col("target") > 0) & (n < F.col("seats")) & (F.col("target") / (2 * n + 1) == divisor)

    last = [0] * len(goals)  # of the sources whose next quotient is the divisor, those under this position get one more
    left = [g - h for g, h in zip(goals, held, strict=True)]
    if any(left):
        positions = sources.count()
        pairs = lambda places: [{"d": d, "p": p} for d, own in zip(divisors, (places[i : i + TRIED + 1] for i in range(0, len(places), TRIED + 1)), strict=True) for p in own]
        behind = lambda places: F.array(*[F.struct(F.lit(x["d"]).alias("d"), F.lit(positions + 1 - x["p"]).cast("long").alias("p")) for x in pairs(places)])

        def before(places: list[int]) -> list[int]:
            rows = sources.select("pos", "target", "seats", F.posexplode(behind(places)).alias("at", "x")).groupBy("at").agg(F.count_if(margin(F.col("x.d")) & (F.col("pos") < F.col("x.p"))).alias("n")).collect()
            found = {r["at"]: r["n"] for r in rows}
            return [found[i] for i in range(len(places))]

        found, _ = _searched(left, positions + 1, before)
        last = [positions + 1 - p for p in found]
    tries = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(p).cast("long").alias("p")) for d, p in zip(divisors, last, strict=True)])
    return sources.withColumn("quotas", F.transform(tries, lambda x: _over(x["d"]) + (margin(x["d"]) & (F.col("pos") < x["p"])).cast("long")))


def plan_mix(totals: DataFrame, weights: tuple[float, ...], share: float, most: int, block_words: int, shards: int, seed: int) -> DataFrame:
    """Sources (``source``, ``source_size``) with ``target``, ``blocks``, cumulated ``quotas`` by shard, and their permutation (``step``, ``shift``).

    Sources are taken by code point, null last, and weigh ``weights`` in turn. Targets
    stop at ``most`` times the source's size. Every shard has an equal run of seats; since adding
    seats never takes one away from a source, a shard's quotas are the growth over its run.
    """
    n = F.col("source_size")
    total = totals.agg(F.sum("source_size")).first()[0] or 0
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    listed = _positions(totals).withColumns({"weight": weight, "cap": (most * n).cast("double"), "blocks": F.ceil(n / block_words)})
    listed = written(listed, "mix-weights")
    level = water_level(listed, share * total) if total else 0.0
    filled = F.when(F.col("cap") < F.lit(level) * F.col("weight"), F.col("cap")).otherwise(F.lit(level) * F.col("weight")) if level != float("inf") else F.col("cap")
    aimed = written(listed.withColumns({"target": F.when(n > 0, filled).otherwise(F.lit(0.0)), "seats": most * F.col("blocks")}), "mix-targets")
    seats = int(min(share, most) * total / block_words + 0.5)
    steps = F.coalesce(*[F.when(F.col("blocks") % p != 0, F.lit(p).cast("long")) for p in STEPS], F.lit(1).cast("long"))
    planned = with_quotas(aimed, [seats * (k + 1) // shards for k in range(shards)])
    shift = (F.lit(seed * 1_000_003).cast("long") * (F.col("pos") + 1)) % F.greatest("blocks", F.lit(1))
    return written(planned.select("source", "source_size", "target", "blocks", "quotas", steps.alias("step"), shift.alias("shift")), "mix-plan")


def _spot(key: str) -> Column:
    """The row's place in its source's stream, from its key and size."""
    name = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), F.col("size").cast("string"))
    return F.conv(F.substring(F.md5(name), 1, SPOT_BITS // 4), 16, 10).cast("long")


def _stretches(spark: SparkSession, rows: int) -> int:
    return 1 << min(SPOT_BITS, max(4, (rows // STRETCH_ROWS).bit_length()))


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", block_words: int = 128, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, shards: int = 16, seed: int = 7, carry: dict[str, Column] | None = None) -> DataFrame:
    """What the mix takes of every row: key, source, ``size``, ``source_size``, ``target``, ``taken`` and ``passes``.

    ``size`` counts words; a null text has none. ``passes`` lists, for each time
    the mix goes through the row, the word spans [start, end) it takes, each with its ``shard``.
    A source's rows follow each other by a hash of key and size, then key, then size, so
    reruns agree whatever the order of rows; rows alike in all three are interchangeable. No
    source is one task: a row's place is its (source, stretch of hashes) start, from a
    table of sums, plus a running sum within the stretch, and the number of stretches follows the
    rows without changing their order. Null sources are one source, null keys are as
    one key. An empty table gives an empty table. Columns given in ``carry`` pass through
    under their names, which must differ from those above and the plan's; ``docs`` is read once.
    """
    carry = carry or {}
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    picked = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"), *[c.alias(n) for n, c in carry.items()])
    sized = written(picked.withColumn("spot", _spot("key")), "mix-sizes")
    stretches = _stretches(docs.sparkSession, sized.count())
    sized = sized.withColumn("stretch", F.expr(f"spot div {(1 << SPOT_BITS) // stretches}"))
    sums = written(sized.groupBy("source", "stretch").agg(F.sum("size").alias("n")), "mix-sums")
    plan = plan_mix(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, most, block_words, shards, seed)
    before = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("stretch").alias("c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("source", "stretch").orderBy("spot", "key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = starts.join(plan.withColumnRenamed("source", "m"), F.col("s").eqNullSafe(F.col("m")))
    placed = (
        sized.withColumn("upto", F.sum("size").over(own))
        .join(table, F.col("source").eqNullSafe(F.col("s")) & (F.col("stretch") == F.col("c")))
        .withColumn("at", F.col("first") + F.col("upto") - F.col("size"))
        .withColumn("passes", _passes(block_words))
        .withColumn("taken", F.aggregate(F.flatten("passes"), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]))
    )
    return placed.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", *carry, "passes", "taken")


def _passes(block_words: int) -> Column:
    """For each pass through the source, the spans of the row's blocks that have a seat, with the seat's shard."""
    at, size, blocks, quotas = F.col("at"), F.col("size"), F.col("blocks"), F.col("quotas")
    quota = F.element_at(quotas, -1)
    numbers = F.sequence(F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}"))
    passes = F.sequence(F.lit(0).cast("long"), F.expr("(element_at(quotas, -1) - 1) div greatest(blocks, 1)"))

    def seat(turn: Column, b: Column) -> Column:
        return turn * blocks + F.pmod(b * F.col("step") + F.col("shift"), blocks)

    def span(turn: Column, b: Column) -> Column:
        start, end = F.greatest(b * block_words - at, F.lit(0).cast("long")), F.least((b + 1) * block_words - at, size)
        return F.struct(start.alias("start"), end.alias("end"), F.size(F.filter(quotas, lambda q: q <= seat(turn, b))).alias("shard"))

    chosen = F.transform(passes, lambda turn: F.transform(F.filter(numbers, lambda b: seat(turn, b) < quota), lambda b: span(turn, b)))
    none = F.array().cast("array<array<struct<start:bigint,end:bigint,shard:int>>>")
    return F.when((size == 0) | (quota == 0), none).otherwise(F.filter(chosen, lambda spans: F.size(spans) > 0))


def shard_words(passes: Column) -> Column:
    """What each shard takes of a row, as ``shard:words`` with commas between."""
    spans = F.flatten(passes)
    shards = F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["shard"])))
    words = lambda k: F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + F.when(s["shard"] == k, s["end"] - s["start"]).otherwise(0))
    return F.array_join(F.transform(shards, lambda k: F.concat_ws(":", k.cast("string"), words(k).cast("string"))), ",")


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: one row for each pass through a row, its text cut to the words taken.

    A pass that takes the whole text keeps it byte for byte; one that takes
    spans keeps each span from its first to its last word as it stands, the spans
    joined by a line feed (adjoining spans are one). Rows with no words, or of
    which nothing is taken, go. Null texts, keys and sources as in ``mix_sources``; an empty
    table gives an empty table. Columns may have any names.
    """
    bounded_batches(docs.sparkSession)
    named = docs.select(F.col(key).alias("k"), F.col(source).alias("s"), F.col(text).alias("t"), F.struct(*docs.columns).alias("row"))
    taken = mix_sources(named, "t", "s", "k", carry={"row": F.col("row")}, **options)
    rows = taken.select("row", "size", F.explode("passes").alias("spans"))
    whole = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]) == F.col("size")
    own = F.col("row").getField(text)
    cut = F.when(whole, own).otherwise(_cut_spans(F.when(~whole, own), F.when(~whole, F.col("spans"))))
    return rows.select(*[cut.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def _cut_spans(text: Column, spans: Column) -> Column:
    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(t, own):
            if t is None or own is None:
                return None
            at = [m.span() for m in re.finditer(WORD, t)]
            merged: list[list[int]] = []
            for s in own:
                if merged and merged[-1][1] == s["start"]:
                    merged[-1][1] = s["end"]
                else:
                    merged.append([s["start"], s["end"]])
            return "\n".join(t[at[a][0] : at[b - 1][1]] for a, b in merged)

        return pd.Series([one(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    return cut(text, spans)
