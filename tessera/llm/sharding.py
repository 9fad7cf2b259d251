"""Sharding by jump consistent hashing, in DataFrame expressions only.

The key's 64-bit linear congruential sequence decides every jump, so a shard
depends on the key and the shard count alone, no ring table exists, and one more
shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: multiplier of the published jump-hash generator, as 32-bit halves and 16-bit quarters.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW1, _LOW0 = _LOW >> 16, _LOW & 0xFFFF
_MASK = 0xFFFFFFFF


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """One generator step ``state * MULTIPLIER + 1`` modulo 2**64.

    The state is two unsigned 32-bit halves in longs: every product stays
    below 2**63, so no step overflows in ANSI mode.
    """
    p0, p1 = low * F.lit(_LOW0), low * F.lit(_LOW1)
    lower = p0 + F.shiftleft(p1.bitwiseAND(0xFFFF), 16) + F.lit(1)
    carry = F.shiftright(lower, 32) + F.shiftright(p1, 16)
    cross = (low * F.lit(_HIGH)).bitwiseAND(_MASK)
    upper = (high * F.lit(_LOW0)).bitwiseAND(_MASK) + F.shiftleft((high * F.lit(_LOW1)).bitwiseAND(0xFFFF), 16)
    return (carry + cross + upper).bitwiseAND(_MASK), lower.bitwiseAND(_MASK)


def jump_walk(key: Column, *shard_counts: int) -> Column:
    """Struct with ``chunk`` (the first draw) and ``shards``, one shard per shard count.

    The jumps of a key are one ascending sequence; the shard among n is the
    last jump below n, so several counts share one walk. A null key counts as 0.
    """
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    top = max(shard_counts)
    names = [f"s{i}" for i in range(len(shard_counts))]
    zero = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(_MASK)).alias("low"), F.lit(0).cast("long").alias("jump"),
        F.lit(-1).cast("long").alias("chunk"), *[F.lit(0).cast("long").alias(x) for x in names],
    )

    def step(state: Column, _: Column) -> Column:
        high, low = _step(state["high"], state["low"])
        draw = F.shiftright(high, 1)
        landed = F.floor((state["jump"] + 1).cast("double") * (F.lit(float(1 << 31)) / (draw + 1).cast("double")))
        return F.struct(
            high.alias("high"), low.alias("low"), F.when(state["jump"] < top, F.least(landed, F.lit(top))).otherwise(state["jump"]).cast("long").alias("jump"),
            F.when(state["chunk"] < 0, draw).otherwise(state["chunk"]).alias("chunk"),
            *[F.when(state["jump"] < n, state["jump"]).otherwise(state[x]).alias(x) for x, n in zip(names, shard_counts, strict=True)],
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(top)), zero, step, lambda s: F.struct(s["chunk"].alias("chunk"), F.array(*[s[x].cast("int") for x in names]).alias("shards"))
    )


def assign_shards(df: DataFrame, key: str, shards: int, grown: int | None = None, chunks: int = 1024, order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard``, ``slot`` and ``grown_shard`` (the shard among ``grown``, default one more).

    Slots are gapless from 0 in every shard. No task holds a shard: each
    (shard, chunk) numbers its own rows, and a table of shards x chunks row
    counts (bounded by those two parameters, so it may be broadcast) gives the
    chunk's first slot. Rows with one key share shard and chunk and are
    numbered by ``order``; tied rows take the tied slots in any order. Null
    keys count as 0; an empty table gives an empty table. Columns of the input
    named like the added ones are replaced, others may have any names.
    """
    grown = shards + 1 if grown is None else grown
    df = df.drop("shard", "slot", "grown_shard")
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(key).alias("key"), F.struct(F.lit(0).alias("_"), *order).alias("rank"), jump_walk(F.col(key), shards, grown).alias("walk"))
    walked = rows.select("row", "key", "rank", F.col("walk.shards")[0].alias("shard"), F.col("walk.shards")[1].alias("grown_shard"), (F.col("walk.chunk") % chunks).alias("chunk"))
    counts = walked.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col("shard").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("shard", "chunk").orderBy("key", "rank")
    numbered = walked.withColumn("number", F.row_number().over(own))
    slot = (F.col("first") + F.col("number") - 1).cast("long")
    return numbered.join(F.broadcast(first), (F.col("shard") == F.col("s")) & (F.col("chunk") == F.col("c"))).select(
        *[F.col("row").getField(c).alias(c) for c in df.columns], "shard", slot.alias("slot"), "grown_shard"
    )
