"""URL filters by a Bloom filter cascade, in DataFrame expressions only.

Level 0 encodes the listed keys; every next level encodes the keys of the other
kind (from the complete key universe of the corpus) that the level before wrongly
passes. The first level that rejects a key therefore tells by its parity
whether the key is listed: membership is exact for the universe, and looking a
URL up needs no join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Filters travel inside the plan; they are O(listed keys) and may not exceed this.
MAX_FILTER_BITS = 8 * 64 * 1024 * 1024


@dataclass(frozen=True)
class Level:
    salt: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def passes(self, key: Column) -> Column:
        words = F.array(*[F.lit(w).cast("long") for w in self.words])
        hit = F.lit(True)
        for i in range(self.hashes):
            at = _position(key, self.salt, i, self.bits)
            hit = hit & (F.getbit(F.element_at(words, (F.shiftright(at, 5) + 1).cast("int")), at.bitwiseAND(31).cast("int")) == 1)
        return hit


def _position(key: Column, salt: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt), F.lit(i)), F.lit(bits).cast("long"))


def _level(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """Encode ``keys`` (column ``key``, n distinct rows) with the false-positive rate given."""
    hashes = max(1, round(-math.log2(rate)))
    bits = 32 * max(1, math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 32))
    if bits > MAX_FILTER_BITS:
        raise ValueError(f"a level of {bits} bits exceeds {MAX_FILTER_BITS}; split the list")
    at = keys.select(F.explode(F.array(*[_position(F.col("key"), salt, i, bits) for i in range(hashes)])).alias("at"))
    grouped = at.groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("v"))
    words = [0] * (bits // 32)
    for row in grouped.collect():  # at most bits / 32 rows, bounded above
        words[row["word"]] = row["v"]
    return Level(salt, bits, hashes, tuple(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe that the cascade was built over."""
        if not self.levels:
            return F.lit(False)
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            answer = F.when(~self.levels[depth].passes(key), F.lit(depth % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(universe: DataFrame, listed: DataFrame, salt: int = 0, max_levels: int = 60) -> Cascade:
    """Cascade over ``universe`` (column ``key``) for the listed keys (column ``key``).

    Null keys are ignored, repeated ones count once, an empty list gives a
    cascade that contains nothing. The first level's rate follows the sizes,
    so that its false positives are about as many as the listed keys and every level stays
    O(listed keys) however large the universe is.
    """
    listed = listed.select("key").where("key is not null").distinct()
    others = universe.select("key").where("key is not null").distinct().join(listed, "key", "left_anti")
    n, m = listed.count(), others.count()
    levels: list[Level] = []
    inside, outside, size = listed, others, n
    rate = min(0.5, max(1e-9, n / max(m, 1) * 0.7))
    while size and len(levels) < max_levels:
        level = _level(inside, size, rate, salt * 1000 + len(levels))
        levels.append(level)
        inside, outside = outside.where(level.passes(F.col("key"))), inside
        size, rate = inside.count(), 0.5
    if size:
        raise RuntimeError("the cascade did not end; raise max_levels")
    return Cascade(tuple(levels))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = _rest(url)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def candidate_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """``suffix + path prefix`` for each host suffix at a dot and each rule path length that fits.

    Longest first: by the key's length, then by the suffix's length.
    """
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.array(*[F.lit(n) for n in path_lengths])
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(
        (-(F.length(s) + F.length(p))).alias("by"), (-F.length(s)).alias("then"), F.concat(s, p).alias("key")))))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    ``rules``: (host, path, ``allow`` or ``block``). A rule fits its host and
    all subdomains when the path starts with the rule's; the longest rule
    wins (ties: the longer host). Each verdict's rules are one listed set with a
    cascade over every key that the table's URLs can ask for. Without a
    fitting rule the verdict is ``default``: an unlisted URL. A null URL or one
    without ``://`` has empty host and path. Columns of the input named like
    the added ones are replaced, others may have any names; an empty table gives an empty table.
    """
    spark: SparkSession = pages.sparkSession
    lengths = sorted({len(p) for _, p, _ in rules})
    pages = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url])
    split = pages.select(F.struct(*pages.columns).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    keyed = split.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    # the distinct keys are written once; every level of the cascades then reads them, not the pages
    universe = written(keyed.select(F.explode("keys.key").alias("key")).distinct(), "url-keys")
    cascades = {}
    for n, verdict in enumerate(("block", "allow")):
        listed = spark.createDataFrame([(h + p,) for h, p, v in rules if v == verdict], "key string")
        cascades[verdict] = build_cascade(universe, listed, salt=n + 1)
    found = F.filter(
        F.transform(F.array_sort("keys"), lambda k: F.struct(k["key"].alias("rule"), F.when(cascades["block"].contains(k["key"]), "block").when(cascades["allow"].contains(k["key"]), "allow").alias("verdict"))),
        lambda x: x["verdict"].isNotNull(),
    )
    judged = keyed.select("row", "host", "path", F.get(found, F.lit(0)).alias("found"))
    own = [F.col("row").getField(c).alias(c) for c in pages.columns]
    return judged.select(*own, "host", "path", F.col("found.rule").alias("rule"), F.coalesce(F.col("found.verdict"), F.lit(default)).alias("verdict"))
