"""N-gram Jaccard join by grouped prefixes, to connected classes of near copies.

1. Documents whose sampled shingles are too often their own (held by no other
   document) can't have a partner and leave. The rest fall into classes of equal
   shingle sets.
2. A class's prefix are its rarest shingles, just as many that two linked classes share
   one. Classes with one prefix and size form a group.
3. Group pairs that share a prefix shingle pass the size and the position filter,
   are expanded to their members, which pass the parity bitmaps' filter and are verified
   on whole shingle sets. First every group meets its likeliest partners, and linked
   groups merge; then all pairs that are left between different components are verified,
   so no link between components is lost, while a large group of near copies never meets
   itself pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mapped, written
from tessera.llm.components import components
from tessera.llm.counting import count_and_finish
from tessera.llm.hashing import CHUNK, LOWER, grams, mix, words

#: Shingle length in words, and the threshold in percent.
WORDS, PERCENT = 5, 80
#: Of 8 shingles, those counted over the corpus in the first step.
SAMPLED = 3
#: Rounds in which groups meet single partners before all remaining pairs are verified.
ROUNDS = 3


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; with fewer words one for the whole sequence; without, none."""
    found: list[np.ndarray] = []
    row, n = 0, len(offsets) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        hashes, at = words(LOWER[data[offsets[row] : offsets[to]]], offsets[row : to + 1] - offsets[row])
        whole = grams(hashes, size)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            own = whole[a : b - size + 1] if b - a >= size else grams(hashes[a:b], b - a) if b > a else whole[:0]
            found.append(np.unique(own))
        row = to
    return found


def spare(n: np.ndarray | int, percent: int):
    """Most shingles of a set of n that a linked set may lack: n - ceil(n * percent / 100)."""
    return n - -(-n * percent // 100)


def _sampled(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(5)) % np.uint64(8) < SAMPLED


def possible_rows(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """``id``, ``n``, ``sig`` and ``data`` of every row; sig and data only where the row may have a partner.

    ``data`` holds the sorted shingle hashes; within a block only the first of equal
    sets keeps them.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("data"))

    def keys_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        sets = shingle_sets(data, offsets, size)
        every = np.concatenate(sets or [np.zeros(0, np.uint64)])
        return [every[_sampled(every)]]

    def finish(ids: list, data: np.ndarray, offsets: np.ndarray, tables: list) -> list[list]:
        own, totals = tables[0]
        alone = own[totals == 1]
        sigs, kept, sizes, seen = [], [], [], set()
        for shingles in shingle_sets(data, offsets, size):
            n = len(shingles)
            mine = shingles[_sampled(shingles)]
            at = np.searchsorted(alone, mine)
            lonely = int((alone[np.minimum(at, len(alone) - 1)] == mine).sum()) if len(alone) and len(mine) else 0
            sizes.append(n)
            if not n or lonely > spare(n, percent):
                sigs.append(None), kept.append(None)
                continue
            with np.errstate(over="ignore"):
                sig = np.array([mix(shingles).sum(), mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(n)], np.uint64).tobytes()
            sigs.append(sig)
            kept.append(None if sig in seen else shingles.tobytes())
            seen.add(sig)
        return [ids, sizes, sigs, kept]

    return count_and_finish(rows, keys_of, finish, "id long, n long, sig binary, data binary", [pa.int64(), pa.int64(), pa.binary(), pa.binary()])


#: Bits of a set's parity bitmap: each shingle flips one bit, so two sets differ in at least the bits that differ.
BITS = 256


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    odd = np.bincount((shingles >> np.uint64(7)).astype(np.int64) % BITS, minlength=BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """``sig``, ``n``, ``lead``, ``tokens`` and ``bits`` of every class that shares a prefix shingle with another.

    The order is by the number of classes that hold a shingle, then by hash. ``lead``
    counts the set's shingles that no other class holds, which come first; ``tokens``
    are the prefix's others; ``bits`` is the parity bitmap.
    """
    rows = classes.select(F.lit(0).cast("long").alias("id"), F.concat("sig", "data").alias("data"))

    def sets_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return [data[a + 16 : b].view(np.uint64) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]

    def keys_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return [np.concatenate(sets_of(data, offsets) or [np.zeros(0, np.uint64)])]

    def finish(ids: list, data: np.ndarray, offsets: np.ndarray, tables: list) -> list[list]:
        own, totals = tables[0]
        out: list[list] = [[], [], [], [], []]
        for i, shingles in enumerate(sets_of(data, offsets)):
            n = len(shingles)
            often = totals[np.searchsorted(own, shingles)]
            first = np.lexsort((shingles, often))[: spare(n, percent) + 1]
            lead = int((often == 1).sum())
            if lead < len(first):
                row = data[offsets[i] : offsets[i] + 16].tobytes(), n, lead, shingles[first[lead:]].view(np.int64), parity_bits(shingles)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        return out

    longs = pa.list_(pa.int64())
    return count_and_finish(rows, keys_of, finish, "sig binary, n long, lead long, tokens array<bigint>, bits array<bigint>", [pa.binary(), pa.int64(), pa.int64(), longs, longs])


def verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``: class signatures) whose whole shingle sets reach the threshold."""
    left = classes.select(F.col("sig").alias("a"), F.col("data").alias("x"))
    right = classes.select(F.col("sig").alias("b"), F.col("data").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            part = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            yield part

    return mapped(pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y"), run, "a binary, b binary")


def _needed(n: Column, m: Column, percent: int) -> Column:
    """Fewest common shingles of linked sets of n and m."""
    return F.ceil(percent * (n + m) / (100 + percent) - F.lit(1e-6))


def _differ(a: str, b: str) -> Column:
    """Bits that differ between two parity bitmaps (columns with prefix a and b)."""
    return sum((F.bit_count(F.col(f"{a}bits{i}").bitwiseXOR(F.col(f"{b}bits{i}"))) for i in range(1, BITS // 64)), F.bit_count(F.col(a + "bits0").bitwiseXOR(F.col(b + "bits0"))))


def _bits_may_link(a: str, b: str, percent: int) -> Column:
    """Whether two sets' own parity bitmaps (columns with prefix a and b) let them link."""
    n, m = F.col(a + "n"), F.col(b + "n")
    return _differ(a, b) <= n + m - 2 * _needed(n, m, percent)


def _posts_may_link(a: str, b: str, percent: int) -> Column:
    """Whether two posts of one shingle (columns with prefix a and b) can belong to linked sets.

    Size filter, and position filter over the shared shingles, of which ``k`` come before
    this one and ``shared`` - ``k`` - 1 after it. Both read only what all members of
    a group have in common, so they hold for a group as for its head.
    """

    def of(x: str, name: str) -> Column:
        return F.col(x + name)

    n, m = of(a, "n"), of(b, "n")
    most = F.least(of(a, "k"), of(b, "k")) + 1 + F.least(of(a, "shared") - of(a, "k"), of(b, "shared") - of(b, "k")) - 1
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (most >= _needed(n, m, percent))


def _groups_may_link(a: str, b: str, percent: int) -> Column:
    """Whether any members of two entities can link, by their heads' bitmaps.

    ``radius`` is the most bits in which a member differs from its head, so two members
    differ in no fewer bits than their heads do, less both radii.
    """
    n, m = F.col(a + "n"), F.col(b + "n")
    return _posts_may_link(a, b, percent) & (_differ(a, b) - F.col(a + "radius") - F.col(b + "radius") <= n + m - 2 * _needed(n, m, percent))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (``e``, ``label``) after the links (``a``, ``b``) between their entities."""
    one = labels.select(F.col("e").alias("a"), F.col("label").alias("la"))
    two = labels.select(F.col("e").alias("b"), F.col("label").alias("lb"))
    edges = links.join(one, "a").join(two, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a != b")
    roots = components(edges)
    return written(labels.join(roots, F.col("label") == F.col("node"), "left").select("e", F.coalesce("root", "label").alias("label")), "entity-labels")


def _open_posts(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Posts with their labels, of the shingles whose posts have more than one; the others can't link anything new."""
    listed = posts.join(labels, "e")
    several = listed.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("token")
    return written(listed.join(several, "token"), "open-posts")


def link_classes(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``sig`` and ``label`` of every class that has a candidate; classes of one component share their label."""
    found = written(prefixes(classes, percent).withColumn("gid", F.xxhash64("n", "lead", "tokens")), "prefixes")
    heads = found.groupBy("gid").agg(F.min("sig").alias("head"), F.count("*").alias("c")).where("c > 1").select("gid", "head")
    inside = found.join(heads, "gid").where("sig != head").select(F.col("head").alias("a"), F.col("sig").alias("b"))
    joined = written(verified(inside, classes, percent), "group-links").select(F.col("b").alias("sig"), F.col("a").alias("head"))
    # an entity is a group's head with the members linked to it; a member that isn't stands for itself
    bits = [f"bits{i}" for i in range(BITS // 64)]
    own_bits = [F.col("bits")[i].alias(name) for i, name in enumerate(bits)]
    members = written(found.join(joined, "sig", "left").select("sig", F.coalesce("head", "sig").alias("e"), "n", *own_bits), "members")
    heads_only = members.where("sig = e").select("e")
    centres = members.where("sig = e").select("e", *[F.col(c).alias("head_" + c) for c in bits])
    radii = members.where("sig != e").join(centres, "e").groupBy("e").agg(F.max(_differ("", "head_")).alias("radius"))
    known = ["n", "k", "shared", *bits]
    posts = written(
        found.join(heads_only, F.col("sig") == F.col("e"))
        .select("e", "n", (F.col("n") - F.col("lead")).alias("shared"), *own_bits, F.posexplode("tokens").alias("k", "token"))
        .select("token", "e", *known),
        "posts",
    )
    labels = written(heads_only.select("e", F.col("e").alias("label")), "entity-labels")
    tested = None
    for turn in range(ROUNDS):
        listed = _open_posts(posts, labels)
        posts = listed.drop("label")
        # a list's partners: the head with the fewest own shingles, that of its largest component, and a random one
        chosen = F.struct((F.col("n") - F.col("shared")).alias("own"), F.xxhash64("e", F.lit(turn)).alias("h"), "e", "label", *known)
        by_label = listed.groupBy("token", "label").agg(F.count("*").alias("c"), F.min(chosen).alias("rep"))
        reps = [F.min("rep").alias("best"), F.max(F.struct("c", "rep")).alias("big"), F.min(F.struct(F.xxhash64("label", F.lit(turn)), "rep")).alias("other")]
        lists = by_label.groupBy("token").agg(*reps, F.count("*").alias("kinds")).where("kinds > 1")
        lists = lists.select("token", F.array_distinct(F.array("best", "big.rep", "other.rep")).alias("reps"))
        met = listed.join(lists, "token").select("e", "label", *known, F.explode("reps").alias("r"))
        met = met.where((F.col("label") != F.col("r.label")) & _posts_may_link("", "r.", percent) & _bits_may_link("", "r.", percent))
        votes = met.groupBy(F.least("e", "r.e").alias("a"), F.greatest("e", "r.e").alias("b"), "e").agg(F.count("*").alias("c"))
        if tested is not None:
            votes = votes.join(tested, ["a", "b"], "left_anti")
        best = votes.groupBy("e").agg(F.max(F.struct("c", "a", "b")).alias("best")).select("best.a", "best.b").distinct()
        best = written(best, "meetings")
        tested = best if tested is None else tested.union(best)
        links = written(verified(best, classes, percent), "links")
        if links.isEmpty():
            break
        labels = _merged(labels, links)
    open_ = _open_posts(posts, labels).join(radii, "e", "left").withColumn("radius", F.coalesce("radius", F.lit(0)))
    left, right = (open_.toDF(*[side + c if c != "token" else c for c in open_.columns]) for side in ("left_", "right_"))
    rest = left.join(right, "token").where((F.col("left_label") < F.col("right_label")) & _groups_may_link("left_", "right_", percent))
    rest = rest.select(F.least("left_e", "right_e").alias("a"), F.greatest("left_e", "right_e").alias("b")).distinct()
    one, two = (members.toDF("m" + side, side, *[f"{side}_{c}" for c in ("n", *bits)]) for side in ("a", "b"))
    expanded = rest.join(one, "a").join(two, "b").where(_bits_may_link("a_", "b_", percent)).select("ma", "mb")
    done = tested.select(F.col("a").alias("ma"), F.col("b").alias("mb")) if tested is not None else None
    expanded = expanded if done is None else expanded.join(done, ["ma", "mb"], "left_anti").join(done.toDF("mb", "ma"), ["ma", "mb"], "left_anti")
    pairs = expanded.select(F.col("ma").alias("a"), F.col("mb").alias("b"))
    links = written(verified(pairs, classes, percent), "links")
    if not links.isEmpty():
        of = members.select(F.col("sig"), "e")
        lifted = links.join(of.toDF("a", "ea"), "a").join(of.toDF("b", "eb"), "b").select(F.col("ea").alias("a"), F.col("eb").alias("b"))
        labels = _merged(labels, lifted)
    return members.join(labels, "e").select("sig", "label")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Key, ``n_shingles`` and ``component_id`` of every row.

    A-Z are lower-cased, words are runs without white space, a document's set are its
    distinct ``size``-word shingles (with fewer words its whole sequence; none for a
    null or empty text, which links with nothing). Two rows link when their
    sets' Jaccard similarity is at least ``percent`` / 100; ``component_id`` is the smallest
    key that links lead to. Null keys are passed over as smallest keys. Repeated rows are equal sets
    and so one component; an empty table gives an empty table. Other columns are not read.
    Keys are whole numbers (see ``one_of_each`` for others). ``docs`` must list its rows in the same order each time it is read, as files do.
    """
    rows = written(possible_rows(docs, key, text, size, percent), "shingles")
    some = rows.where("sig is not null")
    classes = written(some.groupBy("sig").agg(F.first("n").alias("n"), F.max("data").alias("data")), "classes")
    labels = link_classes(classes, percent)
    placed = some.select("id", "n", "sig").join(labels, "sig", "left").select("id", "n", F.coalesce("label", "sig").alias("part"))
    least = written(placed.groupBy("part").agg(F.min("id").alias("component_id")), "components")  # a table of its own, so Spark may split a hot part
    joined = placed.join(least, "part").select("id", "n", "component_id")
    every = rows.where("sig is null").select("id", "n", F.col("id").alias("component_id")).unionByName(joined)
    return every.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with the columns of ``docs``; rows without words all stay.

    The row with the smallest key stays (null keys lose; of rows with the same key the
    first). ``docs`` must list its rows in the same order each time it is read, as files
    do; the job fails if it does not.
    """
    located = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("at"))
    found = near_copies(located, "at", "t", size, percent).select("at", "component_id")
    least = F.min(F.struct(F.col("k").isNull().alias("last"), "k", "at")).alias("one")
    kept = found.join(located.select("at", "k"), "at").groupBy("component_id").agg(least).select("one.at", F.col("one.k").alias("was"))
    same = F.when(F.col("k").eqNullSafe(F.col("was")), True).otherwise(F.raise_error(F.lit("docs changed its order between two reads")).cast("boolean"))
    return located.join(kept, "at").where(same).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
