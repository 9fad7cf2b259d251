"""Small tables with the awkward rows every operator must stand."""

import random

#: Names that operators might use themselves.
CLASHING = ["_k", "_t", "_text", "_at", "_a", "_chunk", "_keys", "_s", "row", "k", "t", "key", "keys", "digest", "locator", "found", "walk", "rank", "spans", "passes", "pos"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double, kept boolean, host string, n int, data binary, at long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def texts(seed=0, n=40):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 7))) for _ in range(300)]

    def text(k):
        return " ".join(draw.choice(words) + draw.choice(["", "", ".", "!"]) for _ in range(k))

    base = [text(draw.randint(0, 120)) for _ in range(n)]
    long = text(9000)
    near = base[3].split(" ")
    near[len(near) // 2 : len(near) // 2 + 1] = ["changed"]
    passage = text(150)
    return [
        *base, base[0], base[0], base[1], " ".join(near), "", None, " \t\n ", "one", "one", "ONE", "two words", "é" * 50 + " ünï", long,
        base[5] + " " + passage, passage + "\n" + base[6], "a" * 1500, "ha " * 700, "x\x00y\x0bz",
    ]


def documents(spark, tmp_path, rows=None):
    """The rows as a Parquet table with extra columns whose names clash with the operators' own."""
    if rows is None:
        found = texts()
        rows = [(i * 3 + 1, t, "en", f"src{i % 4}" if i % 7 else None) for i, t in enumerate(found)]
        rows += [(None, "null key", "en", "src1"), (None, None, None, None), rows[2], rows[2], (rows[4][0], "other text, same key", "en", "src0")]
    table = [(i, t, a, s, None if t is None else len(t), 5, 0.5, True, "h", 1, b"d", 9, *CLASHING) for i, t, a, s in rows]
    path = str(tmp_path / "documents")
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def empty(spark, tmp_path):
    return documents(spark, tmp_path, [])
