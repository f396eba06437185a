"""Small documents with the awkward cases that every operator must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, id long, h int, n int"


def prose(rnd: random.Random, words: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(words))


def documents(spark):
    """Exact and near copies, shared passages, nulls in every column, empty and
    very long texts, repeated rows, and columns named like the operators' own."""
    rnd = random.Random(11)
    passage, base = prose(rnd, 70), prose(rnd, 160)
    near = base.split(" ")
    near[80] = "changed"
    texts = [base, base, " ".join(near), base.replace(" ", "\t\n", 3), passage, None, "", " \n ", "one two",
             "one two", "ONE two", "aaaa " * 300, "a" * 30000, prose(rnd, 6000), "é ü ß 日本 😀 " * 40]
    texts += [f"{prose(rnd, 30)} {passage} {prose(rnd, 30)}" for _ in range(4)]
    texts += [prose(rnd, 40) for _ in range(25)]
    rows = [(i, t, "en", f"s{i % 4}", 1, "x", 7, 1, 2) for i, t in enumerate(texts)]
    rows += [rows[0], (None, base, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None), (500, prose(rnd, 50), None, None, None, None, 1, 1, 1)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


__all__ = ["documents", "empty", "prose", "values", "SCHEMA"]
