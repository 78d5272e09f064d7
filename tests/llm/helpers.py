"""Small tables with everything that goes wrong: nulls, ties, repeats, long texts, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["size", "kept", "row", "start", "value", "edge", "copies", "rule", "score", "_id", "part", "place"]


def awkward_rows(seed=1, n=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rnd.choice(["alpha", "Beta", "gamma,", "the", "of", "ÉTÉ", "x1"]) for _ in range(rnd.randint(0, 40))]
        text = rnd.choice([" ", "\n", "\t "]).join(words)
        rows.append((i, text, rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "ü", None]), len(text)))
    rows += [
        (None, None, None, None, None), (None, "lost words", "en", "a", 3), (n, "", "en", "a", 0), (n + 1, None, "en", None, None),
        (n + 2, " \n\t ", "de", "b", 4), (n + 3, "long " * 30_000, "en", "a", 1), (5, rows[5][1], "en", "b", 1),
        rows[7], rows[7], (n + 4, "token = \"abcdefghijklmnop\"  日本語 😀 <|endoftext|>", "ja", "b", 9),
    ]
    return rows


def table(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)


def clashing(spark, rows=None):
    """The same rows with further columns under names that the operators use inside."""
    from pyspark.sql import functions as F

    return table(spark, rows).select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])


def words(text):
    return (text or "").encode().split()


def same(left, right):
    return sorted(map(repr, left)) == sorted(map(repr, right))
