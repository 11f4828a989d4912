"""Small tables that hold the awkward cases."""

import random

#: Columns named like those that operators work with.
EXTRA = "digest string, word long, n int, kept string, row string, size string, key string, bands int, expected int"


def docs(spark, rows, clashing=True):
    """A documents table of (doc_id, text, lang, source), with extra columns of clashing names."""
    kinds = "doc_id long, text string, lang string, source string"
    if not clashing:
        return spark.createDataFrame(rows, kinds)
    extra = ("d", 1, 2, "k", "r", "s", "key", 3, 4)
    return spark.createDataFrame([(*row, *extra) for row in rows], f"{kinds}, {EXTRA}")


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward():
    """Nulls in every column, empty and white texts, copies, near copies, repeated rows, one long text."""
    base = words(60, 1)
    near = base.split(" ")
    near[30] = "changed"
    long = words(20_000, 2, 5_000)
    return [
        (1, base, "en", "a"),
        (2, base.replace(" ", "  "), "en", "a"),
        (3, " ".join(near), "en", "b"),
        (4, None, "en", "b"),
        (5, "", None, None),
        (6, " \t\n", "de", None),
        (7, long, "de", "a"),
        (8, long, "de", "c"),
        (9, words(40, 3), "en", "c"),
        (9, words(40, 3), "en", "c"),
        (10, "x", "en", "c"),
        (11, "x", "en", "c"),
        (None, words(30, 4), None, "a"),
        (None, words(30, 4), None, "a"),
        (12, "\U0001f600 é   漢字", "fr", "d"),
        (13, words(30, 4), "en", "d"),
    ]
