"""Small tables for the operators' edge cases."""

import random

SYLLABLES = ["ka", "lo", "mi", "ren", "sta", "vo", "qui", "tes", "ul", "ba", "ner", "fi"]


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(n, seed):
    return " ".join(words(n, seed))


def edge_docs(spark, extra=()):
    """Null, blank, short and long texts, repeated rows, a null id, and
    columns whose names the operators also use."""
    long = prose(4000, 99)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, prose(120, 1)),
            (7, prose(120, 1)), (8, long), (9, "é" * 300), (None, prose(60, 5)), (6, prose(120, 1)), *extra]
    cols = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, n_words string"
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 0.5, False, "x") for i, t in rows], cols)


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
