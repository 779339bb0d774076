"""Rows with nulls, empty and long texts, ties, repeats, and columns that clash."""

import random

CLASHING = """doc_id long, text string, lang string, key long, part string, place int, term string,
    suspect boolean, language string, n long, ids binary"""

ODD_TEXTS = [
    (1, "a b"),
    (2, "ab"),
    (3, "a  b"),
    (3, "a  b"),
    (4, None),
    (5, ""),
    (6, "x"),
    (7, "\t\n"),
    (8, " é"),
    (9, "é"),
    (None, "a  b"),
    (None, None),
]


def documents(spark, rows, partitions=3):
    """A table of documents whose other columns carry names that operators use themselves."""
    full = [(i, t, "en", 7, "p", 1, "t", True, "l", 2, b"x") for i, t in rows]
    return spark.createDataFrame(full, CLASHING).repartition(partitions)


def prose(seed, n, vocabulary=200):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def edited(text, seed, edits):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)
