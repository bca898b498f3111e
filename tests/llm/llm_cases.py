"""Rows that every operator must cope with, and small helpers."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # names that the operators use themselves
    "kept string, score string, size bigint, text_sha256 string, bits bigint, at string, word string, row string, _id string"
)
SYLLABLES = "an be co du el fi go ha in ja ko lu mi no op ra si tu ve wo".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source): nulls anywhere, empty and very long texts, ties, repeated rows."""
    base = prose(1, 120)
    return [
        (1, base, "en", "a"),
        (2, base.upper(), "en", "a"),
        (3, base, None, None),
        (4, None, "en", "b"),
        (5, "", "en", "b"),
        (6, " \t\n\x0b\x0c\r ", "de", None),
        (7, "one", "en", "c"),
        (8, prose(2, 30_000), "en", "c"),
        (9, base + " " + prose(3, 40), "en", "d"),
        (10, "ÄÖÜ é     日本語 😀 ! ! !", "fr", "é"),
        (11, "same row", "en", "a"),
        (11, "same row", "en", "a"),
        (None, base, "en", "a"),
        (None, "nobody", None, None),
        (12, prose(4, 25) + "\n" + prose(4, 25) + "\n" + prose(5, 10), "en", "b"),
        (13, "<|endoftext|> and <p>markup</p>  &amp; 123 456", "en", "b"),
        (14, "!!! ??? 12", "en", "b"),
    ]


def frame(spark, rows=None):
    rows = edge_rows() if rows is None else rows
    filler = ("x", "y", 5, "z", 6, "q", "w", "r", "i")
    return spark.createDataFrame([(i, t, g, s, None, *filler) for i, t, g, s in rows], SCHEMA)


def listed(df, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
