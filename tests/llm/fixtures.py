"""Small tables with the odd rows that every operator promises to take."""

from __future__ import annotations

import random

from checks.compare import rows_of

# Extra columns carry names that the operators use inside or return.
DOC_SCHEMA = """doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, bits BIGINT, key STRING, row BIGINT, score DOUBLE,
  ids STRING, found STRING, simhash_row STRING, language STRING, lang_pred STRING, component STRING, words STRING"""
EXTRA = (7, "k", 9, 0.25, "i", "f", "r", "l", "p", "c", "w")


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "der", "und"] + ["".join(rng.choice("aeioustrn") for _ in range(6))]) for _ in range(n))


def doc(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


BASE = words(1, 80)
ROWS = [
    doc(0, BASE),
    doc(1, BASE),  # exact copy
    doc(2, BASE + " tail"),  # near copy
    doc(3, None),
    doc(4, ""),
    doc(5, " \t\n "),
    doc(6, words(2, 60), None, None),
    doc(7, "Größe " + words(3, 50) + " école", "de"),
    doc(7, "Größe " + words(3, 50) + " école", "de"),  # repeated row
    doc(None, words(4, 40)),
    doc(8, "x"),
    doc(9, "two words", "fr", None),
    doc(10, words(5, 30_000)),  # very long
    doc(-3, words(6, 100), "de", "s2"),
    doc(11, "\x00 odd   \U0001f600 text", "es"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOC_SCHEMA)


def collected(df):
    return rows_of(df.columns, df.collect())
