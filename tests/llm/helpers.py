"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASH = ("_id", "_text", "_row", "score", "keep_id", "bucket", "text_sha256", "_n", "_key")


def words(rng: random.Random, n: int, vocab: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def edge_rows(seed: int = 1) -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows, copies."""
    rng = random.Random(seed)
    a, b = words(rng, 120), words(rng, 300)
    long = words(rng, 20_000)
    rows = [(1, a, "en", "s1", 5), (2, a, "en", "s2", 5), (2, a, "en", "s2", 5), (3, b, None, None, None),
            (4, None, "en", "s1", None), (5, "", "en", "s1", 0), (6, "  \n\t ", "de", "s1", 4), (None, b, "en", "s3", 1),
            (None, None, None, None, None), (7, long, "en", "s1", 9), (8, long + " tail", "en", "s4", 9),
            (9, "é ü 漢字   x", "fr", "s5", 3), (10, "one", "en", "s1", 3), (11, "one", "en", "s6", 3),
            (12, "aaaa " * 400, "en", "s1", 1), (13, a.upper(), "en", "s1", 2)]
    rows += [(100 + k, words(rng, rng.randrange(1, 150)), "en", f"s{k % 7}", k) for k in range(60)]
    return rows


def docs_of(spark, rows: list[tuple], clash: bool = False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({c: F.lit("x") for c in CLASH}) if clash else df
