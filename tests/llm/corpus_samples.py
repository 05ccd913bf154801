"""Small tables with everything an operator must survive, and plain versions of the operators."""

from __future__ import annotations

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("fp", "size", "shard", "slot", "_kept", "kept", "cell", "root", "words", "start",
            "taken", "doc", "phrase", "row_key", "_group", "target", "lines", "pair", "content")


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, copies, near copies, repeated rows, a very
    long text, characters of several bytes."""
    base, shared = prose(1, 300), prose(2, 120)
    near = base.split(" ")
    near[150] = "changed"
    rows = [
        (1, base, "en", "a", 10), (2, base, "en", "a", 10), (3, " ".join(near), "en", "b", 10),
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \t\n ", "de", None, 3),
        (None, base, None, "b", 1), (None, None, None, None, None),
        (7, prose(3, 50) + "\n" + shared + " " + prose(4, 40), "en", "c", 5),
        (8, prose(5, 60) + " " + shared + "\t" + prose(6, 70), "fr", "c", 5),
        (9, "word", "en", "a", 4), (10, "Ünï " * 60, "de", "b", 240),
        (11, prose(7, 6000), "en", "a", 9), (11, prose(7, 6000), "en", "a", 9),
        (12, "a " * 500, "en", "a", 1000), (13, "x" * 2000, "en", "a", 2000),
        (14, "# $ % & " * 20, "en", "a", 160), (0, prose(8, 12), "en", "a", 50),
    ]
    rows += [(20 + i, prose(100 + i, 40 + 5 * i), "en", "abc"[i % 3], i) for i in range(40)]
    return rows


def frame(spark, rows, schema: str = DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


def clashing(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])
