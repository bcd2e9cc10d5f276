"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Extra columns whose names operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, node long, size long, "
          "document string, band string, component long, part int, kept string")
EXTRA = (7, 7, "x", "y", 8, 9, "z")


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    parts = ["ka", "lo", "mir", "ten", "su", "vel", "or", "ani", "du", "pre", "stu", "gi"]
    out = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("." if n % 9 == 8 else "") for n, w in enumerate(out))


def rows() -> list[tuple]:
    """Documents: null, empty and blank texts, null keys, languages and sources, repeated rows, equal
    keys with other texts, copies, near copies, one very long text, letters beyond the first plane."""
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    found: list[tuple] = [
        (1, base, "en", "a"), (2, base, "en", "b"), (3, near, "en", "a"), (4, None, "en", "a"),
        (5, "", "de", "b"), (6, " \n\t ", None, None), (7, "one", "en", None),
        (8, "two words", None, "a"), (9, prose(2, 30_000), "en", "a"), (10, prose(3, 200), "fr", "c"),
        (10, prose(4, 90), "fr", "c"), (None, prose(5, 80), "en", "a"),
        (None, prose(6, 70), "en", "a"), (None, None, None, None),
        (11, "\U0001f600 née  straße x\n\nline\nline", "de", "b"),
        (12, "x" * 5_000, "en", "b"), (13, "<|endoftext|> a <|endoftext|>", "en", "b"),
        (1, base, "en", "a")]
    found += [(100 + n, prose(200 + n, 60 + n), "en", "hot") for n in range(40)]
    return [(*r, None if r[1] is None else len(r[1]), *EXTRA) for r in found]


def documents(spark: SparkSession, empty: bool = False) -> DataFrame:
    return spark.createDataFrame([] if empty else rows(), SCHEMA).repartition(3)
