"""Quality rules whose cutoffs come from the data: quantile sketches per language and source.

DataFrame functions only. Measures are taken in one pass without a shuffle and written, one narrow
row per document; sketches, fences and verdicts then work on those rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import SPACES, stored

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent
# Rows a group needs for fences of its own; a smaller one takes those of its language, a language
# with fewer those of the whole table. Both come from merging the sketches of the groups.
LEAST_ROWS = 100
SKETCH_K = 1024
# Measure, which sides have a fence, and the least distance between quartiles that is assumed, so
# that a group of equal documents doesn't reject the first one that differs a little.
RULES = (
    ("symbol_ratio", "upper", 0.05),
    ("word_length", "both", 0.5),
    ("repeat_ratio", "upper", 0.15),
    ("dup_line_ratio", "upper", 0.2),
    ("capital_ratio", "upper", 0.03),
)
REACH = 3.0  # quartile distances from the quartile to the fence
STEP = 64  # fences are rounded outwards to 1 / STEP: sketches are random in their last digits


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _placed(windows: Column) -> Column:
    """The windows' hashes with their positions, sorted."""
    return F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _repeated(placed: Column) -> Column:
    """Words that lie in windows of three found twice or more.

    `placed` must be a column, not an expression: it is looked up at every position. Windows equal
    to a neighbour are put back in order, and each adds the words after the one before it, three at
    most.
    """
    again = F.filter(
        placed, lambda p, k: ((k > 0) & (p["h"] == F.get(placed, k - 1)["h"]))
        | F.coalesce(p["h"] == F.get(placed, k + 1)["h"], F.lit(False)))
    return _covered(F.sort_array(F.transform(again, lambda p: p["i"])))


def _covered(positions: Column) -> Column:
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        positions, start,
        lambda a, i: F.struct(i.alias("last"),
                              (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"])


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: the kept columns, lang, source and its measures. Map-only.

    A null text has no words and no lines.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        *[F.col(c) for c in keep], F.col(lang).alias("q_lang"), F.col(source).alias("q_source"),
        body.alias("q_text"),
        F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("q_words"),
        F.filter(F.split(body, "\n"), lambda x: _without(x, SPACES) > 0).alias("q_lines"))
    # Hash the windows once per document; a window's hash chains the hashes of its words.
    windows = F.transform(
        F.slice("q_words", F.lit(1), F.greatest(F.size("q_words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("q_words", i + 1), F.get("q_words", i + 2)))
    rows = rows.select("*", windows.alias("q_windows"))
    # Most documents repeat no window; only the others are sorted.
    rows = rows.select("*", F.when(
        F.size(F.array_distinct("q_windows")) < F.size("q_windows"), _placed(F.col("q_windows")))
        .alias("q_placed"))
    repeats = F.when(F.col("q_placed").isNull(), F.lit(0).cast("long")).otherwise(
        _repeated(F.col("q_placed")))
    long = "long"
    counted = rows.select(
        *[F.col(c) for c in keep], F.col("q_lang").alias("lang"), F.col("q_source").alias("source"),
        F.size("q_words").cast(long).alias("n_words"),
        _without(F.col("q_text"), SPACES).cast(long).alias("word_chars"),
        (F.length("q_text") - _without(F.col("q_text"), SYMBOLS)).cast(long).alias("n_symbols"),
        F.size("q_lines").cast(long).alias("n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast(long).alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        (F.length("q_text") - _without(F.col("q_text"), CAPITALS)).cast(long).alias("n_capitals"))
    return counted


def ratios() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {"symbol_ratio": share("n_symbols", "n_words"),
            "word_length": share("word_chars", "n_words"),
            "repeat_ratio": share("n_repeat_words", "n_words"),
            "dup_line_ratio": share("n_dup_lines", "n_lines"),
            "capital_ratio": share("n_capitals", "word_chars")}


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def fences(measured: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """lang, source, <rule>_low, <rule>_high for every group; the sketches decide, not the rows.

    Documents that fail the base rules don't shape the cutoffs. Each task sketches its own rows; a
    hot source sends one sketch per task.
    """
    sound = measured.where(~base_failed()).select("lang", "source", *[
        c.alias(n) for n, c in ratios().items()])
    own = sound.groupBy("lang", "source").agg(F.count("*").alias("n"), *[
        F.kll_sketch_agg_double(n, F.lit(SKETCH_K)).alias(n) for n, _, _ in RULES])
    merged = [F.sum("n").alias("n"), *[
        F.kll_merge_agg_double(n, F.lit(SKETCH_K)).alias(n) for n, _, _ in RULES]]
    by_lang = own.groupBy("lang").agg(*merged)
    total = by_lang.agg(*merged)

    def named(frame: DataFrame, prefix: str) -> DataFrame:
        return frame.select(*[
            F.col(c).alias(c if c == "source" else f"{prefix}_{c}") for c in frame.columns])

    # One row per group, language and table: the lookups below stay small tables.
    groups = measured.select("lang", "source").distinct()
    joined = groups.join(named(own, "o").withColumnRenamed("source", "o_source"),
                         F.col("lang").eqNullSafe(F.col("o_lang"))
                         & F.col("source").eqNullSafe(F.col("o_source")), "left")
    joined = joined.join(named(by_lang, "l"), F.col("lang").eqNullSafe(F.col("l_lang")), "left")
    joined = joined.join(F.broadcast(named(total, "t")), F.lit(True), "left")  # one row
    out = [F.col("lang"), F.col("source")]
    for name, side, slack in RULES:
        sketch = (F.when(F.col("o_n") >= least_rows, F.col(f"o_{name}"))
                  .when(F.col("l_n") >= least_rows, F.col(f"l_{name}"))
                  .otherwise(F.col(f"t_{name}")))
        low = F.kll_sketch_get_quantile_double(sketch, F.lit(0.25))
        high = F.kll_sketch_get_quantile_double(sketch, F.lit(0.75))
        reach = REACH * F.greatest(high - low, F.lit(slack))
        out.append(F.when(F.lit(side == "both"), F.floor((low - reach) * STEP) / STEP)
                   .alias(f"{name}_low"))
        out.append((F.ceil((high + reach) * STEP) / STEP).alias(f"{name}_high"))
    return joined.select(*out)


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          lang: str = "lang", source: str = "source", folder: str | None = None,
          least_rows: int = LEAST_ROWS) -> DataFrame:
    """Measures, base_failed, broken (rules of its group that it breaks) and kept per document.

    A document is kept if it passes the base rules and lies within the fences of its language and
    source; if no document passes the base rules there are no fences and none is kept. Null
    languages and sources are groups of their own; rows that repeat are judged alike; an empty table
    gives an empty result; columns not named are ignored.
    """
    measured = stored(measure(docs, text, keep, lang, source), "measures", folder)
    limits = fences(measured, least_rows)
    limits = limits.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *[
        c for c in limits.columns if c not in ("lang", "source")])
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("f_lang"))
                           & F.col("source").eqNullSafe(F.col("f_source")), "left")
    value = ratios()
    checks = {}
    for name, side, _ in RULES:
        outside = value[name] > F.col(f"{name}_high")
        if side == "both":
            outside = outside | (value[name] < F.col(f"{name}_low"))
        checks[name] = F.coalesce(outside, F.lit(False))
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    fails = reduce(or_, checks.values())
    return joined.select(
        *keep, "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", base_failed().alias("base_failed"), broken.alias("broken"),
        (~base_failed() & ~fails).alias("kept"))
