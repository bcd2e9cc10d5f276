"""Mixing sources to target weights: repetition rates per source, then whole and drawn copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelake.llm.common import stored, word_count

SEED = 20
MOST_COPIES = 2
BUDGET = 1.5
WEIGHTS = (3.0, 1.0, 2.0)


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """source, source_size: words per source, added up in each task before anything moves."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(word_count(F.col(text))).alias("source_size"))


def cycled_weights(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   folder: str | None = None) -> DataFrame:
    """Adds weight: the given weights in turn over the sources by code point, null last.

    Each range of sources numbers its own rows and starts from the rows of the ranges before it,
    so no task sees all sources.
    """
    # (whether null, name) sorts nulls last; strings compare by their UTF-8 bytes, that is, by
    # code point.
    ranged = stored(
        sizes.repartitionByRange(F.col("source").isNull(), "source")
        .withColumn("part", F.spark_partition_id()), "sources", folder)
    within = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    ranked = ranged.withColumn("rank", F.row_number().over(within) - 1)
    ranges = ranged.groupBy("part").count().orderBy("part").collect()  # one row per partition
    before, total = [], 0
    for row in ranges:
        before.append((row["part"], total))
        total += row["count"]
    starts = sizes.sparkSession.createDataFrame(before, "part int, before long")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    number = F.col("rank") + F.col("before")
    return ranked.join(F.broadcast(starts), "part").select(
        "source", "source_size",
        F.element_at(cycle, (number % len(weights)).cast("int") + 1).alias("weight"))


def targets(weighted: DataFrame, budget: float = BUDGET,
            most: float = MOST_COPIES) -> DataFrame:
    """Adds target and rate: shares of budget * all sizes by weight, each at most `most` times its
    source.

    What a full source cannot take is shared among the others by weight, until none is above. Every
    round is one aggregate with one row of result; a round fills at least one source, and since the
    level rises from round to round, a few rounds do.
    """
    size, weight = F.col("source_size"), F.col("weight")
    cap = most * size
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while total:
        is_full = cap <= level * weight
        row = weighted.agg(
            F.sum(F.when(is_full, cap).otherwise(0.0)).alias("taken"),
            F.sum(F.when(is_full, 0.0).otherwise(weight)).alias("open"),
            F.count(F.when(is_full, 1)).alias("full")).first()
        if row["full"] == full or not row["open"]:
            break
        full, level = row["full"], (budget * total - row["taken"]) / row["open"]
    target = F.least(cap.cast("double"), F.lit(level) * weight)
    return weighted.withColumn("target", target).withColumn(
        "rate", F.when(size > 0, target / size).otherwise(0.0))


def draw(key: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on key, text and seed alone: 52 bits of their checksum."""
    empty = F.lit("")
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), empty), F.lit(":"),
                    F.coalesce(text.cast("string"), empty))
    return F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan_mix(docs: DataFrame, weighted: DataFrame | None = None, budget: float = BUDGET,
             most: float = MOST_COPIES, seed: int = SEED, key: str = "doc_id",
             source: str = "source", text: str = "text",
             folder: str | None = None) -> DataFrame:
    """Every document with how often the mix takes it.

    Columns: document (a struct of all input columns, whatever their names), size, source_size,
    target, copies. A document gets floor(rate) copies of its source and one more with the
    probability of the remaining fraction, drawn from its key and text, so reruns agree and rows
    with equal keys but other texts are drawn apart; rows that repeat in full are drawn alike. Null
    texts have no words, a null source is a source of its own, a null key is drawn by its text. An
    empty table gives an empty result.

    `weighted` (source, source_size, weight; one row per source) is a table of sources: it is joined
    on its name, which Spark broadcasts if it is small, and whose skewed partitions Spark splits.
    """
    if weighted is None:
        weighted = cycled_weights(source_sizes(docs, source, text), folder=folder)
    planned = stored(targets(stored(weighted, "weights", folder), budget, most), "rates", folder)
    rows = docs.select(
        F.struct("*").alias("document"), word_count(F.col(text)).alias("size"),
        F.col(source).alias("mix_source"),
        draw(F.col(key), F.col(text), seed).alias("mix_draw"))
    joined = rows.join(planned.withColumnRenamed("source", "mix_planned"),
                       F.col("mix_source").eqNullSafe(F.col("mix_planned")))
    whole = F.floor("rate")
    extra = (F.col("mix_draw") < F.col("rate") - whole).cast("long")
    return joined.select("document", "size", "source_size", "target",
                         (whole + extra).alias("copies"))


def mix_sources(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: each document as often as `plan_mix` says, with the columns of the input."""
    return plan_mix(docs, **options).where("copies > 0").select(
        "document", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("document.*")
