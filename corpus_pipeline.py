"""From documents to packed training sequences, in five stages over everything kept so far.

Each stage is a function of (spark, docs, sf_dir); its result is written, and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidelake.llm import dart_dedup, mixing, packing, secrets, weak_quality
from tidelake.llm.common import stored
from tidelake.llm.queries import table, vocabulary
from tidelake.session import settings, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Whole texts that go to a Python worker at once. Buffers for them are kept by the executor and by its
# workers, beside everything that the stages need.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def in_small_batches(stage: Stage) -> Stage:
    """The stage with BATCH set in its session, and left so: its result is planned when it is written,
    after the stage has returned. `run` restores what was set before."""
    @wraps(stage)
    def with_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCH.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return with_batches


@in_small_batches
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier keeps."""
    return weak_quality.good_documents(docs)


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return dart_dedup.one_per_class(docs)


@in_small_batches
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.mask_secrets(docs)


@in_small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix_sources(docs)


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mix", mix),
    ("pack", pack),
]

# EM, dart signatures and trained networks have no SQL; tests/llm/test_pipeline.py checks what each
# stage must and must not do, and the operators' own tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    with settings(spark, BATCH):
        for number, (name, stage) in enumerate(STAGES):
            docs = stored(stage(spark, docs, sf_dir), f"{number}-{name}", folder)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
