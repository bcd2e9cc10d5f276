"""Context and citations for a table of questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: what a question without evidence gets.
NO_CONTEXT = "Insufficient context to answer the question."


def _evidence(questions: DataFrame, results: DataFrame, *columns: str) -> DataFrame:
    """Each question with its results in rank order, at most the few that reranking keeps."""
    gathered = results.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", *columns))).alias("evidence"))
    return questions.select("query_id").join(gathered, "query_id", "left")


def grounded_context(questions: DataFrame, results: DataFrame) -> DataFrame:
    """Numbered texts per question, or a fixed sentence when nothing was retrieved."""
    lines = F.transform("evidence", lambda e, i: F.concat(
        F.lit("["), (i + 1).cast("string"), F.lit("] "), e["text"]))
    return _evidence(questions, results, "text").select(
        "query_id", F.coalesce(F.array_join(lines, "\n\n"), F.lit(NO_CONTEXT)).alias("context"))


def citations(questions: DataFrame, results: DataFrame) -> DataFrame:
    """Sources behind each context, in the same order; empty when nothing was retrieved."""
    fields = ("document_id", "chunk_id", "source_uri", "title")
    kept = F.transform("evidence", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    none = F.array().cast("array<struct<document_id:string,chunk_id:string,"
                          "source_uri:string,title:string>>")
    return _evidence(questions, results, *fields).select(
        "query_id", F.coalesce(kept, none).alias("citations"))
