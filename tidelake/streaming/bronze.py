"""Append validated messages to Bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.deliveries import bronze_ingest
from tidelake.operators.schema_guard import assert_schema
from tidelake.schemas import DELIVERY
from tidelake.streaming.validate import EVERY_BATCH, drained, settings


def bronze_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    ingested_at: Column | None = None,
    table_format: str = "parquet",
    once: bool = True,
) -> StreamingQuery:
    """Start the append; every delivery is kept, replays included, and counted as `bronze`."""
    rows = assert_schema(bronze_ingest(messages, ingested_at), DELIVERY).observe(
        "appended", F.count(F.lit(1)).alias("bronze"))
    writer = (
        rows.writeStream.format(table_format)
        .outputMode("append").option("checkpointLocation", checkpoint)
    )
    with settings(messages.sparkSession, EVERY_BATCH):
        return drained(writer, once).start(path)
