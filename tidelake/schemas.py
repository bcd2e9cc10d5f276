"""Column layouts of every table in the lake.

Fixed values: the layouts, lengths and topic names are the published event contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("occurred_at", T.TimestampType(), False),
    T.StructField("amount", T.DecimalType(16, 2), False),
    T.StructField("currency", T.StringType(), False),
    T.StructField("document_text", T.StringType(), True),
    T.StructField("schema_version", T.StringType(), False),
])

DELIVERY = T.StructType(EVENT.fields + [
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
])

DAILY_METRICS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_day", T.TimestampType()),
    T.StructField("currency", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("total_amount", T.DecimalType(26, 2)),
    T.StructField("average_amount", T.DecimalType(20, 6)),
])

QUARANTINE = T.StructType([
    T.StructField("payload", T.StringType()),
    T.StructField("rejection_reason", T.StringType()),
    T.StructField("source", T.StructType([
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("received_at", T.TimestampType()),
    ])),
    T.StructField("rejected_at", T.TimestampType()),
])

CHUNK = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("document_id", T.StringType()),
    T.StructField("source_uri", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("chunk_number", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

TERMS = T.ArrayType(T.StructType([
    T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())]))

INDEXED_CHUNK = T.StructType(CHUNK.fields + [
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("title_terms", TERMS),
    T.StructField("title_length", T.IntegerType()),
    T.StructField("text_terms", TERMS),
    T.StructField("text_length", T.IntegerType()),
])

RAW_TOPIC = "raw.events"
VALIDATED_TOPIC = "validated.events"
QUARANTINE_TOPIC = "quarantine.events"
