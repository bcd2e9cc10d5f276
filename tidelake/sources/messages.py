"""Messages in and out: raw JSON, validated events and quarantined payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.validation import quarantine_fields, rejected_events, valid_events
from tidelake.schemas import EVENT, MESSAGE, QUARANTINE_TOPIC, VALIDATED_TOPIC


def read_json_events(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON-array files as JSON text, with file name and position in the file."""
    parsed = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("batch"), F.parse_json("value").alias("content"))
    items = F.try_variant_get("content", "$", "array<variant>")
    objects = F.transform(items, lambda item: F.try_variant_get(
        item, "$", "map<string,variant>").isNotNull())
    sound = items.isNotNull() & F.forall(objects, lambda ok: ok)
    records = F.when(sound, items).otherwise(
        F.raise_error(F.lit("file must contain a JSON array of objects")))
    return parsed.select("batch", F.posexplode(records).alias("position", "record")).select(
        "batch", "position", F.to_json("record").alias("value"))


def read_event_stream(
    spark: SparkSession, source_format: str = "kafka", path: str | None = None, **options: str,
) -> DataFrame:
    """Messages from a broker or from files that carry the same columns.

    A broker is read from the earliest offset and tolerates expired data; both can be overridden.
    """
    reader = spark.readStream.format(source_format)
    if source_format == "kafka":
        settings = {"startingOffsets": "earliest", "failOnDataLoss": "false", **options}
        return reader.options(**settings).load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", "timestamp")
    return reader.schema(MESSAGE).options(**options).load(path)


def iso_utc(instant: Column) -> Column:
    """ISO text ending in Z, with microseconds only where there are any; needs a UTC session."""
    micros = F.date_format(instant, "SSSSSS")
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
                    F.lit("Z"))


def _event_json() -> Column:
    fields = [F.col(f"event.{f.name}") for f in EVENT.fields]
    fields[EVENT.names.index("occurred_at")] = iso_utc(F.col("event.occurred_at")).alias(
        "occurred_at")
    fields[EVENT.names.index("amount")] = F.col("event.amount").cast("string").alias("amount")
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _quarantine_json(rejected_at: Column | None) -> Column:
    source = F.struct("topic", "partition", "offset",
                      iso_utc(F.col("timestamp")).alias("received_at"))
    payload, reason, _, rejected = quarantine_fields(rejected_at)
    return F.to_json(F.struct(payload, reason, source.alias("source"),
                              iso_utc(rejected).alias("rejected_at")))


def _source_key() -> Column:
    return F.concat_ws(":", "topic", "partition", "offset")


def validated_sink(validated: DataFrame, topic: str = VALIDATED_TOPIC) -> DataFrame:
    """Valid events as messages keyed by event ID; source coordinates stay with them."""
    return valid_events(validated).select(
        F.col("event.event_id").alias("key"), _event_json().alias("value"),
        F.lit(topic).alias("topic"), "partition", "offset", "timestamp")


def quarantine_sink(
    validated: DataFrame, rejected_at: Column | None = None, topic: str = QUARANTINE_TOPIC,
) -> DataFrame:
    """Quarantine records as messages keyed by ``topic:partition:offset`` of their source."""
    return rejected_events(validated).select(
        _source_key().alias("key"), _quarantine_json(rejected_at).alias("value"),
        F.lit(topic).alias("topic"), "partition", "offset", "timestamp")


def route_messages(
    validated: DataFrame,
    rejected_at: Column | None = None,
    valid_topic: str = VALIDATED_TOPIC,
    quarantine_topic: str = QUARANTINE_TOPIC,
) -> DataFrame:
    """Both sinks in one pass: every row becomes one message that names its topic."""
    valid = F.size("errors") == 0
    return validated.select(
        F.when(valid, F.col("event.event_id")).otherwise(_source_key()).alias("key"),
        F.when(valid, _event_json()).otherwise(_quarantine_json(rejected_at)).alias("value"),
        F.when(valid, valid_topic).otherwise(quarantine_topic).alias("topic"),
        "partition", "offset", "timestamp")
