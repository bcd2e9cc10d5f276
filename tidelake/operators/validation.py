"""Contract validation of raw JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import contract as c
from tidelake.schemas import EVENT

ERRORS = "array<struct<field:string,rule:string,message:string>>"


def _error(field: Column, rule: str, message: str) -> Column:
    return F.struct(field.alias("field"), F.lit(rule).alias("rule"),
                    F.lit(message).alias("message"))


def _once(frame: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """Add columns through a one-row generator.

    The optimizer copies a projected expression into every filter above it; it never moves a
    filter on generated columns below the generator, so the rules run once per message. Lambda
    functions would keep the generator out of the generated code.
    """
    return frame.select(*kept, F.inline(F.array(F.struct(
        *[column.alias(name) for name, column in columns.items()]))))


def validate_events(messages: DataFrame) -> DataFrame:
    """Add ``errors``, every broken rule of the contract, and the typed ``event``.

    ``errors`` is empty exactly when the message is valid, and ``event`` is null otherwise.
    One parse per message, projections only: the row count and partitioning do not change.
    """
    kept = messages.columns
    known = list(c.REQUIRED + c.OPTIONAL)
    wrapped = F.col("_wrapped")
    parsed = _once(
        messages.withColumn("value", F.col("value").cast("string"))
        .withColumn("_wrapped", c.envelope(F.col("value"))),
        kept,
        _keys=c.message_keys(wrapped, F.col("value")),
        **{f"_kind_{n}": c.field_kind(wrapped, n) for n in known},
        **{f"_text_{n}": c.field_text(wrapped, n) for n in known},
    )
    read = _once(parsed, parsed.columns, **{
        f"_value_{n}": c.VALUES[n](F.col(f"_text_{n}")) for n in known})
    keys = F.col("_keys")

    def failure(name: str) -> Column:
        field = c.Field(name, F.col(f"_kind_{name}"), F.col(f"_text_{name}"),
                        F.col(f"_value_{name}"))
        checked = F.when(F.array_contains(keys, name), c.CHECKS[name](field))
        if name in c.REQUIRED:
            checked = checked.otherwise(_error(F.lit(name), "missing", "Field required"))
        return checked

    unreadable = F.array(_error(F.lit("value"), "json_object", "Message should be one JSON object"))
    failures = F.array(*[failure(n) for n in known]).cast(ERRORS)
    judged = _once(
        read, read.columns,
        _failures=F.when(keys.isNull(), unreadable.cast(ERRORS)).otherwise(
            F.array_except(failures, F.array(F.lit(None)).cast(ERRORS))),
        _extra=F.array_except(keys, F.array(*map(F.lit, known))),
    )
    errors = F.when(F.size("_extra") > 0, F.concat("_failures", F.transform(
        F.sort_array("_extra"),
        lambda k: _error(k, "extra_forbidden", "Extra inputs are not permitted"),
    ))).otherwise(F.col("_failures"))
    event = F.struct(*[F.col(f"_value_{f.name}").alias(f.name) for f in EVENT.fields])
    return (
        judged.withColumn("errors", errors)
        .withColumn("event", F.when(F.size("errors") == 0, event))
        .select(*kept, "errors", "event")
    )


def valid_events(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") == 0)


def rejected_events(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") > 0)


def split_valid_quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows; together they are every input row exactly once."""
    return valid_events(validated), rejected_events(validated)


def quarantine_fields(rejected_at: Column | None = None) -> list[Column]:
    """The quarantine record of a rejected row, as columns."""
    return [
        F.col("value").alias("payload"),
        F.to_json("errors").alias("rejection_reason"),
        F.struct(
            "topic", "partition", "offset", F.col("timestamp").alias("received_at"),
        ).alias("source"),
        (F.current_timestamp() if rejected_at is None else rejected_at).alias("rejected_at"),
    ]


def quarantine_records(validated: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Rejected payloads with every reason and their source coordinates."""
    return rejected_events(validated).select(*quarantine_fields(rejected_at))


def quarantine_overview(validated: DataFrame) -> DataFrame:
    """One line per rejected message: its distinct invalid fields and its joined reasons."""
    rows = rejected_events(validated)
    return rows.select(
        "topic", "partition", "offset",
        F.coalesce(F.get_json_object("value", "$.event_id"), F.lit("missing")).alias(
            "event_reference"),
        F.array_join(F.sort_array(F.array_distinct(F.col("errors.field"))), ", ").alias(
            "invalid_fields"),
        F.array_join(F.col("errors.message"), "; ").alias("reasons"),
    )


def quarantine_field_summary(validated: DataFrame) -> DataFrame:
    """Number of rejected messages and failures per field and rule."""
    return (
        rejected_events(validated)
        .select(F.explode("errors").alias("error"))
        .groupBy(F.col("error.field").alias("field"), F.col("error.rule").alias("rule"))
        .agg(F.count("*").alias("failures"))
    )
