"""The customer event contract as columns over the raw JSON text.

Every check looks at raw text: typed JSON parsing would round ``10.999`` to ``11.00`` and read a
timestamp without offset as UTC. Each field yields at most one failure, all fields are checked.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.functions.text import strip

# Field names, bounds and patterns of contract version 1.0.
REQUIRED = ("event_id", "event_type", "customer_id", "occurred_at", "amount", "currency",
            "schema_version")
OPTIONAL = ("document_text",)
EVENT_TYPE_LENGTH = (3, 80)
CUSTOMER_ID_LENGTH = (1, 80)
DOCUMENT_TEXT_LENGTH = (0, 20_000)
CURRENCY = r"\A[A-Z]{3}\z"
VERSION = r"\A1\.0\z"
WHOLE_DIGITS = 14
DECIMAL_PLACES = 2
EPOCH_MILLIS_FROM = 20_000_000_000

UUID = r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
UUID_SPELLINGS = rf"\A({UUID}|\{{{UUID}\}}|(?-i:urn:uuid:){UUID}|(?i)[0-9a-f]{{32}})\z"
DECIMAL = r"\A[+-]?(?=[.]?\d)(\d*)[.]?(\d*)(?:[eE]([+-]?\d+))?\z"
PLAIN_DECIMAL = rf"\A\d{{1,{WHOLE_DIGITS}}}([.]\d{{1,{DECIMAL_PLACES}}})?\z"
LOCAL_TIME = (r"\A(\d{4}-\d{2}-\d{2})[Tt _]([01]\d|2[0-3]):([0-5]\d)"
              r"(?::([0-5]\d)(?:[.,](\d+))?)?")
OFFSET = r"(?:[Zz]|([+\-−])([01]\d|2[0-3]):?([0-5]\d))\z"
EPOCH = r"\A[+-]?\d+([.]\d+)?\z"


@dataclass(frozen=True)
class Field:
    """One field of a parsed message: JSON kind, raw text, and the value read from it."""

    name: str
    kind: Column
    text: Column
    value: Column

    def fail(self, rule: str, message: str) -> Column:
        return F.struct(F.lit(self.name).alias("field"), F.lit(rule).alias("rule"),
                        F.lit(message).alias("message"))

    def is_string(self) -> Column:
        return self.kind == "STRING"

    def is_number(self) -> Column:
        return self.kind.rlike(r"\A(BIGINT|DOUBLE|FLOAT|DECIMAL.*)\z")


def envelope(value: Column) -> Column:
    """Message text wrapped so that it parses only when it is one complete JSON value.

    The parser ignores text after a value. Here such text breaks the wrapper, and a wrapper closed
    early lacks the last key, which a message cannot contain since it is its own digest.
    """
    return F.try_parse_json(F.concat(
        F.lit('{"message":'), value, F.lit(',"'), F.md5(value), F.lit('":0}')))


def message_keys(wrapped: Column, value: Column) -> Column:
    """Top-level keys of the message, null unless it is a JSON object and nothing else."""
    outer = F.map_keys(F.try_variant_get(wrapped, "$", "map<string,variant>"))
    inner = F.map_keys(F.try_variant_get(wrapped, "$.message", "map<string,variant>"))
    return F.when((F.size(outer) == 2) & F.array_contains(outer, F.md5(value)), inner)


def field_kind(wrapped: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(wrapped, f"$.message.{name}", "variant"))


def field_text(wrapped: Column, name: str) -> Column:
    return F.try_variant_get(wrapped, f"$.message.{name}", "string")


def canonical_uuid(text: Column) -> Column:
    """Lower-case hyphenated spelling of an accepted UUID."""
    digits = F.translate(F.regexp_replace(text, r"\Aurn:uuid:|[{}-]", ""), "ABCDEF", "abcdef")
    return F.regexp_replace(digits, r"\A(.{8})(.{4})(.{4})(.{4})(.{12})\z", "$1-$2-$3-$4-$5")


def check_uuid(f: Field) -> Column:
    return (F.when(~f.is_string(), f.fail("uuid", "UUID input should be a string"))
            .when(~f.text.rlike(UUID_SPELLINGS), f.fail("uuid", "Input should be a valid UUID")))


def check_text(low: int, high: int, optional: bool = False) -> Callable[[Field], Column]:
    def check(f: Field) -> Column:
        accepted = f.is_string() | (f.kind == "VOID") if optional else f.is_string()
        size = F.length(f.value)
        return (F.when(~accepted, f.fail("string", "Input should be a valid string"))
                .when(size < low, f.fail(
                    "length", f"String should have at least {low} characters"))
                .when(size > high, f.fail(
                    "length", f"String should have at most {high} characters")))

    return check


def check_pattern(pattern: str, shown: str) -> Callable[[Field], Column]:
    def check(f: Field) -> Column:
        return (F.when(~f.is_string(), f.fail("string", "Input should be a valid string"))
                .when(~f.value.rlike(pattern), f.fail(
                    "pattern", f"String should match pattern '{shown}'")))

    return check


def _decimal_text(text: Column) -> Column:
    return F.translate(strip(text), "_", "")


def check_decimal(f: Field) -> Column:
    """Size and sign of a decimal in any notation, trailing zeros not counted.

    The usual notation passes on one pattern; the others are taken apart.
    """
    text = _decimal_text(f.text)
    whole, fraction = F.regexp_extract(text, DECIMAL, 1), F.regexp_extract(text, DECIMAL, 2)
    exponent = F.coalesce(F.regexp_extract(text, DECIMAL, 3).try_cast("int"), F.lit(0))
    digits = F.ltrim(F.concat(whole, fraction), F.lit("0"))
    core = F.rtrim(digits, F.lit("0"))
    scale = F.length(fraction) - exponent
    places = scale - F.length(digits) + F.length(core)
    number = f.is_string() | f.is_number()
    return (F.when(f.is_string() & f.text.rlike(PLAIN_DECIMAL), None)
            .when(~number, f.fail(
                "decimal", "Decimal input should be an integer, float or string"))
            .when(~text.rlike(DECIMAL) | text.rlike(r"[eE][+-]?\d{5,}\z"), f.fail(
                "decimal", "Input should be a valid decimal"))
            .when(core == "", None)
            .when(text.startswith("-"), f.fail(
                "non_negative", "Input should be greater than or equal to 0"))
            .when(places > DECIMAL_PLACES, f.fail(
                "decimal", f"Decimal input should have no more than {DECIMAL_PLACES} decimal places"))
            .when(F.length(digits) - scale > WHOLE_DIGITS, f.fail(
                "decimal", "Decimal input should have no more than "
                           f"{WHOLE_DIGITS} digits before the decimal point")))


def to_amount(text: Column) -> Column:
    return _decimal_text(text).try_cast("decimal(16,2)")


def to_utc(text: Column) -> Column:
    """Instant of an ISO text with offset or of an epoch number; null when it is neither.

    What a cast cannot read is taken apart: texts without seconds, other separators, and offsets
    beyond 18 hours. Epoch numbers are seconds up to a fixed size and milliseconds beyond it.
    """
    part = [F.regexp_extract(text, LOCAL_TIME + OFFSET, n) for n in range(9)]
    second = F.when(part[4] == "", "00").otherwise(part[4])
    local = F.concat(part[1], F.lit("T"), part[2], F.lit(":"), part[3], F.lit(":"), second,
                     F.lit("."), F.rpad(F.substring(part[5], 1, 6), 6, "0"), F.lit("Z"))
    minutes = F.coalesce(part[7].try_cast("int") * 60 + part[8].try_cast("int"), F.lit(0))
    signed = F.when(part[6] == "+", -minutes).otherwise(minutes)
    stamped = F.coalesce(text.try_cast("timestamp"),
                         local.try_cast("timestamp") + F.make_dt_interval(mins=signed))
    number = text.try_cast("decimal(30,9)")
    micros = F.when(F.abs(number) > EPOCH_MILLIS_FROM, number * 1_000).otherwise(number * 1_000_000)
    epoch = F.timestamp_micros(micros.try_cast("bigint"))
    return (F.when(text.rlike(LOCAL_TIME + OFFSET), F.when(~text.startswith("0000"), stamped))
            .when(text.rlike(EPOCH) & (F.abs(micros) < F.lit(253_402_300_800_000_000)), epoch))


def check_timestamp(f: Field) -> Column:
    naive = f.text.rlike(LOCAL_TIME + r"\z") | f.text.rlike(r"\A\d{4}-\d{2}-\d{2}\z")
    return (F.when(~(f.is_string() | f.is_number()), f.fail(
                "timestamp", "Input should be a valid datetime"))
            .when(f.value.isNotNull(), None)
            .when(naive, f.fail("tz_aware", "occurred_at must include a timezone offset"))
            .otherwise(f.fail("timestamp", "Input should be a valid datetime")))


VALUES: dict[str, Callable[[Column], Column]] = {
    "event_id": canonical_uuid,
    "event_type": strip,
    "customer_id": strip,
    "occurred_at": to_utc,
    "amount": to_amount,
    "currency": strip,
    "document_text": strip,
    "schema_version": strip,
}

CHECKS: dict[str, Callable[[Field], Column]] = {
    "event_id": check_uuid,
    "event_type": check_text(*EVENT_TYPE_LENGTH),
    "customer_id": check_text(*CUSTOMER_ID_LENGTH),
    "occurred_at": check_timestamp,
    "amount": check_decimal,
    "currency": check_pattern(CURRENCY, "^[A-Z]{3}$"),
    "document_text": check_text(*DOCUMENT_TEXT_LENGTH, optional=True),
    "schema_version": check_pattern(VERSION, r"^1\.0$"),
}
