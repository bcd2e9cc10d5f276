from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from uuid import UUID

import pytest

from tests import samples
from tidelake.functions import contract
from tidelake.operators import validation as v


def test_sample_flow(spark):
    checked = v.validate_events(samples.messages(spark))
    valid, rejected = v.split_valid_quarantine(checked)
    assert (checked.count(), valid.count(), rejected.count()) == (18, 14, 4)
    found = {r.offset: {e.field for e in r.errors} for r in rejected.collect()}
    assert found == {
        14: {"occurred_at", "amount", "currency"},
        15: {"event_id"},
        16: {"event_type", "customer_id", "amount"},
        17: {"schema_version", "remark"},
    }
    overview = {r.offset: r for r in v.quarantine_overview(checked).collect()}
    assert overview[14].invalid_fields == "amount, currency, occurred_at"
    assert overview[15].event_reference == "no such id"
    counts = {(r.field, r.rule): r.failures for r in v.quarantine_field_summary(checked).collect()}
    assert counts[("amount", "decimal")] == counts[("amount", "non_negative")] == 1


def test_quarantine_record(spark):
    row = v.quarantine_records(v.validate_events(samples.messages(spark))).where(
        "source.offset = 17").first()
    assert json.loads(row.payload) == samples.INVALID[3]
    assert {e["field"] for e in json.loads(row.rejection_reason)} == {
        "schema_version", "remark"}
    assert row.source.topic == "raw.events" and row.source.received_at == (
        samples.START + dt.timedelta(seconds=17))
    assert row.rejected_at is not None


BASE = samples.VALID[0]
AMOUNTS = ["10.500", "10.999", "1e2", "1E-1", " 10.5 ", "1_0", "NaN", "Infinity", "-0", "-0.00",
           "99999999999999.99", "999999999999999", "100000000000000", "0.10000", "00012.50", "+5",
           ".5", "5.", "", "0x1", True, 10, 10.5, 1e20, None, "1e14", "1e13", "0e5", "0.001e1", ".",
           "e5", "-5.00", "-0.001", [1], {"a": 1}, -3, -3.5, "1.2.3", "--1"]
TIMES = ["2025-03-10 08:15Z", "2025-03-10t08:15:00z", "2025-03-10_08:15:00Z",
         "2025-03-10T08:15:00.1234567Z", "2025-03-10T08:15:00,123Z", "2025-03-10T08:15:60Z",
         "2025-03-10T24:00:00Z", "2025-03-10T08:15:00+0300", "2025-03-10T08:15:00+03",
         "2025-03-10T08:15:00+24:00", "2025-03-10T08:15:00+23:59", "2025-03-10T08:15:00-00:00",
         "2025-03-10T08:15:00 +03:00", " 2025-03-10T08:15:00Z", "2025-03-10", "1722500000",
         "1722500000.5", "-5", 1722500000, 17225000000000, 1.5, "2025-02-30T00:00:00Z",
         "0000-01-01T00:00:00Z", "2025-03-10T08Z", True, None, "", "20250310T081500Z",
         "20000000001", "20000000000", "2025-03-10T08:15:00", "2025-13-01T08:15:00", "x", [1],
         "2025-03-10T08:15:00-11:30", "2025-03-10T08:15:00−03:00"]
IDS = ["7B1E0C44-5a02-4d9f-9c3e-000000000001", "7b1e0c445a024d9f9c3e000000000001",
       "{7b1e0c44-5a02-4d9f-9c3e-000000000001}", "urn:uuid:7b1e0c44-5a02-4d9f-9c3e-000000000001",
       "{7b1e0c445a024d9f9c3e000000000001}", "urn:uuid:7b1e0c445a024d9f9c3e000000000001",
       " 7b1e0c44-5a02-4d9f-9c3e-000000000001", 12, None, "", "not"]
TEXTS = ["", " ", "a", " ab ", "abc", "x" * 80, "x" * 81, "x" * 20_000, "x" * 20_001,
         "\x1cab\x1c", "\x85abc ", "GBP\n", " USD", "\n1.0\t", 1.0, 1, None, True, [], {},
         "é" * 80]
WHOLE = json.dumps(BASE)
BROKEN = ["", "x", "[1]", "null", "3", '"s"', WHOLE + " trailing", WHOLE + "}", WHOLE + WHOLE,
          WHOLE + ',"x":{}', WHOLE + "] }", WHOLE[:-3], " " + WHOLE + " \n"]


def variants() -> list[str]:
    rows = [BASE, {**BASE, "z": 1, "a": None}, {}]
    for key, values in {"amount": AMOUNTS, "occurred_at": TIMES, "event_id": IDS}.items():
        rows += [{**BASE, key: value} for value in values]
    for key in ("event_type", "customer_id", "currency", "document_text", "schema_version"):
        rows += [{**BASE, key: value} for value in TEXTS]
    rows += [{k: x for k, x in BASE.items() if k != left_out} for left_out in BASE]
    return [json.dumps(r) for r in rows] + BROKEN


def independent_model(pydantic):
    """The contract's published constants as fields of a model, read by another library."""
    def text(bounds, **more):
        least, most = bounds
        return pydantic.Field(min_length=least, max_length=most, **more)

    def shape(pattern):
        return pydantic.Field(pattern=pattern.replace(r"\A", "^").replace(r"\z", "$"))

    fields = {name: (str, ...) for name in contract.REQUIRED} | {
        "event_id": (UUID, ...),
        "occurred_at": (pydantic.AwareDatetime, ...),
        "event_type": (str, text(contract.EVENT_TYPE_LENGTH)),
        "customer_id": (str, text(contract.CUSTOMER_ID_LENGTH)),
        "currency": (str, shape(contract.CURRENCY)),
        "schema_version": (str, shape(contract.VERSION)),
        "amount": (Decimal, pydantic.Field(
            ge=0, decimal_places=contract.DECIMAL_PLACES,
            max_digits=contract.WHOLE_DIGITS + contract.DECIMAL_PLACES)),
        **{name: (str | None, text(contract.DOCUMENT_TEXT_LENGTH, default=None))
           for name in contract.OPTIONAL}}
    strict = pydantic.ConfigDict(extra="forbid", str_strip_whitespace=True)
    return pydantic.create_model("Independent", __config__=strict, **fields)


def expected(model, text: str):
    """Fields that fail, and the values if none does."""
    try:
        content = json.loads(text)
    except ValueError:
        content = None
    if not isinstance(content, dict):
        return {"value"}, None
    try:
        return set(), model.model_validate(content)
    except Exception as error:  # the library's own error lists the fields
        return {str(e["loc"][0]) for e in error.errors()}, None


def test_agrees_with_an_independent_contract(spark):
    model = independent_model(pytest.importorskip("pydantic"))
    texts = variants()
    for row in v.validate_events(samples.raw(spark, texts)).collect():
        fields, wanted = expected(model, texts[row.offset])
        assert {e.field for e in row.errors} == fields, texts[row.offset][:300]
        assert (row.event is None) == bool(fields)
        if wanted is not None:
            e = row.event
            assert e.occurred_at == wanted.occurred_at.astimezone(dt.UTC).replace(tzinfo=None)
            assert (e.event_id, e.amount) == (str(wanted.event_id), wanted.amount)
            assert (e.event_type, e.customer_id, e.currency, e.document_text) == (
                wanted.event_type, wanted.customer_id, wanted.currency, wanted.document_text)


def test_the_last_of_repeated_keys_counts(spark):
    good, bad = WHOLE[:-1] + ',"amount":"4.50"}', WHOLE[:-1] + ',"currency":"x"}'
    found = {r.offset: r for r in v.validate_events(samples.raw(
        spark, [good, bad, '{"amount":"-1",' + WHOLE[1:]])).collect()}
    assert found[0].event.amount == Decimal("4.50") and not found[0].errors
    assert [(e.field, e.rule) for e in found[1].errors] == [("currency", "pattern")]
    assert found[2].event.amount == Decimal("12.40")


def test_every_field_is_reported_once(spark):
    row = v.validate_events(samples.raw(spark, [json.dumps(samples.INVALID[2])])).first()
    fields = [e.field for e in row.errors]
    assert sorted(fields) == sorted(set(fields)) == ["amount", "customer_id", "event_type"]


def test_rules_run_once_per_message(spark):
    """A filter on the result must not carry a second copy of the rules below the generator."""
    frame = v.valid_events(v.validate_events(samples.messages(spark))).select("event.event_id")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") > 0
    assert plan.count("String should have at least 3 characters") == 1
