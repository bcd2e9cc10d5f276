"""Quality rules between layers.

Rules on single rows share one aggregate; each uniqueness rule adds one grouped count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """A layer breaks one of its rules."""


@dataclass(frozen=True)
class Rule:
    kind: str
    columns: tuple[str, ...]
    minimum: float | None = None
    maximum: float | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)

    def considered(self) -> Column:
        """Rows the rule applies to; nulls are the business of ``not_null`` alone."""
        if self.kind == "not_null":
            return F.lit(True)
        return reduce(or_, [F.col(c).isNotNull() for c in self.columns])

    def broken(self) -> Column:
        """Whether a considered row fails; for rules that look at one row."""
        value = F.col(self.columns[0])
        if self.kind == "not_null":
            return value.isNull()
        low = value < self.minimum if self.minimum is not None else F.lit(False)
        high = value > self.maximum if self.maximum is not None else F.lit(False)
        return low | high


def not_null(column: str) -> Rule:
    return Rule("not_null", (column,))


def unique(*columns: str) -> Rule:
    return Rule("unique", columns)


def between(column: str, minimum: float | None = None, maximum: float | None = None) -> Rule:
    return Rule("between", (column,), minimum, maximum)


# The rules of each layer.
LAYER_RULES: dict[str, tuple[Rule, ...]] = {
    "bronze": (not_null("event_id"), not_null("kafka_offset")),
    "silver": (not_null("event_id"), unique("event_id"), not_null("customer_id"),
               between("amount", minimum=0)),
    "silver_current": (not_null("event_id"), unique("customer_id", "event_type")),
    "gold": (not_null("customer_id"), not_null("currency"),
             unique("customer_id", "event_day", "currency"),
             between("event_count", minimum=1), between("total_amount", minimum=0)),
}


def rules_of(layer: str) -> tuple[Rule, ...]:
    if layer not in LAYER_RULES:
        raise ValueError(f"unknown layer {layer!r}, expected one of {sorted(LAYER_RULES)}")
    return LAYER_RULES[layer]


def _row(layer: str, rule: Rule, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"), F.lit(rule.kind).alias("rule"),
        F.lit(rule.label).alias("columns"), checked.alias("checked"), failed.alias("failed"),
        (failed == 0).alias("passed"),
    )


def check_rules(frame: DataFrame, rules: Sequence[Rule], layer: str = "table") -> DataFrame:
    """One line per rule: rows checked, rows failed, and whether the rule holds."""
    reports = []
    plain = [r for r in rules if r.kind != "unique"]
    if plain:
        counts = [
            agg for i, r in enumerate(plain) for agg in (
                F.count_if(r.considered()).alias(f"checked_{i}"),
                F.count_if(r.considered() & r.broken()).alias(f"failed_{i}"))
        ]
        reports.append(frame.agg(*counts).select(F.inline(F.array(*[
            _row(layer, r, F.col(f"checked_{i}"), F.col(f"failed_{i}"))
            for i, r in enumerate(plain)]))))
    for r in rules:
        if r.kind == "unique":
            copies = frame.where(r.considered()).groupBy(*r.columns).agg(
                F.count("*").alias("copies"))
            totals = copies.agg(
                F.coalesce(F.sum("copies"), F.lit(0)).alias("checked"),
                F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0)).alias(
                    "failed"))
            reports.append(totals.select(F.inline(F.array(
                _row(layer, r, F.col("checked"), F.col("failed"))))))
    return reduce(DataFrame.unionByName, reports)


def expect_not_null(frame: DataFrame, column: str) -> DataFrame:
    return check_rules(frame, [not_null(column)])


def expect_unique(frame: DataFrame, *columns: str) -> DataFrame:
    return check_rules(frame, [unique(*columns)])


def expect_between(
    frame: DataFrame, column: str, minimum: float | None = None, maximum: float | None = None,
) -> DataFrame:
    return check_rules(frame, [between(column, minimum, maximum)])


def gate_report(frame: DataFrame, layer: str) -> DataFrame:
    return check_rules(frame, rules_of(layer), layer)


def gate_violations(frame: DataFrame, layer: str, evidence: Sequence[str]) -> DataFrame:
    """The offending rows of each rule, reduced to the ``evidence`` columns."""
    found = []
    for r in rules_of(layer):
        rows = frame.where(r.considered())
        if r.kind == "unique":
            # Null-safe, since a compound key may hold nulls; the right side has distinct keys.
            repeated = rows.groupBy(*r.columns).agg(F.count("*").alias("_copies")).where(
                F.col("_copies") > 1).select(*[F.col(c).alias(f"_{c}") for c in r.columns])
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in r.columns]
            rows = rows.join(repeated, same, "left_semi")
        else:
            rows = rows.where(r.broken())
        found.append(rows.select(
            F.lit(layer).alias("layer"), F.lit(r.kind).alias("rule"),
            F.lit(r.label).alias("columns"), *evidence))
    return reduce(DataFrame.unionByName, found)


def require_pass(report: DataFrame) -> None:
    """Raise with every failed rule; the report has one line per rule."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(
            f"{r.layer}: {r['rule']}({r['columns']}) fails on {r.failed} of {r.checked} rows"
            for r in failed))


def run_gate(frame: DataFrame, layer: str) -> DataFrame:
    """Check a layer and stop on a broken rule; the frame passes through for the next step."""
    require_pass(gate_report(frame, layer))
    return frame
