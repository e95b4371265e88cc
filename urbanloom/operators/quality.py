"""Data-quality rules as queries.

A rule describes failing rows. ``check`` measures a whole list of rules in one
pass, ``violations`` returns the failing rows of one rule, ``label_errors``
tags rows with the first failing rule of an ordered list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

ERROR, WARN = "error", "warn"


class QualityError(AssertionError):
    """At least one rule of severity ``error`` failed."""


@dataclass(frozen=True)
class Rule:
    """One check. ``good`` is SQL text that holds for a good row (unknown passes);
    a ``unique`` rule has none and is checked on groups."""

    kind: str
    column: str
    good: str = ""
    severity: str = ERROR
    where: str = ""
    label: str = ""

    @property
    def name(self) -> str:
        return self.label or f"{self.kind}:{self.column}"

    def warn(self) -> "Rule":
        return replace(self, severity=WARN)

    def failing(self) -> Column:
        """TRUE for a failing row, FALSE otherwise."""
        bad = f"not ({self.good})"
        return F.expr(f"coalesce(({self.where}) and {bad}, false)" if self.where else f"coalesce({bad}, false)")


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", column, f"{column} is not null") for column in columns]


def unique(*columns: str) -> list[Rule]:
    return [Rule("unique", column) for column in columns]


def accepted(column: str, values: Sequence[str], where: str = "") -> Rule:
    listed = ", ".join("'" + value.replace("'", "''") + "'" for value in values)
    return Rule("accepted_values", column, f"{column} in ({listed})", where=where)


def in_range(column: str, low: float | None = None, high: float | None = None, where: str = "") -> Rule:
    bounds = []
    if low is not None:
        bounds.append(f"{column} >= {low}")
    if high is not None:
        bounds.append(f"{column} <= {high}")
    return Rule("accepted_range", column, " and ".join(bounds), where=where)


def expression(column: str, good: str, where: str = "", label: str = "") -> Rule:
    return Rule("expression_is_true", column, good, where=where, label=label)


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """Failing rows of a rule; for ``unique`` the repeated values and their counts."""
    if rule.kind != "unique":
        return df.filter(rule.failing())
    rows = df.filter(rule.where) if rule.where else df
    return (
        rows.filter(F.col(rule.column).isNotNull())
        .groupBy(rule.column)
        .agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
    )


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, column_name, kind, severity, failures)`` for every rule.

    All row rules share one aggregation over one scan; each ``unique`` rule adds
    one grouping of its column, which combines repeated values on the map side.
    """
    row_rules = [rule for rule in rules if rule.kind != "unique"]
    parts = []
    if row_rules:
        counted = df.agg(*[F.count_if(rule.failing()).alias(f"r{i}") for i, rule in enumerate(row_rules)])
        entries = [
            F.struct(*_identity(rule), F.col(f"r{i}").alias("failures")) for i, rule in enumerate(row_rules)
        ]
        parts.append(counted.select(F.inline(F.array(*entries))))
    for rule in rules:
        if rule.kind == "unique":
            counted = violations(df, rule).agg(F.count("*").alias("failures"))
            parts.append(counted.select(*_identity(rule), "failures"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _identity(rule: Rule) -> list[Column]:
    return [
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.severity).alias("severity"),
    ]


def outcomes(checked: DataFrame) -> DataFrame:
    """Add ``pass``, ``warn`` or ``error`` by failures and severity."""
    return checked.withColumn(
        "outcome", F.when(checked.failures == 0, F.lit("pass")).otherwise(checked.severity)
    )


def enforce(checked: DataFrame) -> DataFrame:
    """Raise if a rule of severity ``error`` failed; warnings only stay in the
    result. The result has one row per rule, so collecting it is bounded."""
    failed = outcomes(checked).filter("outcome = 'error'").select("rule", "failures").collect()
    if failed:
        raise QualityError(", ".join(f"{row.rule}: {row.failures}" for row in failed))
    return checked


@dataclass(frozen=True)
class Label:
    """One entry of an ordered list of error labels. ``selects=False`` names rows
    that another entry selected but does not select rows by itself."""

    name: str
    condition: str
    selects: bool = True


def label_errors(
    df: DataFrame, entries: Sequence[Label], columns: Sequence[str], now: str = "current_timestamp()"
) -> DataFrame:
    """Rows with at least one error, tagged with the first label that applies.

    ``{now}`` in a condition stands for the time of the run. The labels are one
    derived column and one filter over a single scan.
    """
    chain = None
    selected = None
    for entry in entries:
        condition = F.expr(entry.condition.replace("{now}", now))
        chain = F.when(condition, entry.name) if chain is None else chain.when(condition, entry.name)
        if entry.selects:
            hit = F.coalesce(condition, F.lit(False))
            selected = hit if selected is None else selected | hit
    every = all(entry.selects for entry in entries)
    labelled = df.withColumn("error_type", chain)
    kept = labelled.filter(F.col("error_type").isNotNull() if every else selected)
    return kept.select(*columns, "error_type")


def error_report(errors: DataFrame, order: Sequence[Column | str], rows: int = 1000) -> DataFrame:
    """First ``rows`` errors in report order (a bounded top-k, no full sort).
    The remaining columns break ties, so the report is the same on every run."""
    return errors.orderBy("error_type", *order, *errors.columns).limit(rows)


def failing_any(df: DataFrame, good: Sequence[str], now: str = "current_timestamp()") -> DataFrame:
    """Rows for which at least one condition is false (unknown passes)."""
    bad = None
    for text in good:
        fails = F.coalesce(~F.expr(text.replace("{now}", now)), F.lit(False))
        bad = fails if bad is None else bad | fails
    return df.filter(bad)
