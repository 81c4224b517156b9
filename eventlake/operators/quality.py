"""Data-quality rules and their evaluation."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

logger = logging.getLogger(__name__)


class DataQualityError(AssertionError):
    """A rule is violated. The message starts with ``DATA QUALITY FAILURE``."""


@dataclass(frozen=True)
class RequiredColumns:
    """All these columns exist. Further columns are fine."""

    columns: tuple[str, ...]

    @property
    def label(self) -> str:
        return "required_columns"

    def missing(self, df: DataFrame) -> list[str]:
        return sorted(set(self.columns) - set(df.columns))


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def label(self) -> str:
        return f"not_null({self.column})"


@dataclass(frozen=True)
class Check:
    """A condition every row meets. A row for which it is NULL fails."""

    name: str
    condition: str

    @property
    def label(self) -> str:
        return f"check({self.name})"


@dataclass(frozen=True)
class Unique:
    """No two rows share a value. NULL is not a value."""

    column: str

    @property
    def label(self) -> str:
        return f"unique({self.column})"


Rule = RequiredColumns | NotNull | Check | Unique


def _violates(rule: NotNull | Check) -> Column:
    if isinstance(rule, NotNull):
        return F.col(rule.column).isNull()
    return ~F.coalesce(F.expr(rule.condition), F.lit(False))


def _violations(rule: NotNull | Check) -> Column:
    return F.count_if(_violates(rule))


def broken(rules: Sequence[NotNull | Check]) -> Column:
    """The labels of the row rules that a row violates, as an array."""
    return F.array_compact(F.array(*[F.when(_violates(r), F.lit(r.label)) for r in rules]))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs of each column, from one scan."""
    return df.agg(*[_violations(NotNull(c)).alias(c) for c in columns])


def check_count(df: DataFrame, check: Check) -> DataFrame:
    return df.agg(_violations(check).alias("violations"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def audit(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, violations`` for each rule.

    All row rules share one scan. A uniqueness rule needs the keys together and is a
    job of its own; it counts the values that occur more than once.
    """
    spark = df.sparkSession
    parts = []
    for rule in rules:
        if isinstance(rule, RequiredColumns):
            parts.append(
                spark.range(1).select(
                    F.lit(rule.label).alias("rule"),
                    F.lit(len(rule.missing(df))).cast("bigint").alias("violations"),
                )
            )
    row_rules = [r for r in rules if isinstance(r, NotNull | Check)]
    if row_rules:
        counts = df.agg(
            F.array(
                *[
                    F.struct(F.lit(r.label).alias("rule"), _violations(r).alias("violations"))
                    for r in row_rules
                ]
            ).alias("results")
        )
        parts.append(counts.select(F.inline("results")))
    for rule in rules:
        if isinstance(rule, Unique):
            repeated = duplicate_keys(
                df.where(F.col(rule.column).isNotNull()).select(rule.column), [rule.column]
            )
            parts.append(
                repeated.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(rule.label).alias("rule"), "violations"
                )
            )
    if not parts:
        return spark.createDataFrame([], "rule string, violations bigint")
    return reduce(DataFrame.unionByName, parts)


def schema_drift(stored: DataFrame, expected: StructType) -> DataFrame:
    """``column, problem, expected, found, rows`` for each column in which stored rows differ from the
    expected schema: ``missing``, ``extra`` or ``type``. ``rows`` is how many rows are concerned: all, or of
    an extra column those that have a value."""
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    found = {f.name: f.dataType.simpleString() for f in stored.schema}
    drift = []
    for name in sorted(wanted.keys() | found.keys()):
        if wanted.get(name) == found.get(name):
            continue
        extra = name not in wanted
        problem = "extra" if extra else "type" if name in found else "missing"
        drift.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(problem).alias("problem"),
                F.lit(wanted.get(name)).cast("string").alias("expected"),
                F.lit(found.get(name)).cast("string").alias("found"),
                F.count(F.col(f"`{name}`") if extra else F.lit(1)).alias("rows"),
            )
        )
    kind = "array<struct<column:string,problem:string,expected:string,found:string,rows:bigint>>"
    return stored.agg(F.array(*drift).cast(kind).alias("drift")).select(F.inline("drift"))


def enforce_all(
    audits: Sequence[tuple[DataFrame, str, Sequence[Rule]]], mode: str = "fail"
) -> dict[str, dict[str, int]]:
    """Evaluate the rules of several named tables as one query. Raise on violations, or
    log them with ``mode="warn"``.

    Returns the violation count of each rule by table.
    """
    if mode not in ("fail", "warn"):
        raise ValueError(f"mode must be 'fail' or 'warn': {mode}")
    problems: dict[str, list[str]] = {}
    frames = []
    for df, name, rules in audits:
        found, counted = problems.setdefault(name, []), []
        for rule in rules:
            if isinstance(rule, RequiredColumns):
                if rule.missing(df):
                    found.append(f"{rule.label}: missing {', '.join(rule.missing(df))}")
            elif isinstance(rule, NotNull | Unique) and rule.column not in df.columns:
                found.append(f"{rule.label}: no such column")
            else:
                counted.append(rule)
        if counted:
            frames.append(audit(df, counted).select(F.lit(name).alias("name"), "*"))
    counts: dict[str, dict[str, int]] = {name: {} for name in problems}
    if frames:
        # One row per rule, however large the tables are.
        for name, rule, violations in reduce(DataFrame.unionByName, frames).collect():
            counts[name][rule] = violations
            if violations:
                problems[name].append(f"{rule}: {violations} violations")
    messages = [f"{name}: " + "; ".join(found) for name, found in problems.items() if found]
    if messages:
        message = "DATA QUALITY FAILURE: " + " | ".join(messages)
        if mode == "fail":
            raise DataQualityError(message)
        logger.warning(message)
    return counts


def enforce(df: DataFrame, name: str, rules: Sequence[Rule], mode: str = "fail") -> dict[str, int]:
    """The same for one table."""
    return enforce_all([(df, name, rules)], mode)[name]
