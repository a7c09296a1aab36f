"""Declarative rules, evaluated in one pass per table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REPORT = ["layer", "rule", "severity", "failed", "status"]


@dataclass(frozen=True)
class Rule:
    """`failed` is an aggregate: how many rows (or facts) break the rule."""

    name: str
    failed: Column
    severity: str = "error"


def _where(condition: Column | None) -> Column:
    return F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))


def _count(broken: Column, where: Column | None = None) -> Column:
    return F.count_if(_where(where) & F.coalesce(broken, F.lit(False)))


def row_count_over(n: int) -> Rule:
    return Rule(f"row_count > {n}", F.when(F.count("*") > n, 0).otherwise(1).cast("long"))


def complete(column: str, severity: str = "error") -> Rule:
    return Rule(f"{column} complete", _count(F.col(column).isNull()), severity)


def in_range(
    column: str, low: float | None = None, high: float | None = None, where: Column | None = None
) -> Rule:
    """Null values pass; completeness is its own rule."""
    col = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (col < low)
    if high is not None:
        broken = broken | (col > high)
    bounds = f"{'' if low is None else low}..{'' if high is None else high}"
    return Rule(f"{column} in {bounds}", _count(broken, where))


def in_set(column: str, values: Sequence) -> Rule:
    return Rule(f"{column} accepted", _count(~F.col(column).isin(list(values))))


def none_of(name: str, broken: Column) -> Rule:
    """No row may satisfy `broken`; an unknown result is no breach."""
    return Rule(name, _count(broken))


def expression(name: str, condition: Column, where: Column | None = None) -> Rule:
    """A row breaks the rule when the condition is false or unknown."""
    return Rule(name, F.count_if(_where(where) & ~F.coalesce(condition, F.lit(False))))


def recent_within(column: str, asof: Column, hours: int, severity: str = "error") -> Rule:
    """The newest stamp must be at most `hours` old; no stamp at all is stale."""
    fresh = F.max(column) >= F.first(asof) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return Rule(
        f"{column} within {hours} h",
        F.when(F.coalesce(fresh, F.lit(False)), 0).otherwise(1).cast("long"),
        severity,
    )


def status(failed: Column, severity: Column) -> Column:
    return F.when(failed == 0, "pass").when(severity == "warn", "warn").otherwise("fail")


def evaluate(df: DataFrame, layer: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules in one aggregate over the table, one result row per rule."""
    totals = df.agg(*[r.failed.cast("long").alias(f"_{i}") for i, r in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.severity).alias("severity"),
                F.col(f"_{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return _report(totals.select(F.explode(rows).alias("_r")).select("_r.*"), layer)


def evaluate_keyed(
    df: DataFrame, layer: str, rules: Sequence[Rule], *keys: Sequence[str]
) -> DataFrame:
    """Rules that count rows, and the uniqueness of keys, in one pass over the table.

    Each key holds all columns of the next one, so rows are grouped by the first and the
    groups by the others, on the way to the totals. Rows without a full key do not count
    as repeats.
    """
    names = [f"_{i}" for i in range(len(rules))]
    rows = df.groupBy(*keys[0]).agg(
        F.count("*").alias("_n"), *[r.failed.cast("long").alias(n) for n, r in zip(names, rules)]
    )
    for i, key in enumerate(keys):
        full = F.lit(True)
        for column in key:
            full = full & F.col(column).isNotNull()
        names.append(f"_unique{i}")
        rows = rows.withColumn(names[-1], (full & (F.col("_n") > 1)).cast("long"))
        if i + 1 < len(keys):
            rows = rows.groupBy(*keys[i + 1]).agg(*[F.sum(n).alias(n) for n in ("_n", *names)])
    totals = rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    unique_rules = [Rule(f"{', '.join(key)} unique", F.lit(0)) for key in keys]
    lines = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(n).alias("failed"))
        for r, n in zip([*rules, *unique_rules], names)
    ]
    return _report(totals.select(F.explode(F.array(*lines)).alias("_r")).select("_r.*"), layer)


def observe(
    df: DataFrame, layer: str, rules: Sequence[Rule]
) -> tuple[DataFrame, Callable[[], list[dict]]]:
    """The same rules, counted while `df` is written: no pass of their own.

    Returns the frame to write, and a function that gives the report afterwards.
    """
    observation = Observation(f"{layer} rules")
    watched = df.observe(
        observation, *[r.failed.cast("long").alias(f"_{i}") for i, r in enumerate(rules)]
    )

    def report() -> list[dict]:
        counts = observation.get
        return [
            {
                "layer": layer,
                "rule": r.name,
                "severity": r.severity,
                "failed": counts[f"_{i}"],
                "status": _status_of(counts[f"_{i}"], r.severity),
            }
            for i, r in enumerate(rules)
        ]

    return watched, report


def _status_of(failed: int, severity: str) -> str:
    if failed == 0:
        return "pass"
    return "warn" if severity == "warn" else "fail"


def unique(df: DataFrame, layer: str, *columns: str) -> DataFrame:
    """Key values that occur more than once."""
    repeated = df.dropna(subset=list(columns)).groupBy(*columns).count().filter("count > 1")
    return _counted(repeated, layer, f"{', '.join(columns)} unique")


def relationship(
    child: DataFrame, parent: DataFrame, layer: str, column: str, parent_column: str
) -> DataFrame:
    """Child rows whose key has no parent."""
    return _counted(orphans(child, parent, column, parent_column), layer, f"{column} has parent")


def orphans(
    child: DataFrame, parent: DataFrame, column: str, parent_column: str
) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_parent"), "left_anti"
    )


def assertion(violations: DataFrame, layer: str, name: str) -> DataFrame:
    """A query that must return no rows, as a report line."""
    return _counted(violations, layer, name)


def _counted(rows: DataFrame, layer: str, name: str, severity: str = "error") -> DataFrame:
    counted = rows.agg(F.count("*").alias("failed")).select(
        F.lit(name).alias("rule"), F.lit(severity).alias("severity"), "failed"
    )
    return _report(counted, layer)


def _report(rows: DataFrame, layer: str) -> DataFrame:
    return rows.select(
        F.lit(layer).alias("layer"),
        "rule",
        "severity",
        "failed",
        status(F.col("failed"), F.col("severity")).alias("status"),
    )


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def freshness(
    df: DataFrame, column: str, asof: Column, warn_hours: int, error_hours: int
) -> DataFrame:
    """One row: age of the newest stamp in hours, and pass, warn or error."""
    age = F.timestamp_diff("SECOND", F.max(column), F.first(asof)) / F.lit(3600.0)
    return df.agg(age.alias("age_hours")).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass"),
    )
