"""Data-quality checks: a list of checks becomes one aggregation and one report."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


class DataQualityError(RuntimeError):
    """Raised when one or more checks fail."""


@dataclass(frozen=True)
class Check:
    """Aggregates a check needs, and how its report row follows from them."""

    inputs: dict[str, Column]
    name: Column
    passed: Column
    message: Column
    measures: dict[str, Column] = field(default_factory=dict)


def row_count() -> Column:
    return F.count(F.lit(1))


def null_rate(column: str, max_rate: float = 0.0, present: bool = True) -> Check:
    """Share of missing values; a column the table does not have is missing everywhere."""
    missing = F.count_if(F.col(column).isNull()) if present else row_count()
    rows, nulls = F.col("rows"), F.col(f"nulls:{column}")
    rate = nulls / rows
    empty = rows == 0
    return Check(
        {"rows": row_count(), f"nulls:{column}": missing},
        F.when(empty, F.lit("null_rate")).otherwise(F.lit(f"null_rate:{column}")),
        F.when(empty, F.lit(False)).otherwise(rate <= max_rate),
        F.when(empty, F.lit("empty dataset")).otherwise(
            F.format_string("null rate=%.3f max=%.3f", rate, F.lit(float(max_rate)))
        ),
        {"rows": rows, "nulls": F.when(~empty, nulls), "rate": F.when(~empty, rate)},
    )


def in_range(column: str, low: float | None = None, high: float | None = None) -> Check:
    """Values outside the bounds; missing and not-a-number values violate nothing."""
    value = F.col(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    key = f"outside:{column}:{low}:{high}"
    number = F.col(column).cast("double")
    violations = F.col(f"`{key}`")
    return Check(
        {key: F.count_if(outside & ~F.isnan(number))},
        F.lit(f"range:{column}"),
        violations == 0,
        F.concat(F.lit("violations="), violations),
        {"violations": violations},
    )


def volume(baseline: int, max_variance_pct: float = 20.0) -> Check:
    """Row count against a baseline, as an absolute percentage."""
    rows = F.col("rows")
    if baseline <= 0:
        return Check(
            {"rows": row_count()},
            F.lit("volume_vs_baseline"),
            F.lit(False),
            F.lit("baseline must be > 0"),
            {"actual": rows, "baseline": F.lit(baseline)},
        )
    variance = F.abs(rows - baseline) / F.lit(baseline) * 100
    return Check(
        {"rows": row_count()},
        F.lit("volume_vs_baseline"),
        variance <= max_variance_pct,
        F.format_string("variance=%.2f%% max=%.2f%%", variance, F.lit(float(max_variance_pct))),
        {"actual": rows, "baseline": F.lit(baseline), "variance_pct": variance},
    )


def no_duplicates(column: str = "id") -> Check:
    """Non-empty ids minus distinct non-empty ids."""
    filled = F.when(F.col(column).cast("string") != "", F.col(column))
    given, kinds = f"filled:{column}", f"distinct:{column}"
    extra = F.col(given) - F.col(kinds)
    return Check(
        {"rows": row_count(), given: F.count(filled), kinds: F.count_distinct(filled)},
        F.lit(f"duplicate:{column}"),
        extra == 0,
        F.concat(F.lit("duplicate_count="), extra),
        {"rows": F.col("rows"), "duplicates": extra},
    )


def min_volume(minimum: int) -> Check:
    rows = F.col("rows")
    return Check(
        {"rows": row_count()},
        F.lit("min_volume"),
        rows >= minimum,
        F.concat(F.lit("count="), rows, F.lit(f" min={minimum}")),
        {"count": rows, "minimum": F.lit(minimum)},
    )


def null_checks(df: DataFrame, columns: Sequence[str], max_rate: float = 0.0) -> list[Check]:
    return [null_rate(name, max_rate, name in df.columns) for name in columns]


def entity_checks(df: DataFrame, required: Sequence[str] = ("id", "name", "brewery_type"), key: str | None = "id", minimum: int = 1) -> list[Check]:
    """The silver gate: required columns filled, unique key, enough rows."""
    checks = null_checks(df, required)
    if key:
        checks.append(no_duplicates(key))
    return [*checks, min_volume(minimum)]


def export_checks(df: DataFrame, baseline: int = 3, max_variance_pct: float = 0.0) -> list[Check]:
    """The export gate on KPI rows."""
    return [
        *null_checks(df, ["kpi_name", "kpi_value"]),
        in_range("kpi_value", low=0),
        volume(baseline, max_variance_pct),
    ]


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows name, passed, message, metrics: one row per check from a single pass over ``df``."""
    inputs: dict[str, Column] = {}
    for check in checks:
        inputs.update(check.inputs)
    totals = df.agg(*[col.alias(name) for name, col in inputs.items()])

    def row(position: int, check: Check) -> Column:
        filled = [
            F.struct(F.lit(name).alias("key"), value.cast("double").alias("value"))
            for name, value in check.measures.items()
        ]
        measured = F.map_from_entries(F.filter(F.array(*filled), lambda e: e["value"].isNotNull()))
        return F.struct(
            F.lit(position).alias("position"),
            check.name.alias("name"),
            check.passed.alias("passed"),
            check.message.alias("message"),
            measured.alias("metrics"),
        )

    rows = F.array(*[row(i, check) for i, check in enumerate(checks, start=1)])
    return totals.select(F.inline(rows))


def gate(report_rows: DataFrame, raise_on_fail: bool = True) -> bool:
    """Logs every check; raises naming the failed ones, or returns whether all passed.

    The report holds one row per check.
    """
    failed = []
    for row in report_rows.orderBy("position").collect():
        level = logging.INFO if row.passed else logging.ERROR
        log.log(level, "%s | %s | %s", row.name, row.passed, row.message)
        if not row.passed:
            failed.append(row["name"])
    if failed and raise_on_fail:
        raise DataQualityError(f"data quality failed: {', '.join(failed)}")
    return not failed


# Keys of relational tables -------------------------------------------------------------


def key_duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent row, with the number of child rows.

    Child rows are counted per key before the join, so a hot key is one row there.
    """
    used = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("orphan_key"))
    counted = used.agg(F.count(F.lit(1)).alias("row_count"))
    owners = parent.select(F.col(parent_key).alias("_owner"))
    return counted.join(owners, F.col("orphan_key") == F.col("_owner"), "left_anti")


def table_rules(df: DataFrame, key: Sequence[str], not_null: Sequence[str]) -> DataFrame:
    """Report of a table's declared key and NOT NULL columns."""
    struct_key = F.struct(*key) if len(key) > 1 else F.col(key[0])
    extra = F.col("rows") - F.col("distinct_keys")
    unique = Check(
        {"rows": row_count(), "distinct_keys": F.count_distinct(struct_key)},
        F.lit(f"primary_key:{','.join(key)}"),
        extra == 0,
        F.concat(F.lit("duplicate_count="), extra),
        {"rows": F.col("rows"), "duplicates": extra},
    )
    return report(df, [unique, *null_checks(df, not_null)])


def declared_not_null(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
