"""KPI metrics: declarations to aggregates, one pass, long rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.normalize import DEFAULT_COUNTRY


@dataclass(frozen=True)
class Metric:
    """``sum`` and ``count_distinct`` of a field, or the ``ratio`` of matching rows to all rows.

    ``where`` is a (column, value) pair the counted rows must match. ``nulls_count`` lets a
    missing value count as one more distinct member.
    """

    name: str
    kind: str
    field: str | None = None
    where: tuple[str, str] | None = None
    digits: int | None = None
    nulls_count: bool = False

    def column(self) -> Column:
        match = F.col(self.where[0]) == self.where[1] if self.where else F.lit(True)
        if self.kind == "sum":
            value = F.coalesce(F.sum(F.when(match, F.col(self.field))), F.lit(0.0))
        elif self.kind == "count_distinct":
            value = F.count_distinct(F.when(match, F.col(self.field)))
            if self.nulls_count:
                value = value + F.coalesce(
                    F.max(F.when(match & F.col(self.field).isNull(), 1)), F.lit(0)
                )
        elif self.kind == "ratio":
            value = F.coalesce(F.try_divide(F.count_if(match), F.count(F.lit(1))), F.lit(0.0))
        else:
            raise ValueError(f"unknown metric kind {self.kind!r}")
        value = value.cast("double")
        return (value if self.digits is None else F.round(value, self.digits)).alias(self.name)


#: The three order KPIs.
ORDER_METRICS = (
    Metric("gmv_completed", "sum", "amount", ("status", "completed"), 2),
    Metric("active_customers", "count_distinct", "customer_id", nulls_count=True),
    Metric("completion_rate", "ratio", where=("status", "completed"), digits=4),
)


def metrics(df: DataFrame, specs: Sequence[Metric], by: Sequence[str] = ()) -> DataFrame:
    """One long row per metric and group, computed in a single aggregation."""
    wide = df.groupBy(*by).agg(*[spec.column() for spec in specs])
    return wide.unpivot(list(by), [spec.name for spec in specs], "kpi_name", "kpi_value")


def order_kpis(current: DataFrame, country: str = DEFAULT_COUNTRY, grain: str = "daily") -> DataFrame:
    """The three KPIs over current rows, with country and grain."""
    return metrics(current, ORDER_METRICS).select(
        "kpi_name", "kpi_value", F.lit(country).alias("country"), F.lit(grain).alias("grain")
    )


def distinct_card(df: DataFrame, field: str) -> DataFrame:
    return df.agg(F.count_distinct(field).alias("distinct_count"))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
