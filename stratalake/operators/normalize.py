"""Landing to bronze: fixed projections, lenient and strict parsing, filters, partition keys."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.text import (
    blank_to_null,
    first_non_empty,
    safe_float,
    safe_str,
    strict_float,
    strict_float_of_number,
    strip,
)

log = logging.getLogger(__name__)

#: Field name and longest text of the brewery record, then its two numbers.
ENTITY_TEXT_FIELDS = {
    "id": 200,
    "name": 255,
    "brewery_type": 100,
    "address_1": 255,
    "address_2": 255,
    "address_3": 255,
    "city": 100,
    "state_province": 100,
    "postal_code": 50,
    "country": 100,
    "phone": 50,
    "website_url": 500,
    "state": 100,
    "street": 255,
}
ENTITY_NUMBER_FIELDS = ("longitude", "latitude")
DEFAULT_COUNTRY = "BR"


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def orders_bronze(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Seven order fields; ``keep`` carries extra columns such as the arrival order along.

    The country default applies only where the column is missing altogether.
    """
    amount = F.col("amount")
    numeric = isinstance(df.schema["amount"].dataType, T.NumericType)
    country = F.col("country").cast("string") if "country" in df.columns else F.lit(DEFAULT_COUNTRY)
    return df.select(
        strip(F.col("order_id").cast("string")).alias("order_id"),
        strip(F.col("customer_id").cast("string")).alias("customer_id"),
        (strict_float_of_number if numeric else strict_float)(amount, "amount").alias("amount"),
        F.lower(strip(F.col("status").cast("string"))).alias("status"),
        F.upper(strip(country)).alias("country"),
        F.col("event_ts"),
        F.col("load_at"),
        *[F.col(name) for name in keep],
    )


def shop_orders_bronze(df: DataFrame) -> DataFrame:
    """Eight shop-order fields; empty optional dates become null, all dates stay text."""
    optional = (
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return df.select(
        strip(F.col("order_id").cast("string")).alias("order_id"),
        strip(F.col("customer_id").cast("string")).alias("customer_id"),
        F.lower(strip(F.col("order_status").cast("string"))).alias("order_status"),
        F.col("order_purchase_timestamp").cast("string").alias("order_purchase_timestamp"),
        *[blank_to_null(_column(df, name).cast("string")).alias(name) for name in optional],
    )


def entity_bronze(
    df: DataFrame,
    text_fields: Mapping[str, int] = ENTITY_TEXT_FIELDS,
    number_fields: Sequence[str] = ENTITY_NUMBER_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fixed projection of a record: cut text, lenient numbers, missing fields null."""
    return df.select(
        *[safe_str(_column(df, name), size).alias(name) for name, size in text_fields.items()],
        *[safe_float(_column(df, name)).alias(name) for name in number_fields],
        *[F.col(name) for name in keep],
    )


def partition_country(df: DataFrame) -> Column:
    raw = F.coalesce(blank_to_null(_column(df, "country")), F.lit("unknown"))
    return F.coalesce(blank_to_null(F.upper(strip(raw))), F.lit("UNKNOWN"))


def partition_state(df: DataFrame) -> Column:
    raw = F.coalesce(
        first_non_empty(_column(df, "state"), _column(df, "state_province")), F.lit("unknown")
    )
    joined = F.replace(F.upper(strip(raw)), F.lit(" "), F.lit("_"))
    return F.coalesce(blank_to_null(joined), F.lit("UNKNOWN"))


def load_date(value: dt.date | str | None = None) -> Column:
    """The given date, or today in UTC, as ISO text."""
    if value is None:
        return F.date_format(
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd"
        )
    return F.lit(value if isinstance(value, str) else value.isoformat())


def with_partition_keys(df: DataFrame, loaded: dt.date | str | None = None) -> DataFrame:
    """Adds p_country, p_state and load_date; the data's own country and state stay as they are."""
    return df.withColumns(
        {
            "p_country": partition_country(df),
            "p_state": partition_state(df),
            "load_date": load_date(loaded),
        }
    )


def date_window(day: Column, end: dt.date | None = None, days: int = 1) -> Column:
    """True inside the last ``days`` days up to and including ``end``."""
    if days < 1:
        raise ValueError("days must be >= 1")
    last = end or dt.datetime.now(dt.timezone.utc).date()
    return day.between(F.lit(last - dt.timedelta(days=days - 1)), F.lit(last))


def time_window(moment: Column, end: dt.date, days: int = 1) -> Column:
    """The same window over a zone-less timestamp, as a range the file scan can use."""
    if days < 1:
        raise ValueError("days must be >= 1")
    start = dt.datetime.combine(end - dt.timedelta(days=days - 1), dt.time())
    stop = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
    as_ntz = lambda value: F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return (moment >= as_ntz(start)) & (moment < as_ntz(stop))


@dataclass(frozen=True)
class FilterRule:
    """Keep the rows of a table where a column, stripped, equals a value."""

    output: str
    column: str
    value: str


def known_rules(frames: Mapping[str, DataFrame], rules: Mapping[str, Sequence[FilterRule]]) -> dict[str, Sequence[FilterRule]]:
    """The rules whose table is there; others are skipped with a warning."""
    for table in rules:
        if table not in frames:
            log.warning("filter skipped: no table %s", table)
    return {table: found for table, found in rules.items() if table in frames}


def apply_filters(
    frames: Mapping[str, DataFrame], rules: Mapping[str, Sequence[FilterRule]]
) -> dict[str, DataFrame]:
    """One filtered frame per rule; rules on unknown tables are skipped with a warning."""
    out: dict[str, DataFrame] = {}
    for table, table_rules in known_rules(frames, rules).items():
        for rule in table_rules:
            cell = strip(F.col(rule.column).cast("string"))
            out[rule.output] = frames[table].where(cell == rule.value.strip())
    return out


#: Position of the rule a row matched.
RULE = "_rule"


def match_rules(df: DataFrame, rules: Sequence[FilterRule]) -> DataFrame:
    """Every row once per rule it matches, with the rule's position in ``_rule``: one scan for all rules."""
    if RULE in df.columns:
        raise ValueError(f"the table has a column {RULE} of its own")
    hits = [
        F.when(strip(F.col(rule.column).cast("string")) == rule.value.strip(), F.lit(place))
        for place, rule in enumerate(rules)
    ]
    return df.withColumn(RULE, F.explode(F.array_compact(F.array(*hits) if hits else F.array().cast("array<int>"))))


def current_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_current"))


def completed_rows(df: DataFrame) -> DataFrame:
    return current_rows(df).where(F.col("status") == "completed")


def export_rows(df: DataFrame, channel: str = "analytics") -> DataFrame:
    """KPI rows for the export layer; a missing country column means the default country."""
    country = F.col("country") if "country" in df.columns else F.lit(DEFAULT_COUNTRY)
    return df.select(
        "kpi_name", "kpi_value", country.alias("country"), F.lit(channel).alias("export_channel")
    )


def typed_copy(df: DataFrame, schema: T.StructType, lengths: Mapping[str, int] | None = None) -> DataFrame:
    """Text columns to the declared types; text longer than its declared length is cut."""
    lengths = lengths or {}

    def convert(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            size = lengths.get(field.name)
            return (F.left(col, F.lit(size)) if size else col).alias(field.name)
        return blank_to_null(strip(col)).cast(field.dataType).alias(field.name)

    return df.select(*[convert(field) for field in schema.fields])
