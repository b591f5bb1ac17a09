"""Synthetic shop tables. Each takes a frame of numbers ``i`` (1, 2, 3, ...), any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.text import numbered_id

#: Fixed values of the generated tables, by remainder of the row number.
CUSTOMER_PLACES = (
    ("Rio de Janeiro", "RJ"),
    ("Sao Paulo", "SP"),
    ("Belo Horizonte", "MG"),
    ("Curitiba", "PR"),
    ("Porto Alegre", "RS"),
)
SELLER_PLACES = (("Rio de Janeiro", "RJ"), ("Sao Paulo", "SP"), ("Salvador", "BA"), ("Recife", "PE"))
EARLY_STATUS = ("cancelled", "processing", "shipped")
PAYMENT_TYPES = ("boleto", "credit_card", "debit_card", "voucher")
ORDER_START, REVIEW_START = "2017-01-01 00:00:00", "2017-06-01 00:00:00"
#: Table sizes of the demo data.
SIZES = {"customers": 300, "sellers": 20, "orders": 1000, "items": 1000, "payments": 1000, "reviews": 400}


def numbers(spark: SparkSession, count: int) -> DataFrame:
    """1 to ``count``, spread over the cluster."""
    return spark.range(1, count + 1).select(F.col("id").alias("i"))


def _i() -> Column:
    return F.col("i").cast("long")


def _pick(values: Sequence[str]) -> Column:
    position = (_i() % len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), position + 1)


def _cycled(count: int) -> Column:
    return (_i() - 1) % count + 1


def _at(start: str, minutes: Column | int = 0, days: Column | int = 0) -> Column:
    zero = F.lit(0)
    shift = F.make_dt_interval(
        F.lit(days) if isinstance(days, int) else days.cast("int"),
        zero,
        zero,
        (F.lit(minutes) if isinstance(minutes, int) else minutes).cast("decimal(18,6)") * 60,
    )
    return F.lit(start).cast("timestamp_ntz") + shift


def _money(base: str, modulus: int, step: str) -> Column:
    value = F.lit(base).cast("decimal(10,2)") + (_i() % modulus).cast("int") * F.lit(step).cast("decimal(10,2)")
    return F.round(value, 2).cast("decimal(10,2)")


def _zip(base: int) -> Column:
    return F.lpad(((_i() + base) % 90000).cast("string"), 5, "0")


def customers(n: DataFrame) -> DataFrame:
    return n.select(
        numbered_id("cust-", _i(), 4).alias("customer_id"),
        numbered_id("uniq-", _i(), 4).alias("customer_unique_id"),
        _zip(10000).alias("customer_zip_code_prefix"),
        _pick([city for city, _ in CUSTOMER_PLACES]).alias("customer_city"),
        _pick([state for _, state in CUSTOMER_PLACES]).alias("customer_state"),
    )


def sellers(n: DataFrame) -> DataFrame:
    return n.select(
        numbered_id("sell-", _i(), 3).alias("seller_id"),
        _zip(20000).alias("seller_zip_code_prefix"),
        _pick([city for city, _ in SELLER_PLACES]).alias("seller_city"),
        _pick([state for _, state in SELLER_PLACES]).alias("seller_state"),
    )


def orders(n: DataFrame, customer_count: int = SIZES["customers"]) -> DataFrame:
    """Orders 17 minutes apart; early states have no carrier or delivery date yet."""
    tail = (_i() % 10).cast("int")
    minute = _i() * 17
    status = F.when(tail == 0, EARLY_STATUS[0]).when(tail == 1, EARLY_STATUS[1])
    return n.select(
        numbered_id("ord-", _i(), 5).alias("order_id"),
        numbered_id("cust-", _cycled(customer_count), 4).alias("customer_id"),
        status.when(tail == 2, EARLY_STATUS[2]).otherwise("delivered").alias("order_status"),
        _at(ORDER_START, minute).alias("order_purchase_timestamp"),
        _at(ORDER_START, minute + 10).alias("order_approved_at"),
        F.when(~tail.isin(0, 1), _at(ORDER_START, minute, _i() % 7 + 1)).alias(
            "order_delivered_carrier_date"
        ),
        F.when(~tail.isin(0, 1, 2), _at(ORDER_START, minute, _i() % 14 + 3)).alias(
            "order_delivered_customer_date"
        ),
        _at(ORDER_START, minute, _i() % 21 + 7).alias("order_estimated_delivery_date"),
    )


def order_items(n: DataFrame, seller_count: int = SIZES["sellers"], product_count: int = 500) -> DataFrame:
    return n.select(
        numbered_id("ord-", _i(), 5).alias("order_id"),
        F.lit(1).alias("order_item_id"),
        numbered_id("prod-", _i() % product_count + 1, 5).alias("product_id"),
        numbered_id("sell-", _cycled(seller_count), 3).alias("seller_id"),
        _at(ORDER_START, _i() * 17, 3).alias("shipping_limit_date"),
        _money("20.00", 97, "3.75").alias("price"),
        _money("5.00", 11, "1.25").alias("freight_value"),
    )


def order_payments(n: DataFrame) -> DataFrame:
    rates = F.when(_i() % 4 == 1, (_i() % 6 + 1).cast("int")).otherwise(F.lit(1))
    return n.select(
        numbered_id("ord-", _i(), 5).alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        _pick(PAYMENT_TYPES).alias("payment_type"),
        rates.alias("payment_installments"),
        _money("25.00", 97, "4.10").alias("payment_value"),
    )


def order_reviews(n: DataFrame) -> DataFrame:
    day = _i() % 30
    return n.select(
        numbered_id("rev-", _i(), 5).alias("review_id"),
        numbered_id("ord-", _i(), 5).alias("order_id"),
        (_i() % 5 + 1).cast("smallint").alias("review_score"),
        F.when(_i() % 3 != 0, F.concat(F.lit("Title "), _i())).alias("review_comment_title"),
        F.when(_i() % 4 != 0, F.concat(F.lit("Review message for order "), _i())).alias(
            "review_comment_message"
        ),
        _at(REVIEW_START, 0, day + 1).alias("review_creation_date"),
        F.when(_i() % 2 == 0, _at(REVIEW_START, 0, day + 2)).alias("review_answer_timestamp"),
    )


def demo_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All generated tables at the demo sizes."""
    made = {
        "customers": customers,
        "sellers": sellers,
        "orders": orders,
        "items": order_items,
        "payments": order_payments,
        "reviews": order_reviews,
    }
    return {name: build(numbers(spark, SIZES[name])) for name, build in made.items()}
