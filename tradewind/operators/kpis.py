"""Headline numbers and the small tables behind the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.days import floor_days, month_label, trunc_days

EXPLORE_COLUMNS = ["order_id", "product_id", "seller_id", "price", "freight_value"]


def _one_row(spark, **values: DataFrame) -> DataFrame:
    """One row from several one-cell aggregates."""
    return spark.range(1).select(*[cell.scalar().alias(name) for name, cell in values.items()])


def kpi_summary(orders: DataFrame, items: DataFrame, reviews: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, revenue, average rating and customers.

    ``total_customers`` counts order-scoped customer ids, ``unique_persons`` people.
    """
    return _one_row(
        orders.sparkSession,
        total_orders=orders.agg(F.count("*")),
        total_revenue=items.agg(F.round(F.sum("price"), 2)),
        avg_rating=reviews.agg(F.round(F.avg("review_score"), 2)),
        total_customers=customers.agg(F.count_distinct("customer_id")),
        unique_persons=customers.agg(F.count_distinct("customer_unique_id")),
    )


def kpi_dashboard(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders, revenue, average rating and average delivery time in days rounded down."""
    days = floor_days(F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp"))
    return _one_row(
        orders.sparkSession,
        total_orders=orders.agg(F.count("*")),
        total_revenue=items.agg(F.coalesce(F.round(F.sum("price"), 2), F.lit(0.0))),
        avg_rating=reviews.agg(F.round(F.avg("review_score"), 6)),
        avg_delivery_days=orders.agg(F.round(F.avg(days), 6)),
    )


def avg_delivery_days(orders: DataFrame) -> DataFrame:
    """Average days from purchase to delivery, each cut towards zero."""
    days = trunc_days(F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp"))
    delivered = orders.filter(F.col("order_delivered_customer_date").isNotNull())
    return delivered.agg(F.round(F.avg(days), 6).alias("avg_delivery_days"))


def order_sums(items: DataFrame) -> DataFrame:
    """One row per order: lines, Σ price, Σ freight and how many cells went into each.

    Joining these instead of the lines keeps an order with many lines a single row.
    """
    return items.groupBy("order_id").agg(
        F.count("*").alias("lines"),
        F.sum("price").alias("price"),
        F.count("price").alias("prices"),
        F.sum("freight_value").alias("freight"),
        F.count("freight_value").alias("freights"),
    )


def revenue_by_state(items: DataFrame, orders: DataFrame, customers: DataFrame, top: int = 10) -> DataFrame:
    """States by Σ price of their orders' items."""
    return (
        orders.select("order_id", "customer_id")
        .join(order_sums(items).select("order_id", "price"), "order_id")
        .join(customers.select("customer_id", F.col("customer_state").alias("state")), "customer_id")
        .groupBy("state")
        .agg(F.sum("price").alias("sum_price"))
        .orderBy(F.col("sum_price").desc_nulls_first(), F.col("state").asc_nulls_last())
        .limit(top)
        .select("state", F.round("sum_price", 2).alias("revenue"))
    )


def revenue_by_state_all(orders: DataFrame, customers: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """As above, but a state without items counts as zero and orders without a state are left out."""
    return (
        orders.select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .filter(F.col("customer_state").isNotNull())
        .join(order_sums(items).select("order_id", "price"), "order_id", "left")
        .groupBy("customer_state")
        .agg(F.coalesce(F.sum("price"), F.lit(0.0)).alias("sum_price"))
        .orderBy(F.col("sum_price").desc(), "customer_state")
        .limit(top)
        .select("customer_state", F.round("sum_price", 2).alias("revenue"))
    )


def segment_counts(segments: DataFrame) -> DataFrame:
    """Persons per segment, largest first."""
    return segments.groupBy("segment").agg(F.count("*").alias("customers")).orderBy(F.col("customers").desc(), "segment")


def segment_summary(segments: DataFrame) -> DataFrame:
    """Per segment: persons and average recency, frequency and spend."""
    return (
        segments.groupBy("segment")
        .agg(
            F.count("customer_unique_id").alias("customers"),
            F.round(F.avg("recency"), 2).alias("avg_recency"),
            F.round(F.avg("frequency"), 2).alias("avg_frequency"),
            F.round(F.avg("monetary"), 2).alias("avg_monetary"),
        )
        .orderBy("segment")
    )


def payment_type_counts(payments: DataFrame) -> DataFrame:
    """Transactions per payment type, most used first."""
    return (
        payments.filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(F.count("order_id").alias("transactions"))
        .orderBy(F.col("transactions").desc(), "payment_type")
    )


def monthly_order_counts(orders: DataFrame) -> DataFrame:
    """Orders per month; orders without a purchase time are left out."""
    return (
        orders.filter(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month_label(F.col("order_purchase_timestamp")).alias("month"))
        .agg(F.count("order_id").alias("order_count"))
        .orderBy("month")
    )


def monthly_avg_rating(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Average score per purchase month."""
    return (
        reviews.select("order_id", "review_score")
        .join(orders.select("order_id", "order_purchase_timestamp"), "order_id")
        .groupBy(month_label(F.col("order_purchase_timestamp")).alias("month"))
        .agg(F.round(F.avg("review_score"), 6).alias("avg_rating"))
        .orderBy(F.col("month").asc_nulls_last())
    )


def matching_items(
    items: DataFrame,
    orders: DataFrame,
    status: str = "All",
    price_lo: float | None = None,
    price_hi: float | None = None,
) -> DataFrame:
    """Items in a price range, optionally of one order status.

    An open end of the range keeps every priced item on that side.
    """
    found = items.select(*EXPLORE_COLUMNS).filter(F.col("price").isNotNull())
    if price_lo is not None:
        found = found.filter(F.col("price") >= price_lo)
    if price_hi is not None:
        found = found.filter(F.col("price") <= price_hi)
    if status != "All":
        wanted = orders.filter(F.col("order_status") == status).select("order_id")
        found = found.join(wanted, "order_id", "left_semi")
    return found


def explore_items(
    items: DataFrame,
    orders: DataFrame,
    status: str = "All",
    price_lo: float | None = None,
    price_hi: float | None = None,
    limit: int = 100,
) -> DataFrame:
    """The first matching items, by all shown columns."""
    return matching_items(items, orders, status, price_lo, price_hi).orderBy(*EXPLORE_COLUMNS).limit(limit)


def explore_count(
    items: DataFrame, orders: DataFrame, status: str = "All", price_lo: float | None = None, price_hi: float | None = None
) -> DataFrame:
    """Number of matching items, beside the few that are shown."""
    return matching_items(items, orders, status, price_lo, price_hi).agg(F.count("*").alias("matching_items"))


def explore_statuses(orders: DataFrame) -> DataFrame:
    """The order statuses to choose from."""
    return orders.select("order_status").distinct()


def explore_bounds(items: DataFrame) -> DataFrame:
    """Lowest and highest price to choose from."""
    return items.agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"))
