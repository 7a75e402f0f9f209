"""The business reports: sellers, growth, delivery, repeat buyers, cancellations.

Facts are reduced to one row per report key before they meet a dimension table, so a
seller, product or category that owns most of the rows is merged on the map side and
never meets a join.  Windows without a partition only ever see a top-k or a calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.days import month_label, trunc_days
from tradewind.functions.rounding import percent, ratio

MIN_CATEGORY_ORDERS = 50
# Names of the buyer classes.
BUYER_CLASSES = {1: "One-Time Buyer", 2: "Repeat Buyer (2x)", 3: "Loyal Buyer (3x+)"}


def top_sellers_ranked(items: DataFrame, sellers: DataFrame, top: int = 10) -> DataFrame:
    """Sellers by rounded revenue (price + freight) with ties kept at the cut.

    A repeated seller row counts its revenue again, as joining the lines would.
    """
    per_seller = items.groupBy("seller_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("revenue"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    places = sellers.groupBy("seller_id", "seller_city", "seller_state").agg(F.count("*").alias("copies"))
    ranked = (
        per_seller.join(places, "seller_id")
        .withColumn("total_revenue", F.round(F.col("revenue") * F.col("copies"), 2))
        .withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("total_revenue").desc_nulls_first())))
    )
    return (
        ranked.filter(F.col("revenue_rank") <= top)
        .select("revenue_rank", "seller_id", "seller_city", "seller_state", "total_revenue", "total_orders")
        .orderBy("revenue_rank", "seller_id")
    )


def top_sellers_limit(items: DataFrame, top: int = 10) -> DataFrame:
    """Exactly ``top`` sellers by Σ price, ranked; seller_id breaks ties at the cut."""
    per_seller = items.groupBy("seller_id").agg(F.sum("price").alias("revenue"))
    best = per_seller.orderBy(F.col("revenue").desc_nulls_first(), "seller_id").limit(top)
    rank = F.rank().over(Window.orderBy(F.col("revenue").desc_nulls_first()))
    return best.select("seller_id", F.round("revenue", 2).alias("total_revenue"), rank.alias("revenue_rank"))


def _orders_per_month(orders: DataFrame) -> DataFrame:
    return orders.groupBy(month_label(F.col("order_purchase_timestamp")).alias("order_month")).agg(
        F.count("order_id").alias("total_orders")
    )


def monthly_growth(orders: DataFrame) -> DataFrame:
    """Orders per month and the change in percent from the previous month that has orders."""
    monthly = _orders_per_month(orders.filter(F.col("order_purchase_timestamp").isNotNull()))
    previous = F.lag("total_orders", 1).over(Window.orderBy("order_month"))
    return (
        monthly.withColumn("prev_month_orders", previous)
        .withColumn(
            "growth_rate_pct", percent(F.col("total_orders") - F.col("prev_month_orders"), F.col("prev_month_orders"))
        )
        .orderBy("order_month")
    )


def monthly_orders_lag(orders: DataFrame) -> DataFrame:
    """Orders per month with the previous count; orders without a date form the last group."""
    in_time = F.col("month").asc_nulls_last()
    return (
        _orders_per_month(orders)
        .withColumnRenamed("order_month", "month")
        .withColumn("prev_month", F.lag("total_orders").over(Window.orderBy(in_time)))
        .orderBy(in_time)
    )


def _delays(orders: DataFrame, customers: DataFrame) -> DataFrame:
    delay = trunc_days(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return (
        orders.filter(F.col("order_delivered_customer_date").isNotNull())
        .select("order_id", "customer_id", delay.alias("delay_days"))
        .join(customers.select("customer_id", "customer_state"), "customer_id")
    )


def delivery_delay_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivery against estimate in whole days (cut towards zero) per customer state."""
    dated = orders.filter(F.col("order_estimated_delivery_date").isNotNull())
    days = F.col("delay_days")
    return (
        _delays(dated, customers)
        .groupBy("customer_state")
        .agg(
            F.count("order_id").alias("total_orders"),
            ratio(F.sum(days), F.count(days)).alias("avg_delay_days"),
            F.min(days).cast("double").alias("min_delay_days"),
            F.max(days).cast("double").alias("max_delay_days"),
            F.when(F.sum(days) > 0, "Delayed").otherwise("On Time").alias("delivery_status"),
        )
        .orderBy(F.col("avg_delay_days").desc_nulls_first(), F.col("customer_state").asc_nulls_last())
    )


def delivery_delay_top10(orders: DataFrame, customers: DataFrame, top: int = 10) -> DataFrame:
    """States with the largest average delay; a state without estimates comes first."""
    days = F.col("delay_days")
    return (
        _delays(orders, customers)
        .groupBy("customer_state")
        .agg(ratio(F.sum(days), F.count(days)).alias("avg_delay"))
        .orderBy(F.col("avg_delay").desc_nulls_first(), F.col("customer_state").asc_nulls_last())
        .limit(top)
    )


def orders_per_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders per person (customer_id only identifies a single order)."""
    return (
        orders.select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.count("order_id").alias("order_count"))
    )


def _buyer_types(orders: DataFrame, customers: DataFrame) -> DataFrame:
    n = F.col("order_count")
    buyer = F.when(n == 1, BUYER_CLASSES[1]).when(n == 2, BUYER_CLASSES[2]).otherwise(BUYER_CLASSES[3])
    return orders_per_person(orders, customers).groupBy(buyer.alias("buyer_type"))


def repeat_purchase_rate(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Persons with one, two or more orders, and their share of all persons."""
    counted = _buyer_types(orders, customers).agg(F.count("customer_unique_id").alias("customer_count"))
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return counted.withColumn("percentage", percent(F.col("customer_count"), everyone)).orderBy(
        F.col("customer_count").desc(), "buyer_type"
    )


def repeat_purchase_counts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Persons per buyer class."""
    return _buyer_types(orders, customers).agg(F.count("*").alias("customer_count"))


def _lines_per_product(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item lines, and item lines of canceled orders, per product."""
    return (
        items.select("order_id", "product_id")
        .join(orders.select("order_id", "order_status"), "order_id")
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("lines"),
            F.count_if(F.col("order_status") == "canceled").alias("canceled"),
        )
    )


def category_cancellation(
    orders: DataFrame, items: DataFrame, products: DataFrame, translation: DataFrame, top: int = 15
) -> DataFrame:
    """Categories by share of item lines in canceled orders, with the next lower rate.

    Counts are item lines, not distinct orders.  Rounding keeps the order of the
    rates, so the first ``top`` + 1 rows hold every "next" value that is shown.
    """
    named = products.select("product_id", "product_category_name").join(translation, "product_category_name", "left")
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    rates = (
        _lines_per_product(orders, items)
        .join(named.select("product_id", category.alias("category")), "product_id")
        .groupBy("category")
        .agg(F.sum("lines").alias("total_orders"), F.sum("canceled").alias("cancelled_orders"))
        .filter(F.col("total_orders") >= MIN_CATEGORY_ORDERS)
        .withColumn("rate", F.col("cancelled_orders") * F.lit(100.0).cast("double") / F.col("total_orders"))
        .withColumn("cancellation_rate_pct", percent(F.col("cancelled_orders"), F.col("total_orders")))
    )
    by_rate = [F.col("rate").desc(), F.col("category")]
    shown = rates.orderBy(*by_rate).limit(top + 1)
    following = F.lead("cancellation_rate_pct").over(Window.orderBy(*by_rate))
    return (
        shown.withColumn("next_category_rate", following)
        .orderBy(*by_rate)
        .limit(top)
        .select("category", "total_orders", "cancelled_orders", "cancellation_rate_pct", "next_category_rate")
    )


def category_cancellation_raw(orders: DataFrame, items: DataFrame, products: DataFrame, top: int = 10) -> DataFrame:
    """Cancellation rate per untranslated category; products without one form a group."""
    return (
        _lines_per_product(orders, items)
        .join(products.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("lines").alias("total_orders"), F.sum("canceled").alias("cancelled"))
        .filter(F.col("total_orders") >= MIN_CATEGORY_ORDERS)
        .withColumn("cancellation_rate_pct", percent(F.col("cancelled"), F.col("total_orders")))
        .orderBy(F.col("cancellation_rate_pct").desc(), F.col("product_category_name").asc_nulls_last())
        .limit(top)
    )
