"""Exploratory tables: descriptions, joins, pivots, correlations, box statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.days import epoch_seconds
from tradewind.functions.quantiles import exact_quantiles, grouped_quantiles, quantile_values
from tradewind.functions.shaping import materialize, unpivot_row
from tradewind.operators.clean import FENCE_WIDTH
from tradewind.operators.kpis import order_sums

CORRELATED = {
    "items": ["price", "freight_value"],
    "payments": ["payment_value", "payment_installments"],
    "reviews": ["review_score"],
}


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    Timestamps are described as seconds since 1970 and have no deviation.
    """
    types = dict(df.dtypes)
    seconds = {c: epoch_seconds(F.col(c)) for c in columns if types[c].startswith("timestamp")}
    values = df.select(*[seconds.get(c, F.col(c).cast("double")).alias(c) for c in columns])
    stats = values.agg(
        *[
            F.struct(
                F.count(c).alias("value_count"),
                F.avg(c).alias("mean"),
                (F.lit(None).cast("double") if c in seconds else F.stddev_samp(c)).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    names = ["value_count", "mean", "std", "min", "max"]
    long = unpivot_row(stats, {c: {n: F.col(c)[n] for n in names} for c in columns}, "column_name")

    def quartile(p: float) -> Column:
        return F.max(F.when(F.col("probability") == p, F.col("value")))

    quartiles = (
        exact_quantiles(values, {c: [0.25, 0.5, 0.75] for c in columns})
        .groupBy(F.col("column").alias("column_name"))
        .agg(quartile(0.25).alias("q25"), quartile(0.5).alias("q50"), quartile(0.75).alias("q75"))
    )
    return long.join(quartiles, "column_name", "left").select(
        "column_name", "value_count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def orders_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the state and city of their customer."""
    return orders.join(customers.select("customer_id", "customer_state", "customer_city"), "customer_id")


def items_payments(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Every item line of an order with every payment of that order.

    Adaptive execution splits an order that is hot on either side.
    """
    return items.select("order_id", "price", "freight_value").join(
        payments.select("order_id", "payment_value", "payment_type"), "order_id"
    )


def state_revenue_stats(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Per state: item lines (an order without items counts once), revenue, average price and freight."""
    return (
        orders.select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .filter(F.col("customer_state").isNotNull())
        .join(order_sums(items), "order_id", "left")
        .groupBy("customer_state")
        .agg(
            F.sum(F.when(F.col("order_id").isNotNull(), F.coalesce("lines", F.lit(1)))).alias("total_orders"),
            F.coalesce(F.sum("price"), F.lit(0.0)).alias("total_revenue"),
            (F.sum("price") / F.nullif(F.sum("prices"), F.lit(0))).alias("avg_price"),
            (F.sum("freight") / F.nullif(F.sum("freights"), F.lit(0))).alias("avg_freight"),
        )
        .orderBy(F.col("total_revenue").desc(), "customer_state")
    )


def payment_type_stats(payments: DataFrame) -> DataFrame:
    """Per payment type: transactions, total and average value."""
    return (
        payments.filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(
            F.count("order_id").alias("total_transactions"),
            F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("total_value"),
            F.avg("payment_value").alias("avg_value"),
        )
        .orderBy(F.col("total_transactions").desc(), "payment_type")
    )


def status_by_year_pivot(
    orders: DataFrame, items: DataFrame, statuses: Sequence[str] | None = None
) -> DataFrame:
    """Years by order status, counting item lines (an order without items counts once).

    The columns are the statuses in the data; with ``statuses`` they are given, and any
    other status in the data is an error rather than left out.
    """
    counted = (
        orders.select("order_id", "order_status", F.year("order_purchase_timestamp").alias("order_year"))
        .filter(F.col("order_year").isNotNull() & F.col("order_status").isNotNull())
        .join(order_sums(items).select("order_id", "lines"), "order_id", "left")
        .withColumn("lines", F.coalesce("lines", F.lit(1)))
    )
    if statuses is not None:
        known = F.col("order_status").isin(list(statuses))
        refused = F.raise_error(F.concat(F.lit("unknown order status: "), F.col("order_status"))).cast("string")
        counted = counted.withColumn("order_status", F.when(known, F.col("order_status")).otherwise(refused))
    return (
        counted.groupBy("order_year")
        .pivot("order_status", None if statuses is None else list(statuses))
        .agg(F.sum("lines"))
        .fillna(0)
        .orderBy("order_year")
    )


def _moments(df: DataFrame, columns: Sequence[str], suffix: str, centers: dict[str, float]) -> DataFrame:
    """Per order: rows, and for single columns and pairs the sums a correlation needs."""
    x = {c: F.col(c).cast("double") - F.lit(centers[c]) for c in columns}
    sums = [F.count("*").alias(f"n_{suffix}")]
    for c in columns:
        sums += [F.count(c).alias(f"n_{c}"), F.sum(x[c]).alias(f"s_{c}"), F.sum(x[c] * x[c]).alias(f"q_{c}")]
    for a, b in combinations(columns, 2):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        sums += [
            F.count_if(both).alias(f"n_{a}_{b}"),
            F.sum(F.when(both, x[a])).alias(f"a_{a}_{b}"),
            F.sum(F.when(both, x[b])).alias(f"b_{a}_{b}"),
            F.sum(F.when(both, x[a] * x[a])).alias(f"aa_{a}_{b}"),
            F.sum(F.when(both, x[b] * x[b])).alias(f"bb_{a}_{b}"),
            F.sum(F.when(both, x[a] * x[b])).alias(f"ab_{a}_{b}"),
        ]
    moments = df.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(*sums)
    # doubles throughout: products of row counts outgrow 64-bit integers
    return moments.select("order_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in moments.columns[1:]])


def correlation_matrix(items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Pearson correlations over items joined to payments and, where present, reviews.

    An order with i items, p payments and r reviews stands for i * p * max(r, 1) joined
    rows.  Sums over those rows follow from sums per order, so the joined rows are never
    made.  Values are first shifted by the column averages, which leaves a correlation
    unchanged and keeps the sums of squares small.  NULLs are left out pair by pair.
    """
    sides = {"items": items, "payments": payments, "reviews": reviews}
    averages = reduce(
        DataFrame.unionByName,
        [
            unpivot_row(sides[s].agg(*[F.avg(c).alias(c) for c in cols]), {c: {"center": F.col(c)} for c in cols}, "name")
            for s, cols in CORRELATED.items()
        ],
    )
    centers = {r["name"]: r["center"] or 0.0 for r in averages.collect()}
    per_order = {s: _moments(sides[s], cols, s, centers) for s, cols in CORRELATED.items()}
    orders = (
        per_order["items"]
        .join(per_order["payments"], "order_id")
        .join(per_order["reviews"], "order_id", "left")
        .fillna(0)
        .withColumn("n_joined_reviews", F.greatest("n_reviews", F.lit(1.0)))
    )
    copies = {"items": F.col("n_items"), "payments": F.col("n_payments"), "reviews": F.col("n_joined_reviews")}
    side_of = {c: s for s, cols in CORRELATED.items() for c in cols}

    def others(*sides_used: str) -> Column:
        return reduce(lambda a, b: a * b, [n for s, n in copies.items() if s not in sides_used])

    pairs = {}
    aggregates = []
    for a, b in combinations(side_of, 2):
        sa, sb = side_of[a], side_of[b]
        if sa == sb:
            weight = others(sa)
            n, s_a, s_b, aa, bb, ab = [F.col(f"{k}_{a}_{b}") * weight for k in ("n", "a", "b", "aa", "bb", "ab")]
        else:
            weight = others(sa, sb)
            n = F.col(f"n_{a}") * F.col(f"n_{b}") * weight
            s_a = F.col(f"s_{a}") * F.col(f"n_{b}") * weight
            s_b = F.col(f"s_{b}") * F.col(f"n_{a}") * weight
            aa = F.col(f"q_{a}") * F.col(f"n_{b}") * weight
            bb = F.col(f"q_{b}") * F.col(f"n_{a}") * weight
            ab = F.col(f"s_{a}") * F.col(f"s_{b}") * weight
        key = f"{a}__{b}"
        sums = [F.sum(v).alias(k) for k, v in zip("n a b aa bb ab".split(), (n, s_a, s_b, aa, bb, ab))]
        aggregates.append(F.struct(*sums).alias(key))
        m = F.col(key)
        spread = (m["n"] * m["aa"] - m["a"] * m["a"]) * (m["n"] * m["bb"] - m["b"] * m["b"])
        correlation = F.when(spread > 0, (m["n"] * m["ab"] - m["a"] * m["b"]) / F.sqrt(spread))
        pairs[key] = {"column_a": F.lit(a), "column_b": F.lit(b), "correlation": correlation}
    return unpivot_row(orders.agg(*aggregates), pairs, "pair").drop("pair")


def value_counts(df: DataFrame, column: str, top: int | None = None, by_value: bool = False) -> DataFrame:
    """Rows per non-NULL value, most frequent first or in value order."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    ordered = counted.orderBy("value") if by_value else counted.orderBy(F.col("rows").desc(), "value")
    return ordered if top is None else ordered.limit(top)


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whisker ends (the extreme values within 1.5 IQR) and outlier count."""
    q1, median, q3 = quantile_values(df, {column: [0.25, 0.5, 0.75]})[column]
    v = F.col(column)
    if q1 is None:
        inside = F.lit(None).cast("boolean")
    else:
        reach = FENCE_WIDTH * (q3 - q1)
        inside = v.between(q1 - reach, q3 + reach)
    return df.agg(
        *[F.lit(q).cast("double").alias(n) for n, q in (("q1", q1), ("median", median), ("q3", q3))],
        F.min(F.when(inside, v)).cast("double").alias("whisker_low"),
        F.max(F.when(inside, v)).cast("double").alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_stats_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Box statistics of a column per group; groups without values or with a NULL key have none.

    Reads ``df`` once per round of the quantiles, so pass a plain scan or a written table.
    """
    quartiles = grouped_quantiles(df, keys, column, [0.25, 0.5, 0.75])
    q1, median, q3 = (F.col("quantiles")[k] for k in range(3))
    reach, v = (q3 - q1) * FENCE_WIDTH, F.col(column).cast("double")
    inside = v.between(q1 - reach, q3 + reach)
    per_group = df.select(*keys, column).join(quartiles, list(keys)).groupBy(*keys, q1.alias("q1"), median.alias("median"), q3.alias("q3"))
    return per_group.agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside & ~F.isnan(v)).alias("outliers"),
    ).orderBy(*keys)


def score_box_by_year(reviews_full: DataFrame) -> DataFrame:
    """Box statistics of review scores per purchase year."""
    scores = reviews_full.select(F.year("order_purchase_timestamp").alias("year"), "review_score")
    return box_stats_by(materialize(scores, "scores-by-year"), ["year"], "review_score")


def price_box_by_state(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Box statistics of item prices per customer state."""
    placed = orders.select("order_id", "customer_id").join(customers.select("customer_id", "customer_state"), "customer_id")
    prices = items.select("order_id", "price").join(placed, "order_id").select("customer_state", "price")
    return box_stats_by(materialize(prices, "prices-by-state"), ["customer_state"], "price")


def lag_pairs(monthly: DataFrame) -> DataFrame:
    """Each month's order count with the next one's; takes the small monthly table."""
    following = F.lead("order_count").over(Window.orderBy("month"))
    return monthly.withColumn("next_count", following).filter("next_count IS NOT NULL")


def lag_autocorrelation(monthly: DataFrame) -> DataFrame:
    """Correlation of a month's order count with the next one's."""
    return lag_pairs(monthly).agg(F.corr("order_count", "next_count").alias("lag1_correlation"))
