"""Review scores over time and by product category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.days import month_label
from tradewind.functions.rounding import percent

MIN_CATEGORY_REVIEWS = 100


def item_category(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Item lines with a category: the English name, else the native one, else 'unknown'."""
    named = products.select("product_id", "product_category_name").join(translation, "product_category_name", "left")
    return items.join(named, "product_id", "left").select(
        *[c for c in ("order_id", "order_item_id", "product_id") if c in items.columns],
        F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown")).alias("category"),
    )


def first_lines(items: DataFrame) -> DataFrame:
    """The first item line of each order, by line number and product: one row per order, before any join.

    An aggregate instead of a window, so an order with many lines is merged map-side.
    """
    first = items.groupBy("order_id").agg(F.min(F.struct("order_item_id", "product_id")).alias("first"))
    return first.select("order_id", "first.*")


def order_category(categorised: DataFrame) -> DataFrame:
    """One category per order: that of its first item line.

    Pass ``item_category(first_lines(items), ...)``, so that only one line per order meets the products.
    """
    return (
        categorised.groupBy("order_id")
        .agg(F.min(F.struct("order_item_id", "product_id", "category")).alias("first"))
        .select("order_id", F.col("first.category").alias("category"))
    )


def reviews_full(reviews: DataFrame, orders: DataFrame, categories: DataFrame) -> DataFrame:
    """Reviews with purchase time and the category of their order."""
    return (
        reviews.select("order_id", "review_score", "review_creation_date")
        .join(orders.select("order_id", "order_purchase_timestamp"), "order_id")
        .join(categories, "order_id", "left")
        .withColumn("category", F.coalesce("category", F.lit("unknown")))
    )


def _star_share(stars: int) -> Column:
    """Reviews with this score in percent of all rows, unscored ones included."""
    return percent(F.count_if(F.col("review_score") == stars), F.count("*"), 4)


def monthly_rating_trend(full: DataFrame) -> DataFrame:
    """Average, number and deviation of scores per purchase month, with 5-star and 1-star share."""
    return (
        full.filter(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month_label(F.col("order_purchase_timestamp")).alias("month"))
        .agg(
            F.avg("review_score").alias("avg_rating"),
            F.count("review_score").alias("total_reviews"),
            F.stddev_samp("review_score").alias("rating_std"),
            _star_share(5).alias("pct_5star"),
            _star_share(1).alias("pct_1star"),
        )
        .orderBy("month")
    )


def best_worst_month(full: DataFrame) -> DataFrame:
    """Overall average, and the months with the best and worst one (earliest on ties)."""
    monthly = (
        full.groupBy(month_label(F.col("order_purchase_timestamp")).alias("month"))
        .agg(F.sum("review_score").alias("score"), F.count("review_score").alias("n"))
        .withColumn("rating", F.when(F.col("month").isNotNull(), F.col("score") / F.nullif(F.col("n"), F.lit(0))))
    )
    # one pass over the calendar; struct order breaks ties by the earlier month
    best = F.min(F.when(F.col("rating").isNotNull(), F.struct((-F.col("rating")).alias("r"), F.col("month"))))
    worst = F.min(F.when(F.col("rating").isNotNull(), F.struct(F.col("rating").alias("r"), F.col("month"))))
    return monthly.agg(
        (F.sum("score") / F.nullif(F.sum("n"), F.lit(0))).alias("overall_rating"),
        best.alias("best"),
        worst.alias("worst"),
    ).select(
        "overall_rating",
        F.col("best.month").alias("best_month"),
        (-F.col("best.r")).alias("best_rating"),
        F.col("worst.month").alias("worst_month"),
        F.col("worst.r").alias("worst_rating"),
    )


def category_ratings(full: DataFrame, min_reviews: int = MIN_CATEGORY_REVIEWS) -> DataFrame:
    """Average score per category with enough reviews, best first."""
    return (
        full.groupBy("category")
        .agg(
            F.avg("review_score").alias("avg_rating"),
            F.count("review_score").alias("total_reviews"),
            _star_share(5).alias("pct_5star"),
            _star_share(1).alias("pct_1star"),
        )
        .filter(F.col("total_reviews") >= min_reviews)
        .orderBy(F.col("avg_rating").desc(), "category")
    )


def category_top_bottom(ratings: DataFrame, top: int = 10) -> DataFrame:
    """The first and the last ``top`` categories of the rating table."""
    best = ratings.orderBy(F.col("avg_rating").desc(), "category").limit(top)
    worst = ratings.orderBy("avg_rating", F.col("category").desc()).limit(top)
    return best.select(F.lit("top").alias("side"), "*").unionByName(worst.select(F.lit("bottom").alias("side"), "*"))


def _score_pivot(full: DataFrame, row: Column, name: str) -> DataFrame:
    counted = full.select("order_id", "review_score", row.alias(name)).filter(
        F.col(name).isNotNull() & F.col("review_score").isNotNull()
    )
    # the columns are the scores in the data
    pivoted = counted.groupBy(name).pivot("review_score").agg(F.count("order_id")).fillna(0)
    return pivoted.select(name, *[F.col(f"`{s}`").alias(f"Score_{s}") for s in pivoted.columns[1:]]).orderBy(name)


def score_by_year_pivot(full: DataFrame) -> DataFrame:
    """Purchase years by score, counting reviews."""
    return _score_pivot(full, F.year("order_purchase_timestamp"), "year")


def score_by_month_pivot(full: DataFrame) -> DataFrame:
    """Purchase months by score, counting reviews."""
    return _score_pivot(full, month_label(F.col("order_purchase_timestamp")), "month")


def star_share_trend(trend: DataFrame) -> DataFrame:
    """5-star and 1-star share per month."""
    return trend.select("month", "pct_5star", "pct_1star")
