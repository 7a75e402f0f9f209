"""Weekly revenue features, a random forest over them, and batch scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.functions.days import floor_days, week_start
from tradewind.functions.shaping import left_join_fanout
from tradewind.operators.kpis import order_sums

TARGET = "total_revenue"
# What the models are trained on.
SERVICE_FEATURES = [
    "order_count",
    "avg_price",
    "avg_freight",
    "avg_payment_value",
    "avg_installments",
    "avg_review_score",
    "avg_delivery_days",
    "avg_delivery_delay",
]
FEATURES = [*SERVICE_FEATURES, "month_num", "week_num", "year_num"]
TEST_SHARE = 0.2
SEED = 42
# Enough bins that a split point of a weekly series is found almost exactly.
MAX_BINS = 256
ROWS_PER_PARTITION = 100_000


def order_delivery_features(orders: DataFrame) -> DataFrame:
    """Adds delivery days and delay against the estimate, both rounded down."""
    delivered = F.col("order_delivered_customer_date")
    return orders.withColumns(
        {
            "delivery_days": floor_days(delivered, F.col("order_purchase_timestamp")),
            "delivery_delay": floor_days(delivered, F.col("order_estimated_delivery_date")),
        }
    )


def payment_per_order(payments: DataFrame) -> DataFrame:
    """Σ payment and average installments per order."""
    return (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("payment_value"),
            F.avg("payment_installments").alias("payment_installments"),
        )
    )


def order_feature_rows(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Orders with delivery features, repeated per item line and review.

    ``weekly_features`` gives the same averages without building these rows.
    """
    featured = order_delivery_features(orders).withColumn("week", week_start(F.col("order_purchase_timestamp")))
    paid = featured.join(payment_per_order(payments), "order_id", "left")
    lines = items.select("order_id", "price", "freight_value")
    return left_join_fanout(paid, orders, "order_id", lines, reviews.select("order_id", "review_score"))


def weekly_features(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    customers: DataFrame | None = None,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Revenue, orders and averages per Monday-to-Sunday week; rows with gaps are dropped.

    Averages run over ``order_feature_rows``: an order with i lines and r reviews
    weighs max(i,1) * max(r,1).  Each side is summed per order first, so those rows
    are never made.  ``group_cols`` from ``customers`` (such as customer_state) give
    one series per group instead of a single one.
    """
    per_review = reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"), F.sum("review_score").alias("score"), F.count("review_score").alias("scored")
    )
    per_order = (
        order_delivery_features(orders)
        .filter(F.col("order_purchase_timestamp").isNotNull())
        .select(
            "order_id",
            "customer_id",
            week_start(F.col("order_purchase_timestamp")).alias("week"),
            "delivery_days",
            "delivery_delay",
        )
        .join(order_sums(items), "order_id", "left")
        .join(payment_per_order(payments), "order_id", "left")
        .join(per_review, "order_id", "left")
    )
    if group_cols:
        per_order = per_order.join(customers.select("customer_id", *group_cols), "customer_id").dropna(
            subset=list(group_cols)
        )
    lines = F.coalesce("lines", F.lit(1)).cast("double")
    copies = F.coalesce("reviews", F.lit(1)).cast("double")

    def mean(total: Column, number: Column) -> Column:
        return F.sum(total) / F.nullif(F.sum(number), F.lit(0.0))

    def row_mean(column: str) -> Column:
        weight = lines * copies
        return mean(F.col(column) * weight, F.when(F.col(column).isNotNull(), weight).otherwise(0.0))

    return (
        per_order.groupBy("week", *group_cols)
        .agg(
            F.coalesce(F.sum(F.col("price") * copies), F.lit(0.0)).alias(TARGET),
            F.count_distinct("order_id").alias("order_count"),
            mean(F.col("price") * copies, F.col("prices") * copies).alias("avg_price"),
            mean(F.col("freight") * copies, F.col("freights") * copies).alias("avg_freight"),
            row_mean("payment_value").alias("avg_payment_value"),
            row_mean("payment_installments").alias("avg_installments"),
            mean(F.col("score") * lines, F.col("scored") * lines).alias("avg_review_score"),
            row_mean("delivery_days").alias("avg_delivery_days"),
            row_mean("delivery_delay").alias("avg_delivery_delay"),
        )
        .dropna()
    )


def calendar_features(weekly: DataFrame) -> DataFrame:
    """Adds month, year and ISO week of the week's last day (Sunday)."""
    sunday = F.date_add("week", 6)
    return weekly.withColumns(
        {"month_num": F.month(sunday), "year_num": F.year(sunday), "week_num": F.weekofyear(sunday)}
    )


def time_split(weekly: DataFrame) -> DataFrame:
    """Adds ``is_test``: the last fifth of the weeks, rounded up.

    The window only sees the distinct weeks.
    """
    place = F.row_number().over(Window.orderBy("week"))
    weeks = F.count("*").over(Window.partitionBy())
    calendar = (
        weekly.select("week")
        .distinct()
        .select("week", (place > weeks - F.ceil(F.lit(TEST_SHARE) * weeks)).alias("is_test"))
    )
    return weekly.join(calendar, "week")


def train_forest(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    group_cols: Sequence[str] = (),
    trees: int = 100,
    depth: int = 5,
    seed: int = SEED,
) -> PipelineModel:
    """A random forest that considers every feature at each split.

    Rows are laid out by week (and group) in a number of partitions that follows from their number, so that the
    bootstrap depends neither on the input files nor on the shuffle width of the session.
    """
    forest = RandomForestRegressor(
        labelCol=TARGET,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=1,
        featureSubsetStrategy="all",
        maxBins=MAX_BINS,
        seed=seed,
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    keys = ["week", *group_cols]
    partitions = max(1, math.ceil(train.count() / ROWS_PER_PARTITION))
    laid_out = train.select(*keys, *features, TARGET).repartition(partitions, *keys).sortWithinPartitions(*keys)
    return Pipeline(stages=[assembler, forest]).fit(laid_out)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``prediction`` to feature rows."""
    return model.transform(rows).drop("features")


def evaluate(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE and R² of predictions, in one pass."""
    error = F.col(TARGET) - F.col("prediction")
    spread = F.var_pop(TARGET) * F.count("*")
    return predictions.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def feature_importance(model: PipelineModel) -> DataFrame:
    """Features by importance."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(((n, float(w)) for n, w in zip(names, weights)), key=lambda r: (-r[1], r[0]))
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def residuals(predictions: DataFrame) -> DataFrame:
    """Actual, predicted and their difference, in time order."""
    keys = [c for c in predictions.columns if c in ("week", "customer_state")]
    return predictions.select(
        *keys,
        F.col(TARGET).alias("actual"),
        F.col("prediction").alias("predicted"),
        (F.col(TARGET) - F.col("prediction")).alias("residual"),
    ).orderBy(*keys)


def score_batch(model_path: str, rows: DataFrame, metrics: DataFrame) -> DataFrame:
    """Rounded predictions of a saved model for a table of feature rows, with its test errors."""
    model = PipelineModel.load(model_path)
    quality = metrics.select(F.round("mae", 2).alias("mae"), F.round("r2", 4).alias("r2"))
    return predict(model, rows).withColumns(
        {
            "prediction": F.round("prediction", 2),
            "mae": quality.select("mae").scalar(),
            "r2": quality.select("r2").scalar(),
        }
    )
