"""The whole batch: load, clean, report, explore, segment, forecast, rate.

One Spark application; every stage writes Parquet that the next one reads, and the
first failing stage stops the run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.shaping import ROW_ORDER, materialize
from tradewind.operators import answers, clean, explore, forecast, insights, kpis, ratings, rfm
from tradewind.sources.tables import scan_table, table_profile, write_replace

Frames = dict[str, DataFrame]


class Stages:
    """Writes the output of each stage below one folder and keeps what was written."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.written: list[tuple[str, str, DataFrame]] = []

    def save(self, stage: str, frames: Mapping[str, DataFrame]) -> Frames:
        saved = {}
        for name, df in frames.items():
            path = f"{self.folder}/{stage}/{name}"
            write_replace(df, path)
            saved[name] = scan_table(self.spark, path)
            self.written.append((stage, name, saved[name]))
        return saved


def load_stage(s: Stages, raw: Frames) -> Frames:
    return s.save("raw", raw)


def clean_stage(s: Stages, raw: Frames) -> Frames:
    cleaned, report = clean.clean_tables(raw, write=lambda name, df: s.save("clean", {name: df})[name])
    s.save("reports", {"cleaning": report})
    return cleaned | s.save("clean", {n: df.drop(ROW_ORDER) for n, df in raw.items() if n not in cleaned})


def insight_stage(s: Stages, t: Frames) -> Frames:
    orders, customers, items = t["orders"], t["customers"], t["order_items"]
    return s.save(
        "insights",
        {
            "top_sellers": insights.top_sellers_ranked(items, t["sellers"]),
            "monthly_growth": insights.monthly_growth(orders),
            "delivery_delay": insights.delivery_delay_by_state(orders, customers),
            "repeat_purchase": insights.repeat_purchase_rate(orders, customers),
            "cancellation": insights.category_cancellation(
                orders, items, t["products"], t["product_category_translation"]
            ),
        },
    )


def explore_stage(s: Stages, t: Frames) -> Frames:
    orders, customers, items = t["orders"], t["customers"], t["order_items"]
    payments, reviews = t["order_payments"], t["order_reviews"]
    monthly = kpis.monthly_order_counts(orders)
    return s.save(
        "explore",
        {
            "kpis": kpis.kpi_dashboard(orders, items, reviews),
            "describe_items": explore.describe_numeric(items, ["price", "freight_value"]),
            "describe_payments": explore.describe_numeric(payments, ["payment_value", "payment_installments"]),
            "state_revenue": explore.state_revenue_stats(orders, customers, items),
            "payment_types": explore.payment_type_stats(payments),
            "status_by_year": explore.status_by_year_pivot(orders, items),
            "correlation": explore.correlation_matrix(items, payments, reviews),
            "statuses": explore.value_counts(orders, "order_status"),
            "categories": explore.value_counts(t["products"], "product_category_name", top=10),
            "scores": explore.value_counts(reviews, "review_score", by_value=True),
            "price_box": explore.box_stats(items, "price"),
            "monthly_orders": monthly,
            "lag_pairs": explore.lag_pairs(monthly),
        },
    )


def segment_stage(s: Stages, t: Frames) -> Frames:
    base = rfm.rfm_base(t["orders"], t["customers"], t["order_payments"])
    persons = s.save("segments", {"rfm": rfm.rfm_values(base)})["rfm"]
    segments = s.save("segments", {"rfm_segments": rfm.rfm_segments(persons)})["rfm_segments"]
    return s.save(
        "segments",
        {
            "elbow": rfm.elbow(persons),
            "scores": rfm.rfm_score_distribution(segments),
            "clusters": rfm.cluster_summary(segments),
            "profile": rfm.segment_profile(segments),
            "answers": answers.answer_metrics(t, segments),
        },
    )


def forecast_stage(s: Stages, t: Frames) -> Frames:
    weekly = forecast.weekly_features(t["orders"], t["order_items"], t["order_payments"], t["order_reviews"])
    # written first: the split reads the weeks twice
    split = forecast.time_split(forecast.calendar_features(materialize(weekly, "weekly-features")))
    rows = s.save("forecast", {"weekly": split})["weekly"]
    model = forecast.train_forest(rows.filter("NOT is_test"))
    model.write().overwrite().save(f"{s.folder}/forecast/model")
    predictions = forecast.predict(model, rows.filter("is_test"))
    return s.save(
        "forecast",
        {
            "metrics": forecast.evaluate(predictions),
            "importance": forecast.feature_importance(model),
            "residuals": forecast.residuals(predictions),
        },
    )


def rating_stage(s: Stages, t: Frames) -> Frames:
    firsts = ratings.first_lines(t["order_items"])
    categorised = ratings.item_category(firsts, t["products"], t["product_category_translation"])
    reviews = ratings.reviews_full(t["order_reviews"], t["orders"], ratings.order_category(categorised))
    full = s.save("ratings", {"reviews": reviews})["reviews"]
    trend = ratings.monthly_rating_trend(full)
    categories = ratings.category_ratings(full)
    return s.save(
        "ratings",
        {
            "trend": trend,
            "best_worst_month": ratings.best_worst_month(full),
            "categories": categories,
            "top_bottom": ratings.category_top_bottom(categories),
            "by_year": ratings.score_by_year_pivot(full),
            "by_month": ratings.score_by_month_pivot(full),
            "box_by_year": explore.score_box_by_year(full),
            "price_box_by_state": explore.price_box_by_state(t["orders"], t["customers"], t["order_items"]),
        },
    )


ANALYSES: list[Callable[[Stages, Frames], Frames]] = [
    insight_stage,
    explore_stage,
    segment_stage,
    forecast_stage,
    rating_stage,
]


def run_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Run every stage over the raw tables; returns rows and columns of each output."""
    stages = Stages(spark, folder)
    tables = clean_stage(stages, load_stage(stages, dict(raw)))
    for analysis in ANALYSES:
        analysis(stages, tables)
    return table_profile({f"{stage}/{name}": df for stage, name, df in stages.written})
