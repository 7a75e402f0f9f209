"""Every operator as a named query over one folder of star-schema tables.

A query takes a ``Retail`` and returns a lazy DataFrame.  Derived tables that several
queries read (person features, segments, weekly features, the trained forest) are
written once per session to the shared work folder, as the batch pipeline does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.functions.shaping import materialize
from tradewind.operators import answers, clean, explore, forecast, insights, kpis, ratings, rfm
from tradewind.plans.pipeline import run_pipeline
from tradewind.schemas import ORDER_DATES, PRODUCT_MEASURES
from tradewind.session import configure, input_files, widen, workspace
from tradewind.sources import tables
from tradewind.sources.star_views import StarRetail, over_star
from tradewind.streaming import live


class Retail(StarRetail):
    """Retail tables plus the derived tables that several queries share."""

    @cached_property
    def rfm(self) -> DataFrame:
        base = rfm.rfm_base(self["orders"], self["customers"], self["order_payments"])
        return materialize(rfm.rfm_values(base), "rfm")

    @cached_property
    def segments(self) -> DataFrame:
        return materialize(rfm.rfm_segments(self.rfm), "rfm-segments")

    @cached_property
    def graded(self) -> DataFrame:
        """Persons with clusters that SQL can name too, by spending score; what is told about clusters holds for any."""
        cluster = F.when(F.col("m_score") >= 5, 2).when(F.col("m_score") >= 3, 0).otherwise(1)
        return materialize(rfm.rfm_scores(self.rfm).withColumn("cluster", cluster), "graded")

    @cached_property
    def graded_segments(self) -> DataFrame:
        return materialize(rfm.label_segments(self.graded), "graded-segments")

    @cached_property
    def carried(self) -> DataFrame:
        """Test weeks with a prediction that SQL can name too: the revenue of the week before."""
        weekly = self.weekly_split  # one row per week
        before = F.lag(forecast.TARGET).over(Window.orderBy("week"))
        return weekly.withColumn("prediction", before).filter("is_test")

    def weekly(self, *group_cols: str) -> DataFrame:
        return forecast.weekly_features(
            self["orders"], self["order_items"], self["order_payments"], self["order_reviews"],
            self["customers"] if group_cols else None, group_cols,
        )

    @cached_property
    def weekly_split(self) -> DataFrame:
        return materialize(forecast.time_split(forecast.calendar_features(self.weekly())), "weekly")

    @cached_property
    def panel_split(self) -> DataFrame:
        panel = self.weekly("customer_state")
        return materialize(forecast.time_split(forecast.calendar_features(panel)), "weekly-by-state")

    @cached_property
    def forest(self):
        return forecast.train_forest(self.weekly_split.filter("NOT is_test"))

    @cached_property
    def predictions(self) -> DataFrame:
        return forecast.predict(self.forest, self.weekly_split.filter("is_test"))

    @cached_property
    def metrics(self) -> DataFrame:
        return materialize(answers.answer_metrics(self.all(), self.graded_segments), "answers")

    @cached_property
    def order_category(self) -> DataFrame:
        firsts = ratings.first_lines(self["order_items"])
        return ratings.order_category(ratings.item_category(firsts, self["products"], self["product_category_translation"]))

    @cached_property
    def reviews_full(self) -> DataFrame:
        return ratings.reviews_full(self["order_reviews"], self["orders"], self.order_category)

    def cleaned(self, name: str) -> DataFrame:
        return clean.CLEANERS[name](self[f"raw_{name}"])


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison: the order of additions is not fixed."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def settled(df: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded for comparison where exact ties are common.

    Averages and quantiles of cents often lie exactly between two rounded values, where
    the last bit decides.  A shift by a thousandth of the last digit decides instead.
    """
    shift = 10.0 ** -(digits + 3)
    return df.select(
        *[F.round(F.col(c) + shift, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, which every client prints alike."""
    return df.select(*[F.col(c).cast("string") if t in ("date", "timestamp_ntz", "timestamp") else F.col(c) for c, t in df.dtypes])


QUERIES: dict[str, Callable[[Retail], DataFrame]] = {}


def query(function: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks -----------------------------------------------------------


@query
def load_tables(r: Retail) -> DataFrame:
    """Write every table as CSV, load the files back, and profile what was loaded."""
    folder = workspace(r.spark, "csv")
    written = r.all()
    for name, df in written.items():
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    paths = {name: f"{folder}/{name}" for name in [*written, "not_delivered"]}
    loaded, missing = tables.load_tables(r.spark, paths, {n: df.schema for n, df in written.items()} | {"not_delivered": written["orders"].schema})
    return tables.table_profile(loaded).withColumn("missing_files", F.lit(len(missing)).cast("bigint"))


@query
def scan_table(r: Retail) -> DataFrame:
    return as_text(tables.scan_table(r.spark, r.path("orders")))


@query
def write_replace(r: Retail) -> DataFrame:
    path = workspace(r.spark, "items")
    tables.write_replace(r["sellers"], path)
    tables.write_replace(r["order_items"], path)
    return tables.scan_table(r.spark, path)


@query
def write_partitioned(r: Retail) -> DataFrame:
    path = workspace(r.spark, "orders-by-status")
    tables.write_replace(r["orders"].select("order_id", "customer_id", "order_status"), path, ["order_status"])
    return tables.scan_table(r.spark, path).select("order_id", "customer_id", "order_status")


@query
def table_profile(r: Retail) -> DataFrame:
    return tables.table_profile(r.all())


@query
def schema_info(r: Retail) -> DataFrame:
    return tables.schema_info(r.all())


# --- cleaning --------------------------------------------------------------------


@query
def null_summary(r: Retail) -> DataFrame:
    """Missing cells of the six tables before and after cleaning."""
    raw = {f"raw_{n}": r[f"raw_{n}"].drop("_row_order") for n in clean.CLEANERS}
    cleaned = {n: r.cleaned(n) for n in clean.CLEANERS}
    found = [clean.null_summary(df).withColumn("table_name", F.lit(n)) for n, df in (raw | cleaned).items()]
    return rounded(reduce(DataFrame.unionByName, found))


@query
def dedup_by_key(r: Retail) -> DataFrame:
    return clean.dedup_by_key(r["raw_orders"], ["order_id"]).drop("_row_order")


@query
def dedup_full_row(r: Retail) -> DataFrame:
    return clean.dedup_full_row(r["raw_order_items"])


@query
def fill_constant(r: Retail) -> DataFrame:
    filled = clean.fill_constant(r["raw_customers"], {"customer_city": "Unknown", "customer_state": "Unknown"})
    return filled.drop("_row_order")


@query
def fill_median(r: Retail) -> DataFrame:
    return rounded(clean.fill_median(r["raw_products"], PRODUCT_MEASURES).drop("_row_order"))


@query
def coerce_timestamp(r: Retail) -> DataFrame:
    return as_text(clean.coerce_timestamp(r["raw_orders"], ORDER_DATES).drop("_row_order"))


@query
def require_not_null(r: Retail) -> DataFrame:
    dated = clean.coerce_timestamp(r["raw_orders"], ORDER_DATES).drop("_row_order")
    return as_text(clean.require_not_null(dated, ["order_purchase_timestamp"]))


@query
def positive_only(r: Retail) -> DataFrame:
    return clean.positive_only(r["raw_order_payments"], "payment_value")


@query
def iqr_fences(r: Retail) -> DataFrame:
    return settled(clean.iqr_fence_table(r["order_items"], ["price", "freight_value"]), 6)


@query
def iqr_filter(r: Retail) -> DataFrame:
    return clean.iqr_filter(r.base("events").select("event_id", "user_id", "event_type", "value"), "value")


@query
def iqr_filter_chain(r: Retail) -> DataFrame:
    return clean.iqr_filter_chain(r["order_items"], ["price", "freight_value"])


@query
def clean_report(r: Retail) -> DataFrame:
    return clean.clean_report(r.all("raw_"))


@query
def clean_summary(r: Retail) -> DataFrame:
    return clean.clean_summary({name: r.cleaned(name) for name in clean.CLEANERS})


@query
def clean_customers(r: Retail) -> DataFrame:
    return r.cleaned("customers")


@query
def clean_orders(r: Retail) -> DataFrame:
    return as_text(r.cleaned("orders"))


@query
def clean_order_items(r: Retail) -> DataFrame:
    return r.cleaned("order_items")


@query
def clean_reviews(r: Retail) -> DataFrame:
    return as_text(r.cleaned("order_reviews"))


@query
def clean_products(r: Retail) -> DataFrame:
    return rounded(r.cleaned("products"))


@query
def clean_payments(r: Retail) -> DataFrame:
    return r.cleaned("order_payments")


# --- business reports ------------------------------------------------------------


@query
def top_sellers_ranked(r: Retail) -> DataFrame:
    return insights.top_sellers_ranked(r["order_items"], r["sellers"])


@query
def top_sellers_limit(r: Retail) -> DataFrame:
    return insights.top_sellers_limit(r["order_items"])


@query
def monthly_growth(r: Retail) -> DataFrame:
    return insights.monthly_growth(r["orders"])


@query
def monthly_orders_lag(r: Retail) -> DataFrame:
    return insights.monthly_orders_lag(clean.coerce_timestamp(r["raw_orders"], ORDER_DATES))


@query
def delivery_delay_by_state(r: Retail) -> DataFrame:
    return insights.delivery_delay_by_state(r["orders"], r["customers"])


@query
def delivery_delay_top10(r: Retail) -> DataFrame:
    return insights.delivery_delay_top10(r["orders"], r["customers"])


@query
def repeat_purchase_rate(r: Retail) -> DataFrame:
    return insights.repeat_purchase_rate(r["orders"], r["customers"])


@query
def repeat_purchase_counts(r: Retail) -> DataFrame:
    return insights.repeat_purchase_counts(r["orders"], r["customers"])


@query
def category_cancellation(r: Retail) -> DataFrame:
    return insights.category_cancellation(
        r["orders"], r["order_items"], r["products"], r["product_category_translation"]
    )


@query
def category_cancellation_raw(r: Retail) -> DataFrame:
    return insights.category_cancellation_raw(r["orders"], r["order_items"], r["products"])


# --- headline numbers ------------------------------------------------------------


@query
def kpi_summary(r: Retail) -> DataFrame:
    return kpis.kpi_summary(r["orders"], r["order_items"], r["order_reviews"], r["customers"])


@query
def kpi_dashboard(r: Retail) -> DataFrame:
    return kpis.kpi_dashboard(r["orders"], r["order_items"], r["order_reviews"])


@query
def avg_delivery_days(r: Retail) -> DataFrame:
    return kpis.avg_delivery_days(r["orders"])


@query
def revenue_by_state(r: Retail) -> DataFrame:
    return kpis.revenue_by_state(r["order_items"], r["orders"], r["customers"])


@query
def revenue_by_state_all(r: Retail) -> DataFrame:
    return kpis.revenue_by_state_all(r["orders"], r["customers"], r["order_items"])


@query
def segment_counts(r: Retail) -> DataFrame:
    return kpis.segment_counts(r.graded_segments)


@query
def segment_summary(r: Retail) -> DataFrame:
    return kpis.segment_summary(r.graded_segments)


@query
def payment_type_counts(r: Retail) -> DataFrame:
    return kpis.payment_type_counts(r["order_payments"])


@query
def monthly_order_counts(r: Retail) -> DataFrame:
    return kpis.monthly_order_counts(r["orders"])


@query
def monthly_avg_rating(r: Retail) -> DataFrame:
    return kpis.monthly_avg_rating(r["orders"], r["order_reviews"])


@query
def explore_items(r: Retail) -> DataFrame:
    return kpis.explore_items(r["order_items"], r["orders"], status="shipped", price_lo=20000.0, price_hi=60000.0)


@query
def explore_all_items(r: Retail) -> DataFrame:
    return kpis.explore_items(r["order_items"], r["orders"])


@query
def explore_count(r: Retail) -> DataFrame:
    return kpis.explore_count(r["order_items"], r["orders"], status="shipped", price_lo=20000.0, price_hi=60000.0)


@query
def explore_statuses(r: Retail) -> DataFrame:
    return kpis.explore_statuses(r["orders"])


@query
def explore_bounds(r: Retail) -> DataFrame:
    return kpis.explore_bounds(r["order_items"])


# --- exploration -----------------------------------------------------------------


@query
def describe_orders(r: Retail) -> DataFrame:
    return settled(explore.describe_numeric(r["orders"], ORDER_DATES), 4)


@query
def describe_items(r: Retail) -> DataFrame:
    return settled(explore.describe_numeric(r["order_items"], ["price", "freight_value"]), 4)


@query
def describe_payments(r: Retail) -> DataFrame:
    return settled(explore.describe_numeric(r["order_payments"], ["payment_value", "payment_installments"]), 4)


@query
def describe_rfm(r: Retail) -> DataFrame:
    return settled(explore.describe_numeric(r.rfm, rfm.FEATURES), 2)


@query
def orders_customers(r: Retail) -> DataFrame:
    return as_text(explore.orders_customers(r["orders"], r["customers"]))


@query
def items_payments(r: Retail) -> DataFrame:
    return explore.items_payments(r["order_items"], r["order_payments"])


@query
def state_revenue_stats(r: Retail) -> DataFrame:
    return settled(explore.state_revenue_stats(r["orders"], r["customers"], r["order_items"]), 4)


@query
def payment_type_stats(r: Retail) -> DataFrame:
    return settled(explore.payment_type_stats(r["order_payments"]), 4)


@query
def status_by_year_pivot(r: Retail) -> DataFrame:
    return explore.status_by_year_pivot(r["orders"], r["order_items"])


@query
def correlation_matrix(r: Retail) -> DataFrame:
    return rounded(explore.correlation_matrix(r["order_items"], r["order_payments"], r["order_reviews"]))


@query
def status_value_counts(r: Retail) -> DataFrame:
    return explore.value_counts(r["orders"], "order_status")


@query
def category_value_counts(r: Retail) -> DataFrame:
    return explore.value_counts(r["products"], "product_category_name", top=10)


@query
def score_value_counts(r: Retail) -> DataFrame:
    return explore.value_counts(r["order_reviews"], "review_score", by_value=True)


@query
def box_stats(r: Retail) -> DataFrame:
    return settled(explore.box_stats(r["order_items"], "freight_value"), 6)


@query
def price_box_stats(r: Retail) -> DataFrame:
    return settled(explore.box_stats(r["order_items"], "price"), 6)


@query
def price_box_by_state(r: Retail) -> DataFrame:
    return settled(explore.price_box_by_state(r["orders"], r["customers"], r["order_items"]), 6)


@query
def score_box_by_year(r: Retail) -> DataFrame:
    return rounded(explore.score_box_by_year(r.reviews_full))


@query
def lag_pairs(r: Retail) -> DataFrame:
    return explore.lag_pairs(kpis.monthly_order_counts(r["orders"]))


@query
def lag_autocorrelation(r: Retail) -> DataFrame:
    return rounded(explore.lag_autocorrelation(kpis.monthly_order_counts(r["orders"])))


# --- persons ---------------------------------------------------------------------


@query
def order_value(r: Retail) -> DataFrame:
    return rounded(rfm.order_value(r["order_payments"]), 4)


@query
def rfm_base(r: Retail) -> DataFrame:
    return as_text(rounded(rfm.rfm_base(r["orders"], r["customers"], r["order_payments"]), 4))


@query
def rfm_values(r: Retail) -> DataFrame:
    return rounded(rfm.rfm_values(rfm.rfm_base(r["orders"], r["customers"], r["order_payments"])), 4)


@query
def quantile_bucket(r: Retail) -> DataFrame:
    bucketed = rfm.quantile_bucket(r.rfm, "monetary", "monetary_bucket")
    return rounded(rfm.quantile_bucket(bucketed, "recency", "recency_bucket"), 4)


@query
def fixed_bucket(r: Retail) -> DataFrame:
    return r.rfm.select(rfm.PERSON, "frequency", rfm.fixed_bucket(F.col("frequency")).alias("f_score"))


@query
def rfm_scores(r: Retail) -> DataFrame:
    return rfm.rfm_scores(r.rfm).select(rfm.PERSON, "r_score", "f_score", "m_score", "rfm_score")


@query
def rfm_score_distribution(r: Retail) -> DataFrame:
    return rfm.rfm_score_distribution(rfm.rfm_scores(r.rfm))


@query
def standardize(r: Retail) -> DataFrame:
    return rounded(rfm.standardize(r.rfm).select(rfm.PERSON, *rfm.SCALED))


@query
def elbow(r: Retail) -> DataFrame:
    """The cost of one cluster, and whether each further cluster lowers the cost."""
    costs = rfm.elbow(r.rfm)  # one row per k
    before = F.lag("inertia").over(Window.orderBy("k"))
    falls = F.coalesce(F.col("inertia") <= before * 1.001, F.lit(True))
    return rounded(costs.select("k", F.when(F.col("k") == 1, F.col("inertia")).alias("inertia_of_one"), falls.alias("falls")), 4)


@query
def kmeans_segments(r: Retail) -> DataFrame:
    """Persons with their scores, and whether no other cluster's mean is nearer than that of their own."""
    clustered = materialize(rfm.kmeans_segments(rfm.rfm_scores(r.rfm)), "clustered")
    scaled = rfm.standardize(clustered)
    means = scaled.groupBy("cluster").agg(*[F.avg(z).alias(f"m_{z}") for z in rfm.SCALED]).orderBy("cluster").collect()
    gaps = [sum((F.col(z) - m[f"m_{z}"]) * (F.col(z) - m[f"m_{z}"]) for z in rfm.SCALED) for m in means]
    own = reduce(lambda rest, n: F.when(F.col("cluster") == means[n]["cluster"], gaps[n]).otherwise(rest), range(len(means)), F.lit(None))
    # the fit may stop when its centers move by a ten-thousandth
    nearest = F.sqrt(own) <= F.sqrt(F.least(*gaps)) + 1e-3
    kept = scaled.select(*clustered.columns, nearest.alias("nearest"), F.lit(len(means)).alias("clusters"))
    return rounded(kept.drop("cluster"), 4)


@query
def cluster_summary(r: Retail) -> DataFrame:
    return rfm.cluster_summary(r.graded)


@query
def label_segments(r: Retail) -> DataFrame:
    return rounded(rfm.label_segments(r.graded), 4)


@query
def segment_profile(r: Retail) -> DataFrame:
    return rounded(rfm.segment_profile(r.graded_segments))


@query
def segment_points(r: Retail) -> DataFrame:
    return rounded(rfm.segment_points(r.graded_segments), 4)


# --- forecasting -----------------------------------------------------------------


@query
def order_delivery_features(r: Retail) -> DataFrame:
    return forecast.order_delivery_features(r["orders"]).select("order_id", "delivery_days", "delivery_delay")


@query
def payment_per_order(r: Retail) -> DataFrame:
    return rounded(forecast.payment_per_order(r["order_payments"]), 4)


@query
def order_feature_rows(r: Retail) -> DataFrame:
    rows = forecast.order_feature_rows(r["orders"], r["order_items"], r["order_payments"], r["order_reviews"])
    return as_text(rounded(rows, 4))


@query
def weekly_features(r: Retail) -> DataFrame:
    return as_text(settled(r.weekly(), 4))


@query
def weekly_features_by_state(r: Retail) -> DataFrame:
    return as_text(settled(r.weekly("customer_state"), 4))


@query
def calendar_features(r: Retail) -> DataFrame:
    weekly = forecast.calendar_features(r.weekly())
    return as_text(weekly.select("week", "month_num", "year_num", "week_num"))


@query
def time_split(r: Retail) -> DataFrame:
    return as_text(forecast.time_split(r.weekly()).select("week", "order_count", F.col("is_test").cast("int")))


@query
def train_forest(r: Retail) -> DataFrame:
    """Every week, and whether the forest's prediction lies within what it has seen, as an average of seen values must."""
    seen = r.weekly_split.filter("NOT is_test").agg(F.min(forecast.TARGET), F.max(forecast.TARGET)).first()
    within = F.col("prediction").between(seen[0] * (1 - 1e-9), seen[1] * (1 + 1e-9))
    return as_text(rounded(forecast.predict(r.forest, r.weekly_split).select("week", forecast.TARGET, within.alias("within")), 4))


@query
def train_forest_by_state(r: Retail) -> DataFrame:
    """The same forest over one weekly series per state, scored on the last weeks: its errors fit together."""
    model = forecast.train_forest(r.panel_split.filter("NOT is_test"), group_cols=["customer_state"])
    predictions = forecast.predict(model, r.panel_split.filter("is_test"))
    fits = (F.col("mae") > 0) & (F.col("rmse") >= F.col("mae")) & (F.col("r2") < 1)
    return forecast.evaluate(predictions).select(F.lit(predictions.count()).alias("test_rows"), fits.alias("errors_fit"))


@query
def evaluate(r: Retail) -> DataFrame:
    return rounded(forecast.evaluate(r.carried), 4)


@query
def feature_importance(r: Retail) -> DataFrame:
    """All features, their weights adding up to one, none below zero."""
    weights = forecast.feature_importance(r.forest)
    return weights.agg(
        F.sort_array(F.collect_list("feature")).cast("string").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"), (F.min("importance") >= 0).alias("none_below_zero"),
    )


@query
def residuals(r: Retail) -> DataFrame:
    return as_text(rounded(forecast.residuals(r.carried), 4))


@query
def score_batch(r: Retail) -> DataFrame:
    """Train the service model, save it, and score every weekly row of every state: the saved model predicts as the one in memory."""
    train, test = r.weekly_split.filter("NOT is_test"), r.weekly_split.filter("is_test")
    model = forecast.train_forest(train, forecast.SERVICE_FEATURES)
    path = workspace(r.spark, "model")
    model.write().overwrite().save(path)
    metrics = forecast.evaluate(forecast.predict(model, test))
    scored = forecast.score_batch(path, r.panel_split, metrics)
    kept = metrics.first()
    expected = forecast.predict(model, r.panel_split).select("week", "customer_state", F.round("prediction", 2).alias("kept"))
    same = (F.col("prediction") == F.col("kept")) & (F.col("mae") == F.round(F.lit(kept["mae"]), 2)) & (F.col("r2") == F.round(F.lit(kept["r2"]), 4))
    both = scored.join(expected, ["week", "customer_state"])
    return as_text(both.select("week", "customer_state", same.alias("as_in_memory")))


# --- ratings ---------------------------------------------------------------------


@query
def item_category(r: Retail) -> DataFrame:
    return ratings.item_category(r["order_items"], r["products"], r["product_category_translation"])


@query
def order_category(r: Retail) -> DataFrame:
    return r.order_category


@query
def reviews_full(r: Retail) -> DataFrame:
    return as_text(r.reviews_full)


@query
def monthly_rating_trend(r: Retail) -> DataFrame:
    return rounded(ratings.monthly_rating_trend(r.reviews_full))


@query
def best_worst_month(r: Retail) -> DataFrame:
    return rounded(ratings.best_worst_month(r.reviews_full))


@query
def category_ratings(r: Retail) -> DataFrame:
    return rounded(ratings.category_ratings(r.reviews_full))


@query
def category_top_bottom(r: Retail) -> DataFrame:
    return rounded(ratings.category_top_bottom(ratings.category_ratings(r.reviews_full)))


@query
def score_by_year_pivot(r: Retail) -> DataFrame:
    return ratings.score_by_year_pivot(r.reviews_full)


@query
def score_by_month_pivot(r: Retail) -> DataFrame:
    return ratings.score_by_month_pivot(r.reviews_full)


@query
def star_share_trend(r: Retail) -> DataFrame:
    return ratings.star_share_trend(ratings.monthly_rating_trend(r.reviews_full))


# --- questions and answers -------------------------------------------------------


@query
def state_orders_revenue(r: Retail) -> DataFrame:
    return answers.state_orders_revenue(r["orders"], r["customers"], r["order_items"])


@query
def orders_revenue_of_state(r: Retail) -> DataFrame:
    return answers.orders_revenue_of_state(r["orders"], r["customers"], r["order_items"], "NATION_7")


@query
def top_seller(r: Retail) -> DataFrame:
    return answers.top_seller(r["order_items"])


@query
def seller_count(r: Retail) -> DataFrame:
    return answers.seller_count(r["sellers"])


@query
def top_state(r: Retail) -> DataFrame:
    return answers.top_state(r["orders"], r["customers"])


@query
def total_revenue(r: Retail) -> DataFrame:
    return answers.total_revenue(r["order_items"])


@query
def avg_item_value(r: Retail) -> DataFrame:
    return answers.avg_item_value(r["order_items"])


@query
def rating_overview(r: Retail) -> DataFrame:
    return answers.rating_overview(r["order_reviews"])


@query
def order_count(r: Retail) -> DataFrame:
    return answers.order_count(r["orders"])


@query
def repeat_customer_share(r: Retail) -> DataFrame:
    return answers.repeat_customer_share(r["orders"], r["customers"])


@query
def customer_count(r: Retail) -> DataFrame:
    return answers.customer_count(r["customers"])


@query
def cancellation_share(r: Retail) -> DataFrame:
    return answers.cancellation_share(r["orders"])


@query
def top_payment_type(r: Retail) -> DataFrame:
    return answers.top_payment_type(r["order_payments"])


@query
def best_category(r: Retail) -> DataFrame:
    return answers.best_category(r["order_reviews"], r["order_items"], r["products"])


@query
def worst_category(r: Retail) -> DataFrame:
    return answers.worst_category(r["order_reviews"], r["order_items"], r["products"])


@query
def category_count(r: Retail) -> DataFrame:
    return answers.category_count(r["products"])


@query
def product_count(r: Retail) -> DataFrame:
    return answers.product_count(r["products"])


@query
def answer_metrics(r: Retail) -> DataFrame:
    return rounded(answers.answer_metrics(r.all(), r.graded_segments), 4)


@query
def tag_questions(r: Retail) -> DataFrame:
    asked = r.base("conversations").filter(F.col("role") == "user")
    return answers.question_counts(answers.tag_questions(asked))


@query
def answer_questions(r: Retail) -> DataFrame:
    asked = r.base("conversations").filter(F.col("role") == "user")
    tagged = answers.tag_questions(asked).select("conv_id", "turn", "intent", "state")
    return rounded(answers.answer_questions(tagged, r.metrics), 4)


# --- streams and the whole pipeline ----------------------------------------------


def _stream(r: Retail, name: str) -> DataFrame:
    # as a pattern, which may name one file as well as a folder of files
    path = r.path(name)
    return live.read_arriving(r.spark, f"{path[:-1]}[{path[-1]}]", r.base(name).schema)


@query
def live_kpis(r: Retail) -> DataFrame:
    orders = _stream(r, "orders")
    feed = live.kpi_feed(
        over_star(r.spark, "orders", orders=orders),
        over_star(r.spark, "order_items", lineitem=_stream(r, "lineitem")),
        over_star(r.spark, "order_reviews", orders=orders),
    )
    folder = workspace(r.spark, "live-kpis")
    live.keep_snapshot(live.live_kpis(feed), f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    return rounded(live.snapshot(r.spark, f"{folder}/state"), 4)


@query
def live_order_volume(r: Retail) -> DataFrame:
    """Every order arrives twice; the repeated delivery must not count, and rows behind the watermark must."""
    orders = over_star(r.spark, "orders", orders=_stream(r, "orders"))
    folder = workspace(r.spark, "live-volume")
    live.keep_order_volume(orders.union(orders), f"{folder}/volume", f"{folder}/checkpoint").awaitTermination()
    live.merge_late_orders(r.spark, f"{folder}/volume")
    return as_text(live.order_volume(r.spark, f"{folder}/volume"))


@query
def pipeline_report(r: Retail) -> DataFrame:
    raw = {**r.all(), **r.all("raw_")}
    return run_pipeline(r.spark, raw, workspace(r.spark, "pipeline"))


_RETAILS: dict[str, tuple[tuple, Retail]] = {}


def retail(spark: SparkSession, folder: str) -> Retail:
    """The retail tables of a folder; derived tables live as long as the session and the files they come from."""
    files = input_files(spark, folder)
    known = spark.sparkContext.applicationId, tuple(files)
    if folder not in _RETAILS or _RETAILS[folder][0] != known:
        widen(configure(spark), sum(size for _, size, _ in files))
        _RETAILS[folder] = known, Retail(spark, folder)
    return _RETAILS[folder][1]


def forget() -> None:
    """Drop what earlier queries have derived, so that the next one builds its own."""
    _RETAILS.clear()


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """One registered query over a folder of star-schema tables."""
    return QUERIES[name](retail(spark, folder))
