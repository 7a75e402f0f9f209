"""Shape of the physical plans, and results that must not depend on partitioning."""

import pytest

from tradewind.operators import answers, explore, forecast, insights, kpis, rfm
from tradewind.plans import registry
from tradewind import session
from tradewind.plans.registry import QUERIES, retail

# Only these run eager jobs (models, streams, written tables); the rest are plain plans.
EAGER = {"pipeline_report", "elbow", "live_kpis", "live_order_volume"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins_and_no_python_rows(spark, small, name):
    text = plan(registry.run(name, spark, small))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text, name


def test_rank_is_limited_before_the_single_task(spark, small):
    r = retail(spark, small)
    text = plan(insights.top_sellers_ranked(r["order_items"], r["sellers"]))
    assert text.count("WindowGroupLimit") == 2


def test_top_k_does_not_sort_everything(spark, small):
    r = retail(spark, small)
    for df in (
        insights.category_cancellation_raw(r["orders"], r["order_items"], r["products"]),
        kpis.revenue_by_state(r["order_items"], r["orders"], r["customers"]),
        kpis.explore_items(r["order_items"], r["orders"]),
        answers.top_seller(r["order_items"]),
    ):
        assert "TakeOrderedAndProject" in plan(df)


def test_scans_read_only_what_is_needed(spark, small):
    r = retail(spark, small)
    text = plan(answers.total_revenue(r["order_items"]))
    assert "ReadSchema: struct<l_extendedprice:double>" in text
    text = plan(kpis.explore_items(r["order_items"], r["orders"], price_lo=10.0, price_hi=20.0))
    assert "GreaterThanOrEqual(l_extendedprice,10.0)" in text and "LessThanOrEqual(l_extendedprice,20.0)" in text


def test_first_row_rules_merge_on_the_map_side(spark, small):
    r = retail(spark, small)
    text = plan(registry.QUERIES["dedup_by_key"](r))
    assert "Window" not in text and "partial_min" in text


def test_fan_out_sides_do_not_nest(spark, small):
    """Inner joins only, beside the per-order payments; each side is scanned for its rows and for its keys."""
    r = retail(spark, small)
    tables = {n: r[n] for n in ("orders", "order_items", "order_payments", "order_reviews")}
    text = plan(forecast.order_feature_rows(*tables.values()))
    whole = text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
    joins = [line for line in whole.splitlines() if "Join" in line]
    assert sum("LeftOuter" in line for line in joins) <= 2 and sum("LeftAnti" in line for line in joins) == 2
    assert whole.count("FileScan parquet") <= 12 and not any("FullOuter" in line for line in joins)


def test_fan_out_is_never_joined_for_correlations(spark, small):
    r = retail(spark, small)
    text = plan(explore.correlation_matrix(r["order_items"], r["order_payments"], r["order_reviews"]))
    assert "partial_sum" in text and "corr(" not in text


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_results_do_not_depend_on_partitioning(spark, small):
    r = retail(spark, small)

    def results(n):
        t = {k: df.repartition(n) for k, df in r.all().items()}
        base = rfm.rfm_base(t["orders"], t["customers"], t["order_payments"])
        return [
            rows(insights.top_sellers_ranked(t["order_items"], t["sellers"])),
            rows(insights.repeat_purchase_rate(t["orders"], t["customers"])),
            rows(insights.delivery_delay_by_state(t["orders"], t["customers"])),
            rows(
                insights.category_cancellation(
                    t["orders"], t["order_items"], t["products"], t["product_category_translation"]
                )
            ),
            rows(rfm.rfm_values(base).select(rfm.PERSON, "recency", "frequency")),
        ]

    assert results(1) == results(8)


def test_a_hot_key_gives_the_same_answer(spark):
    """A third of all lines belong to one order, one product and one seller."""
    lines = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 0, id) AS order_id", "IF(id % 3 = 0, 0, id % 50) AS product_id",
        "IF(id % 3 = 0, 0, id % 20) AS seller_id", "CAST(id % 7 AS DOUBLE) AS price", "0.5D AS freight_value",
        "CAST(id AS INT) AS order_item_id",
    )
    orders = spark.range(30_000).selectExpr(
        "id AS order_id", "id AS customer_id", "IF(id % 2 = 0, 'canceled', 'delivered') AS order_status"
    )
    products = spark.range(50).selectExpr("id AS product_id", "concat('c', id % 5) AS product_category_name")
    sellers = spark.range(20).selectExpr("id AS seller_id", "'x' AS seller_city", "'y' AS seller_state")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        top = insights.top_sellers_ranked(lines, sellers, top=1).first()
        rates = {r[0]: r for r in insights.category_cancellation_raw(orders, lines, products).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    local = lines.toPandas()
    hot = local[local.seller_id == 0]
    assert (top["seller_id"], top["total_orders"]) == (0, hot.order_id.nunique())
    assert top["total_revenue"] == pytest.approx((hot.price + hot.freight_value).sum())
    local["category"] = "c" + (local.product_id % 5).astype(str)
    for category, group in local.groupby("category"):
        assert rates[category]["total_orders"] == len(group)
        assert rates[category]["cancelled"] == (group.order_id % 2 == 0).sum()


def test_shuffles_widen_with_the_input_and_never_narrow(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert session.widen(spark, 1000).conf.get(key, None) is None
        session.widen(spark, 10 * 2**30)
        assert spark.conf.get(key) == "640"
        session.widen(spark, 2**30)
        assert spark.conf.get(key) == "640"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
