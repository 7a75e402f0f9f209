"""Operators on small hand-made frames with literal expected rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions.days import floor_days, trunc_days, week_start
from tradewind.functions.rounding import percent, ratio
from tradewind.functions.shaping import keep_first, left_join_fanout
from tradewind.operators import clean, explore, forecast, insights, kpis, ratings, rfm


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(text):
    return datetime.fromisoformat(text)


def test_days_cut_and_floor(spark):
    frame = spark.createDataFrame(
        [
            (day("2020-01-03 12:00:00"), day("2020-01-02 00:00:00")),
            (day("2020-01-02 00:00:00"), day("2020-01-03 12:00:00")),
            (day("2020-01-02 00:00:00"), day("2020-01-02 00:00:00")),
            (None, day("2020-01-02 00:00:00")),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    a, b = F.col("a"), F.col("b")
    assert [tuple(r) for r in frame.select(trunc_days(a, b), floor_days(a, b)).collect()] == [
        (1, 1),
        (-1, -2),
        (0, 0),
        (None, None),
    ]


def test_ratio_rounds_half_away_from_zero(spark):
    frame = spark.createDataFrame([(107, 4000), (-1, 8), (1, 8), (1, 0), (2, 3)], "n bigint, d bigint")
    values = [r[0] for r in frame.select(ratio(F.col("n") * 100, F.col("d"))).collect()]
    assert values == [2.68, -12.5, 12.5, None, 66.67]
    assert [r[0] for r in frame.select(percent(F.col("n"), F.col("d"), 0)).collect()] == [3.0, -13.0, 13.0, None, 67.0]


def test_keep_first_follows_order_and_treats_null_keys_as_equal(spark):
    frame = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), (None, 5, "x"), (None, 4, "w"), ("b", 1, None)],
        "key string, seq int, payload string",
    )
    expected = sorted([("a", 1, "early"), (None, 4, "w"), ("b", 1, None)], key=repr)
    assert rows(keep_first(frame, ["key"], ["seq"])) == expected
    assert rows(keep_first(frame.repartition(3), ["key"], ["seq"])) == expected
    assert rows(keep_first(frame.select("key"), ["key"])) == sorted([("a",), (None,), ("b",)], key=repr)


def test_keep_first_uses_the_file_order(spark):
    frame = spark.createDataFrame([("a", "z", 0), ("a", "b", 1)], "key string, payload string, _row_order int")
    assert rows(keep_first(frame, ["key"]).select("key", "payload")) == [("a", "z")]


def test_left_join_fanout_keeps_lonely_rows(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, l string")
    right = spark.createDataFrame([(1, 10.0), (1, 11.0), (None, 12.0)], "k int, r double")
    assert rows(left_join_fanout(left, left, "k", right)) == rows(left.join(right, "k", "left"))


def test_null_summary_and_fills(spark):
    frame = spark.createDataFrame([("a", None), (None, 1.0), (None, 3.0), (None, 8.0)], "s string, v double")
    assert rows(clean.null_summary(frame)) == [("s", 3, 75.0), ("v", 1, 25.0)]
    assert rows(clean.null_summary(frame.limit(0))) == []
    assert rows(clean.fill_median(frame, ["v"]).select("v")) == [(1.0,), (3.0,), (3.0,), (8.0,)]
    assert rows(clean.fill_median(frame.filter("v IS NULL"), ["v"]).select("v")) == [(None,)]


def test_coerce_timestamp_never_fails(spark):
    frame = spark.createDataFrame([("2017-01-31 10:00:00",), ("not a date",), (None,), ("",)], "t string")
    found = [r[0] for r in clean.coerce_timestamp(frame, ["t"]).collect()]
    assert found == [day("2017-01-31 10:00:00"), None, None, None]


@pytest.mark.parametrize(
    "values, kept",
    [
        ([5.0, 5.0, 5.0, 5.0], [5.0, 5.0, 5.0, 5.0]),
        ([1.0, 2.0, 3.0, 4.0, 1000.0], [1.0, 2.0, 3.0, 4.0]),
        ([1.0, 2.0, 3.0, 4.0, 7.0, None], [1.0, 2.0, 3.0, 4.0, 7.0]),  # 7 = 4 + 1.5 * 2 lies on the fence
        ([42.0], [42.0]),
        ([None, None], []),
    ],
)
def test_iqr_filter(spark, values, kept):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in rows(clean.iqr_filter(frame, "v"))] == kept


def test_iqr_chain_fences_the_survivors(spark):
    cells = [(n, n) for n in range(1, 8)] + [(8, 14), (1000, 14), (1000, 14)]
    frame = spark.createDataFrame([(float(p), float(f)) for p, f in cells], "price double, freight double")
    assert clean.iqr_filter(frame, "freight").count() == 10
    chained = clean.iqr_filter_chain(frame, ["price", "freight"])
    assert rows(chained.select("freight")) == [(float(n),) for n in range(1, 8)]


def test_products_use_the_median_before_duplicates_go(spark):
    frame = spark.createDataFrame(
        [(1, None, 10.0), (1, None, 10.0), (2, "toys", 40.0), (3, "toys", None)],
        "product_id int, product_category_name string, product_weight_g double",
    )
    assert rows(clean.clean_products(frame)) == [(1, "unknown", 10.0), (2, "toys", 40.0), (3, "toys", 10.0)]


def test_cleaners_are_idempotent(spark, small):
    from tradewind.plans.registry import retail

    r = retail(spark, small)
    for name in ("customers", "orders", "order_reviews", "products", "order_payments"):
        once = r.cleaned(name)
        assert rows(clean.CLEANERS[name](once)) == rows(once)


def test_rank_keeps_ties_at_the_cut(spark):
    items = spark.createDataFrame(
        [(i, f"s{i:02}", float(100 - min(i, 10)), 0.0) for i in range(1, 13)],
        "order_id int, seller_id string, price double, freight_value double",
    )
    sellers = spark.createDataFrame(
        [(f"s{i:02}", "city", "ST") for i in range(1, 13)], "seller_id string, seller_city string, seller_state string"
    )
    ranked = insights.top_sellers_ranked(items, sellers).collect()
    assert len(ranked) == 12 and [r["revenue_rank"] for r in ranked[-3:]] == [10, 10, 10]
    assert len(insights.top_sellers_limit(items).collect()) == 10


def test_repeated_seller_rows_repeat_revenue(spark):
    items = spark.createDataFrame(
        [(1, "a", 10.0, 1.0)], "order_id int, seller_id string, price double, freight_value double"
    )
    sellers = spark.createDataFrame([("a", "c", "S")] * 2, "seller_id string, seller_city string, seller_state string")
    assert rows(insights.top_sellers_ranked(items, sellers)) == [(1, "a", "c", "S", 22.0, 1)]


def test_growth_compares_with_the_previous_present_month(spark):
    stamps = ["2017-01-05", "2017-01-06", "2017-03-01", "2017-03-02", "2017-03-03", None]
    orders = spark.createDataFrame(
        [(i, None if s is None else day(s)) for i, s in enumerate(stamps)],
        "order_id int, order_purchase_timestamp timestamp_ntz",
    )
    assert [tuple(r) for r in insights.monthly_growth(orders).collect()] == [
        ("2017-01", 2, None, None),
        ("2017-03", 3, 2, 50.0),
    ]
    assert [tuple(r) for r in insights.monthly_orders_lag(orders).collect()][-1] == (None, 1, 3)


def test_repeat_classes_of_a_single_class(spark):
    orders = spark.createDataFrame([(1, 1), (2, 2)], "order_id int, customer_id int")
    customers = spark.createDataFrame([(1, "p"), (2, "q")], "customer_id int, customer_unique_id string")
    assert rows(insights.repeat_purchase_rate(orders, customers)) == [("One-Time Buyer", 2, 100.0)]
    assert rows(insights.repeat_purchase_rate(orders.limit(0), customers)) == []


def test_cancellation_next_rate_reaches_past_the_cut(spark):
    lines, statuses = [], []
    for c in range(4):
        for i in range(50):
            order = c * 50 + i
            lines.append((order, c))
            statuses.append((order, "canceled" if i < c else "delivered"))
    orders = spark.createDataFrame(statuses, "order_id int, order_status string")
    items = spark.createDataFrame(lines, "order_id int, product_id int")
    products = spark.createDataFrame([(c, f"c{c}") for c in range(4)], "product_id int, product_category_name string")
    words = spark.createDataFrame(
        [("c3", "three")], "product_category_name string, product_category_name_english string"
    )
    found = insights.category_cancellation(orders, items, products, words, top=2).collect()
    assert [tuple(r) for r in found] == [("three", 50, 3, 6.0, 4.0), ("c2", 50, 2, 4.0, 2.0)]


def test_correlation_equals_the_joined_rows(spark, small):
    from tradewind.plans.registry import retail

    r = retail(spark, small)
    # some cells missing on one side only, and more than one review per order
    items = r["order_items"].withColumn("freight_value", F.expr("CASE WHEN price > 90000 THEN NULL ELSE freight_value END"))
    payments, reviews = r["order_payments"], r["order_reviews"].union(r["order_reviews"])
    joined = (
        items.select("order_id", "price", "freight_value")
        .join(payments.select("order_id", "payment_value", "payment_installments"), "order_id")
        .join(reviews.select("order_id", "review_score"), "order_id", "left")
    )
    found = explore.correlation_matrix(items, payments, reviews).collect()
    assert len(found) == 10
    for row in found:
        both = joined.dropna(subset=[row["column_a"], row["column_b"]])
        assert row["correlation"] == pytest.approx(both.stat.corr(row["column_a"], row["column_b"]), abs=1e-9)


def test_correlation_of_a_constant_is_null(spark):
    items = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.0)], "order_id int, price double, freight_value double")
    payments = spark.createDataFrame(
        [(1, 1.0, 1), (2, 3.0, 2)], "order_id int, payment_value double, payment_installments int"
    )
    reviews = spark.createDataFrame([(1, 5)], "order_id int, review_score int")
    found = {(r[0], r[1]): r[2] for r in explore.correlation_matrix(items, payments, reviews).collect()}
    assert found[("price", "freight_value")] is None
    assert found[("freight_value", "payment_value")] == pytest.approx(1.0)
    assert found[("freight_value", "review_score")] is None


def test_pivot_fills_missing_and_drops_unknown_years(spark):
    orders = spark.createDataFrame(
        [(1, "shipped", day("2017-01-01")), (2, "delivered", day("2018-01-01")), (3, "shipped", None)],
        "order_id int, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(1, 1.0, 0.0), (1, 2.0, 0.0)], "order_id int, price double, freight_value double"
    )
    pivot = explore.status_by_year_pivot(orders, items, ["delivered", "shipped"])
    assert [tuple(r) for r in pivot.collect()] == [(2017, 0, 2), (2018, 1, 0)]
    found = explore.status_by_year_pivot(orders, items)  # columns from the data
    assert found.columns == ["order_year", "delivered", "shipped"] and found.collect() == pivot.collect()
    with pytest.raises(Exception, match="unknown order status: delivered"):
        explore.status_by_year_pivot(orders, items, ["shipped"]).collect()


def test_score_pivot_keeps_unusual_scores(spark):
    full = spark.createDataFrame(
        [(1, 7, day("2017-01-01")), (2, 1, day("2017-02-01"))], "order_id int, review_score int, order_purchase_timestamp timestamp_ntz"
    )
    pivot = ratings.score_by_year_pivot(full)
    assert pivot.columns == ["year", "Score_1", "Score_7"] and [tuple(r) for r in pivot.collect()] == [(2017, 1, 1)]


def test_median_of_integers_may_be_a_half(spark):
    frame = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert sorted(r["v"] for r in clean.fill_median(frame, ["v"]).collect()) == [1.0, 1.5, 2.0]


def test_box_stats(spark):
    frame = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "v double")
    assert rows(explore.box_stats(frame, "v")) == [(2.25, 3.5, 4.75, 1.0, 5.0, 1)]
    assert rows(explore.box_stats(frame.limit(0), "v")) == [(None, None, None, None, None, 0)]


def test_buckets(spark):
    frame = spark.range(1, 12).select("id", F.col("id").cast("double").alias("v"))
    binned = [r[0] for r in rfm.quantile_bucket(frame, "v", "b").orderBy("id").select("b").collect()]
    assert binned == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    ties = spark.createDataFrame([(1.0,)] * 8 + [(2.0,), (3.0,)], "v double")
    assert {r["b"] for r in rfm.quantile_bucket(ties, "v", "b").filter("v = 1").collect()} == {1}
    fixed = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 4, 5, 6, None)], "f int")
    assert [r[0] for r in fixed.select(rfm.fixed_bucket(F.col("f"))).collect()] == [None, 1, 2, 3, 4, 4, 5, None]


def test_standardize_constant_column(spark):
    frame = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert rows(rfm.standardize(frame, ["a", "b"]).select("z_a", "z_b")) == [(-1.0, 0.0), (1.0, 0.0)]


def test_labels_follow_average_spend(spark):
    clustered = spark.createDataFrame(
        [("a", 1, 1, 10.0, 3, 0), ("b", 1, 1, 500.0, 3, 1), ("c", 1, 1, 90.0, 3, 2)],
        "customer_unique_id string, recency int, frequency int, monetary double, rfm_score int, cluster int",
    )
    named = {r["customer_unique_id"]: r["segment"] for r in rfm.label_segments(clustered).collect()}
    assert named == {"a": "Low Value", "b": "High Value", "c": "Medium Value"}


def test_segment_profile_of_equal_segments(spark):
    segments = spark.createDataFrame(
        [("x", 1, 1, 1.0), ("y", 1, 2, 3.0)], "segment string, recency int, frequency int, monetary double"
    )
    first, second = rfm.segment_profile(segments).collect()
    assert first["recency_scaled"] is None and (first["monetary_scaled"], second["monetary_scaled"]) == (0.0, 1.0)


def test_week_features_belong_to_sunday(spark):
    frame = spark.createDataFrame(
        [(day(d),) for d in ("2017-01-31", "2016-12-27", "2018-12-31")], "t timestamp_ntz"
    )
    calendar = forecast.calendar_features(frame.select(week_start(F.col("t")).alias("week")))
    assert [tuple(r) for r in calendar.select("week", "month_num", "year_num", "week_num").collect()] == [
        (date(2017, 1, 30), 2, 2017, 5),
        (date(2016, 12, 26), 1, 2017, 52),
        (date(2018, 12, 31), 1, 2019, 1),
    ]


def test_weekly_features_equal_averages_over_feature_rows(spark, small):
    from tradewind.plans.registry import retail

    r = retail(spark, small)
    tables = r["orders"], r["order_items"], r["order_payments"], r["order_reviews"].union(r["order_reviews"])
    expected = (
        forecast.order_feature_rows(*tables)
        .groupBy("week")
        .agg(F.sum("price"), F.avg("price"), F.avg("payment_value"), F.avg("review_score"), F.avg("delivery_delay"))
        .dropna()
        .orderBy("week")
        .collect()
    )
    names = ["week", "total_revenue", "avg_price", "avg_payment_value", "avg_review_score", "avg_delivery_delay"]
    found = forecast.weekly_features(*tables).select(*names).orderBy("week").collect()
    assert [r[0] for r in found] == [r[0] for r in expected]
    for a, b in zip(found, expected):
        assert list(a[1:]) == pytest.approx(list(b[1:]))


def test_time_split_keeps_the_last_fifth(spark):
    weekly = spark.sql("SELECT date_add(date'2017-01-02', 7 * int(id div 2)) AS week FROM range(0, 22)")
    split = forecast.time_split(weekly).orderBy("week").collect()
    assert sum(r["is_test"] for r in split) == 6  # ceil(0.2 * 11) = 3 weeks, two rows each
    assert max(r["week"] for r in split if not r["is_test"]) < min(r["week"] for r in split if r["is_test"])


def test_first_item_decides_the_category(spark):
    lines = spark.createDataFrame(
        [(1, 2, 9, "late"), (1, 1, 8, "early"), (1, 1, 7, "earliest")],
        "order_id int, order_item_id int, product_id int, category string",
    )
    assert rows(ratings.order_category(lines)) == [(1, "earliest")]


def test_star_shares_count_unscored_rows(spark):
    full = spark.createDataFrame(
        [("a", 5, day("2017-01-01")), ("b", 1, day("2017-01-02")), ("c", None, day("2017-01-03"))],
        "order_id string, review_score int, order_purchase_timestamp timestamp_ntz",
    )
    (row,) = ratings.monthly_rating_trend(full).collect()
    assert (row["total_reviews"], row["pct_5star"], row["pct_1star"]) == (2, 33.3333, 33.3333)
    one = ratings.best_worst_month(full).first()
    assert (one["best_month"], one["worst_month"], one["overall_rating"]) == ("2017-01", "2017-01", 3.0)


def test_kpis_of_empty_tables(spark, small):
    from tradewind.plans.registry import retail

    r = retail(spark, small)
    empty = [r[n].limit(0) for n in ("orders", "order_items", "order_reviews", "customers")]
    assert rows(kpis.kpi_summary(*empty)) == [(0, None, None, 0, 0)]
    assert rows(kpis.kpi_dashboard(*empty[:3])) == [(0, 0.0, None, None)]
