"""The batch pipeline on larger tables: work is dealt over tasks, and done once."""

import numpy as np
import pytest

from tradewind.functions import quantiles
from tradewind.operators import clean, forecast, rfm
from tradewind.plans import pipeline

PERSONS = "customer_unique_id bigint, recency bigint, frequency bigint, monetary double"


def test_points_are_dealt_by_their_number(spark, monkeypatch, tmp_path):
    """One file of many persons keeps several tasks busy in every pass."""
    persons = spark.range(300_000).selectExpr("id AS customer_unique_id", "id % 365 AS recency", "1 + id % 3 AS frequency", "id % 1009 + 0.5D AS monetary")
    persons.coalesce(1).write.parquet(str(tmp_path / "persons"))
    scaled = rfm.standardize(spark.read.parquet(str(tmp_path / "persons")))
    parts, whole = [], rfm.lloyd_pass
    monkeypatch.setattr(rfm, "lloyd_pass", lambda points, centers: parts.append(points.rdd.getNumPartitions()) or whole(points, centers))
    monkeypatch.setattr(rfm, "MAX_ITERATIONS", 2)
    rfm.fit_kmeans(scaled, [2], 1)
    assert parts == [3, 3]


def test_few_points_stay_in_one_task(spark, monkeypatch):
    points = spark.range(10, numPartitions=5).selectExpr(*[f"CAST(id AS DOUBLE) AS {c}" for c in rfm.SCALED])
    assert rfm._dealt(points).rdd.getNumPartitions() == 1 and rfm._dealt(points.limit(0)).count() == 0


def test_a_point_between_equal_centers_counts_for_the_first(spark):
    x = np.array([(a / 7, b / 3, (a * b) % 5 / 2) for a in range(60) for b in range(60)])
    points = spark.createDataFrame([tuple(map(float, row)) for row in x], ", ".join(f"{c} double" for c in rfm.SCALED))
    starts = {(3, 0): x[[5, 5, 900]], (2, 0): x[[7, 7]], (2, 1): x[[0, 3599]]}
    moved = rfm.lloyd_pass(points, starts)
    for key, centers in starts.items():
        squared = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
        near = squared.argmin(axis=1)
        means = [x[near == n].mean(axis=0) if (near == n).any() else centers[n] for n in range(len(centers))]
        assert moved[key][0] == pytest.approx(np.array(means)) and moved[key][1] == pytest.approx(squared.min(axis=1).sum())


def test_a_point_without_a_value_spoils_one_center_only(spark):
    points = spark.createDataFrame([(None, 0.0, 0.0), (1.0, 1.0, 1.0), (9.0, 9.0, 9.0)], ", ".join(f"{c} double" for c in rfm.SCALED))
    (centers, cost), = rfm.lloyd_pass(points, {(2, 0): np.array([[1.0, 1.0, 1.0], [8.0, 8.0, 8.0]])}).values()
    assert np.isnan(centers[0][0]) and centers[0][1:] == pytest.approx([0.5, 0.5]) and centers[1] == pytest.approx([9.0] * 3)
    assert np.isnan(cost)


def test_a_round_of_quantiles_stays_in_generated_code(spark, monkeypatch):
    """No function of arrays with a lambda, which runs row by row outside the generated code."""
    frame = spark.createDataFrame([(float(k), float(-k) if k % 3 else None) for k in range(200)], "a double, b double")
    plans, whole = [], type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or whole(df))
    assert quantiles.quantile_values(frame, {"a": [0.5], "b": [0.0, 1.0]}) == {"a": [99.5], "b": [-199.0, -1.0]}
    assert any("inline" in p for p in plans) and not any("lambdafunction" in p for p in plans)


def test_cleaned_tables_are_written_once(spark, monkeypatch, tmp_path):
    raw = {
        "order_payments": spark.createDataFrame(
            [(1, 1, "card", 1, 2.0), (1, 1, "card", 1, 2.0), (2, 1, "card", 1, 0.0), (None, 1, None, 2, 3.0)],
            "order_id bigint, payment_sequential int, payment_type string, payment_installments bigint, payment_value double",
        ),
        "customers": spark.createDataFrame(
            [(1, 7, None, "SP", 1), (1, 7, "Rio", "RJ", 0), (None, 8, "Bahia", None, 0), (None, 8, "Bahia", None, 0)],
            "customer_id bigint, customer_unique_id bigint, customer_city string, customer_state string, _row_order int",
        ),
        "sellers": spark.createDataFrame([(1, "x", "y"), (1, "x", "y")], "seller_id bigint, seller_city string, seller_state string"),
    }
    copies, whole = [], clean.materialize
    monkeypatch.setattr(clean, "materialize", lambda df, purpose: copies.append(purpose) or whole(df, purpose))
    monkeypatch.setattr(pipeline, "ANALYSES", [])
    report = pipeline.run_pipeline(spark, raw, str(tmp_path / "out")).collect()
    assert copies == []
    assert {r.table_name: (r.row_count, r.column_count) for r in report if r.table_name.startswith("clean/")} == {
        "clean/customers": (2, 4), "clean/order_payments": (2, 5), "clean/sellers": (2, 3),
    }
    for name, cleaner in clean.CLEANERS.items():
        if name in raw:
            kept = spark.read.parquet(str(tmp_path / "out" / "clean" / name))
            assert sorted(map(repr, kept.collect())) == sorted(map(repr, cleaner(raw[name]).collect()))
    steps = spark.read.parquet(str(tmp_path / "out" / "reports" / "cleaning")).collect()
    assert {(r.table_name, r.step, r.rows_before, r.rows_after) for r in steps} == {
        ("customers", "duplicates", 4, 2), ("order_payments", "zero or negative", 4, 3), ("order_payments", "duplicates", 3, 2),
    }


def test_a_table_whose_count_does_not_fit_is_written_again(spark, monkeypatch, tmp_path):
    payments = spark.createDataFrame([(1, "card", 1, 2.0), (1, "card", 1, 2.0), (2, "card", 1, 0.0)],
                                     "order_id bigint, payment_type string, payment_installments bigint, payment_value double")
    whole, calls = clean.StepCounts.rows, []

    def twice_counted(self):
        calls.append(self)
        return [(t, s, b, a + (len(calls) == 1)) for t, s, b, a in whole(self)]

    monkeypatch.setattr(clean.StepCounts, "rows", twice_counted)
    stages = pipeline.Stages(spark, str(tmp_path / "out"))
    tables = pipeline.clean_stage(stages, {"order_payments": payments})
    assert len(calls) == 2 and [tuple(r) for r in tables["order_payments"].collect()] == [(1, "card", 1, 2.0)]


def test_the_split_reads_written_weeks(spark, monkeypatch, tmp_path):
    """The split reads the weeks twice, so the joins behind them must be done before."""
    orders = spark.sql("SELECT 1 AS order_id, 1 AS customer_id, 'delivered' AS order_status, TIMESTAMP_NTZ'2020-01-06 10:00:00' AS order_purchase_timestamp,"
                       " TIMESTAMP_NTZ'2020-01-08 10:00:00' AS order_delivered_customer_date, TIMESTAMP_NTZ'2020-01-09 10:00:00' AS order_estimated_delivery_date")  # fmt: skip
    tables = {
        "orders": orders,
        "order_items": spark.sql("SELECT 1 AS order_id, 1 AS order_item_id, 2D AS price, 1D AS freight_value"),
        "order_payments": spark.sql("SELECT 1 AS order_id, 3D AS payment_value, 1 AS payment_installments"),
        "order_reviews": spark.sql("SELECT 1 AS order_id, 5 AS review_score"),
    }
    seen = []

    def split(weekly):
        seen.append(weekly)
        raise RuntimeError("seen")

    monkeypatch.setattr(forecast, "time_split", split)
    with pytest.raises(RuntimeError, match="seen"):
        pipeline.forecast_stage(pipeline.Stages(spark, str(tmp_path / "out")), tables)
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString() and seen[0].count() == 1
