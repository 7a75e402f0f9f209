"""Invariants of the segments and the forecast, and the batch pipeline end to end."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tradewind.operators import forecast, kpis, rfm
from tradewind.plans import pipeline
from tradewind.plans.registry import retail


@pytest.fixture(scope="module")
def r(spark, small):
    return retail(spark, small)


def test_segments_cover_every_person(r):
    counts = {row["segment"]: row["customers"] for row in kpis.segment_counts(r.segments).collect()}
    assert set(counts) == set(rfm.SEGMENTS) and sum(counts.values()) == r.rfm.count()
    spend = {row["segment"]: row["avg_monetary"] for row in kpis.segment_summary(r.segments).collect()}
    assert spend["High Value"] > spend["Medium Value"] > spend["Low Value"]


def test_segments_do_not_depend_on_the_input_layout(r):
    def clusters(df):
        found = rfm.kmeans_segments(rfm.rfm_scores(df), restarts=2)
        return sorted(tuple(row) for row in found.select(rfm.PERSON, "cluster").collect())

    assert clusters(r.rfm.repartition(1)) == clusters(r.rfm.repartition(8))


def test_elbow_falls_and_starts_at_the_total_spread(r):
    costs = {row["k"]: row["inertia"] for row in rfm.elbow(r.rfm).collect()}
    assert sorted(costs) == list(range(1, 11)) and costs[1] == pytest.approx(3 * r.rfm.count())
    assert all(costs[k + 1] <= costs[k] * 1.001 for k in range(1, 10))


def test_costs_are_near_those_of_the_library(r):
    """Batched fits cost at most one in a hundred more than the best of as many separate ones."""
    scaled = rfm.standardize(r.rfm)
    vectors = VectorAssembler(inputCols=rfm.SCALED, outputCol="features").transform(scaled).persist()
    ours = rfm.fit_kmeans(scaled, [2, 3, 5], cost_tolerance=1e-5)
    for k, (_, cost) in ours.items():
        theirs = min(KMeans(k=k, seed=n, maxIter=100).fit(vectors).summary.trainingCost for n in range(4))
        assert cost <= 1.01 * theirs
    vectors.unpersist()


def test_all_fits_move_in_one_scan(spark, r, monkeypatch):
    """A pass reads the points once for all k and restarts, and gives the means and costs of plain loops."""
    scaled = rfm.standardize(r.rfm)
    starts = rfm.spread_starts(scaled, [1, 2, 4], 2, 7)
    x = np.array([tuple(row) for row in scaled.select(*rfm.SCALED).collect()])
    read = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    points = rfm._points(scaled)
    moved = rfm.lloyd_pass(points.mapInArrow(watch, points.schema), starts)
    assert read.value == len(x) and set(moved) == set(starts)
    for key, centers in starts.items():
        squared = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
        near = squared.argmin(axis=1)
        means = [x[near == n].mean(axis=0) if (near == n).any() else centers[n] for n in range(len(centers))]
        assert moved[key][0] == pytest.approx(np.array(means)) and moved[key][1] == pytest.approx(squared.min(axis=1).sum())
    scans, whole = [], rfm.lloyd_pass
    monkeypatch.setattr(rfm, "lloyd_pass", lambda *a: scans.append(1) or whole(*a))
    rfm.fit_kmeans(scaled, [2, 3], 3)
    assert 1 < len(scans) <= rfm.MAX_ITERATIONS


def test_segments_of_few_or_equal_persons(spark):
    frame = spark.createDataFrame([("a", 1, 1, 2.0), ("b", 1, 1, 2.0)], "customer_unique_id string, recency bigint, frequency bigint, monetary double")
    assert {row["cluster"] for row in rfm.kmeans_segments(frame).collect()} == {0}
    assert [row["inertia"] for row in rfm.elbow(frame, max_k=3).collect()] == [0, 0, 0]
    assert rfm.kmeans_segments(frame.limit(0)).collect() == [] and rfm.elbow(frame.limit(0)).collect() == []


def test_saved_forest_scores_like_the_one_in_memory(r, tmp_path):
    path = str(tmp_path / "model")
    r.forest.write().overwrite().save(path)
    rows = r.weekly_split.filter("is_test")
    kept = sorted(x[0] for x in forecast.predict(r.forest, rows).select("prediction").collect())
    loaded = sorted(x[0] for x in forecast.predict(PipelineModel.load(path), rows).select("prediction").collect())
    assert kept == loaded and len(kept) > 0


def test_importances_and_errors(r):
    weights = [row["importance"] for row in forecast.feature_importance(r.forest).collect()]
    assert sum(weights) == pytest.approx(1.0) and weights == sorted(weights, reverse=True)
    (quality,) = forecast.evaluate(r.predictions).collect()
    rows = r.predictions.select(forecast.TARGET, "prediction").toPandas()
    error = rows[forecast.TARGET] - rows["prediction"]
    spread = ((rows[forecast.TARGET] - rows[forecast.TARGET].mean()) ** 2).sum()
    assert quality["mae"] == pytest.approx(error.abs().mean())
    assert quality["rmse"] == pytest.approx((error**2).mean() ** 0.5)
    assert quality["r2"] == pytest.approx(1 - (error**2).sum() / spread)


def test_training_weeks_precede_test_weeks(r):
    bounds = r.weekly_split.groupBy("is_test").agg(F.min("week"), F.max("week")).collect()
    found = {row[0]: (row[1], row[2]) for row in bounds}
    assert found[False][1] < found[True][0]


def test_pipeline_stops_at_the_first_failure(spark, r, tmp_path, monkeypatch):
    ran = []

    def fails(stages, tables):
        ran.append("fails")
        raise RuntimeError("broken stage")

    monkeypatch.setattr(pipeline, "ANALYSES", [fails, lambda s, t: ran.append("later")])
    raw = {**r.all(), **r.all("raw_")}
    with pytest.raises(RuntimeError, match="broken stage"):
        pipeline.run_pipeline(spark, raw, str(tmp_path / "out"))
    assert ran == ["fails"]


def test_pipeline_writes_every_stage(spark, r, tmp_path):
    report = pipeline.run_pipeline(spark, {**r.all(), **r.all("raw_")}, str(tmp_path / "out")).collect()
    rows = {row["table_name"]: row["row_count"] for row in report}
    assert {name.split("/")[0] for name in rows} == {
        "raw", "reports", "clean", "insights", "explore", "segments", "forecast", "ratings",
    }
    assert rows["raw/customers"] == 2 * rows["clean/customers"] > 0
    assert rows["segments/clusters"] == 3 and rows["explore/correlation"] == 10


def test_command_line_from_csv_files(spark, r, tmp_path, capsys):
    from tradewind.__main__ import main

    for name, df in r.all().items():
        df.write.option("header", True).option("escape", '"').csv(str(tmp_path / "in" / f"{name}.csv"))
    extra = str(tmp_path / "absent.csv")
    with pytest.raises(KeyError):  # a table nobody knows
        main(["--file", f"unknown={extra}", "--output", str(tmp_path / "none")])
    main(["--input", str(tmp_path / "in"), "--file", f"geolocation={extra}", "--output", str(tmp_path / "out")])
    assert "not found: geolocation" in capsys.readouterr().out
    sellers = spark.read.parquet(str(tmp_path / "out" / "insights" / "top_sellers")).collect()
    assert len(sellers) >= 10 and isinstance(sellers[0]["seller_id"], str)
