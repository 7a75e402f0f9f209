import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewind.functions import quantiles
from tradewind.functions.quantiles import grouped_quantiles, quantile_values

PROBS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 11, 149, 150, 151, 152])
@pytest.mark.parametrize("cells", [4, 1024])
def test_matches_pandas_at_every_length(spark, n, cells):
    values = [float((i * 7919) % 97) + i / 1000 for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    expected = pd.Series(values).quantile(PROBS).tolist()
    assert quantile_values(df, {"v": PROBS}, cells)["v"] == pytest.approx(expected, abs=1e-9)


def test_brackets_hold_when_one_value_owns_a_third(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(1) * 100).alias("v"))
    values = [r[0] for r in df.collect()]
    found = quantile_values(df.repartition(7), {"v": PROBS}, cells=50)["v"]
    assert found == pytest.approx(pd.Series(values).quantile(PROBS).tolist(), abs=1e-9)


def test_a_round_counts_on_the_map_side_and_filters_the_scan(spark, tmp_path):
    spark.range(5_000).select(F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    seen = []
    counts = quantiles._counts
    quantiles._counts = lambda values, ranges, cells: seen.append(list(ranges)) or counts(values, ranges, cells)
    try:
        assert quantile_values(df, {"v": [0.5]}, cells=64)["v"] == [2499.5]
    finally:
        quantiles._counts = counts
    assert 1 < len(seen) <= 4 and all(r.high - r.low < 100 for r in seen[1])


@pytest.mark.parametrize("bounds", [None, (0.0, 1e6)])
def test_few_rows_left_end_it_and_known_bounds_save_a_pass(spark, bounds):
    """20,000 values in 1,024 cells: a round narrows to some 20 rows, the next counts them by value."""
    read = spark.sparkContext.accumulator(0)

    def work(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    # values in pairs that are nearer to each other than a cell of the second round is wide
    values = [float(k // 2 * 10) + 1e-7 * (k % 2) for k in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3).mapInArrow(work, "v double")
    found = quantile_values(df, {"v": PROBS}, bounds=None if bounds is None else {"v": bounds})["v"]
    assert found == pytest.approx(pd.Series(values).quantile(PROBS).tolist(), abs=1e-12)
    assert read.value == (3 if bounds is None else 2) * len(values)


def test_known_bounds_of_odd_columns(spark):
    rows = [(None, -0.0, None), (None, 0.0, float("nan")), (None, None, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    wanted = {c: [0.25, 0.75] for c in "abc"}
    for bounds in (None, {"a": None, "b": (-1.0, 5.0), "c": (7.0, 7.0)}, {"a": (1.0, 1.0), "b": (0.0, 0.0), "c": (float("-inf"), float("inf"))}):
        assert quantile_values(df, wanted, bounds=bounds) == {"a": [None, None], "b": [0.0, 0.0], "c": [7.0, 7.0]}
        assert quantile_values(df.limit(0), wanted, bounds=bounds) == {c: [None, None] for c in "abc"}


def test_infinite_and_missing_values(spark):
    rows = [(float("-inf"),), (1.0,), (2.0,), (1e308,), (-1e308,), (float("inf"),), (float("nan"),), (None,)]
    found = quantile_values(spark.createDataFrame(rows, "v double"), {"v": [0.4, 0.6]})["v"]
    assert found == pytest.approx([1.0, 2.0])


def test_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert quantile_values(df, {"a": [0.5], "b": [0.5]}) == {"a": [2.0], "b": [None]}
    assert quantile_values(df.limit(0), {"a": [0.25, 0.75]}) == {"a": [None, None]}


@pytest.mark.parametrize("cells", [4, 1024])
def test_groups_match_pandas(spark, cells):
    """Many groups of all sizes, one with most of the rows and one value in a third of them; ranges of their own."""
    rows = [(f"g{k % 7}", float((k * 7919) % 97) * 10.0 ** (k % 7) + k / 1000) for k in range(400)]
    rows += [("hot", 5.0 if k % 3 == 0 else float((k * 31) % 1009)) for k in range(4000)]
    rows += [("one", 3.5), ("none", None), (None, 1.0), ("odd", float("nan")), ("odd", 2.0), ("odd", float("inf")), ("odd", float("-inf"))]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(5)
    found = {r["g"]: list(r["quantiles"]) for r in grouped_quantiles(frame, ["g"], "v", PROBS[:-1] + [1.0], cells).collect()}
    plain = pd.DataFrame([r for r in rows if r[0] and r[1] is not None and abs(r[1]) < 1e300], columns=["g", "v"])
    expected = plain[plain.g != "odd"].groupby("g").v.quantile(PROBS).unstack()
    assert set(found) == set(expected.index) | {"odd"}
    for g, row in expected.iterrows():
        assert found[g] == pytest.approx(row.tolist(), rel=1e-9)
    assert found["odd"][3] == 2.0 and found["odd"][0] == float("-inf")


def test_groups_of_several_keys_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "b", 7.0), (2, None, 9.0)], "x int, y string, v double")
    found = grouped_quantiles(frame, ["x", "y"], "v", [0.5]).collect()
    assert sorted((r.x, r.y, r.quantiles[0]) for r in found) == [(1, "a", 1.5), (1, "b", 7.0)]
    assert grouped_quantiles(frame.limit(0), ["x"], "v", [0.5]).collect() == []
