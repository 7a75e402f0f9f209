"""Streams against their batch twins, with several files, a restart and a late row."""

import os
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tradewind.operators import kpis
from tradewind.plans.registry import retail
from tradewind.streaming import live

ORDERS = "order_id bigint, order_purchase_timestamp timestamp_ntz"


def day(text):
    return datetime.fromisoformat(text)


def write(spark, folder, rows):
    spark.createDataFrame(rows, ORDERS).coalesce(1).write.mode("append").parquet(folder)


def volume(spark, folder, out, state, window="1 day", delay="2 days", files=1, schema=ORDERS):
    arriving = live.read_arriving(spark, folder, schema, files_per_batch=files)
    query = live.keep_order_volume(arriving, out, state, window, delay)
    query.awaitTermination()
    return query


def days_of(spark, out, window="1 day"):
    return sorted((r["window_start"].date().isoformat(), r["orders"]) for r in live.order_volume(spark, out, window).collect())


def test_windows_survive_a_restart_and_count_late_rows(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def advance():
        volume(spark, folder, out, state)
        live.merge_late_orders(spark, out)
        return days_of(spark, out)

    write(spark, folder, [(1, day("2017-01-01 10:00:00")), (2, day("2017-01-01 11:00:00")), (3, day("2017-01-02 09:00:00"))])
    assert advance() == [("2017-01-01", 2), ("2017-01-02", 1)]
    # a repeated id, and a later day
    write(spark, folder, [(2, day("2017-01-01 11:00:00")), (4, day("2017-01-06 08:00:00"))])
    assert advance() == [("2017-01-01", 2), ("2017-01-02", 1), ("2017-01-06", 1)]
    # far behind the watermark: a new row, a row repeated within the file, and ids counted long ago
    late = [(9, day("2017-01-01 12:00:00"))] * 2 + [(1, day("2017-01-01 10:00:00")), (5, day("2017-01-06 00:00:00"))]
    write(spark, folder, late)
    volume(spark, folder, out, state)
    assert days_of(spark, out) == [("2017-01-01", 2), ("2017-01-02", 1), ("2017-01-06", 2)]
    assert [live.merge_late_orders(spark, out) for _ in range(3)] == [1, 0, 0]
    assert days_of(spark, out) == [("2017-01-01", 3), ("2017-01-02", 1), ("2017-01-06", 2)]
    # the same late row once more, after its merge
    write(spark, folder, [(9, day("2017-01-01 12:00:00")), (7, None)])
    assert advance() == [("2017-01-01", 3), ("2017-01-02", 1), ("2017-01-06", 2)]


@pytest.mark.parametrize("order", ["forward", "backward"])
def test_state_stops_growing_and_no_row_is_lost(spark, tmp_path, order):
    """Forty days in files of one day, all delivered twice: totals are the same forwards and backwards."""
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    numbers = range(40) if order == "forward" else range(39, -1, -1)
    for place, d in enumerate(numbers):
        rows = [(100 * d + k, datetime(2017, 1, 1, 12) + timedelta(days=d, minutes=k)) for k in range(10)]
        file = f"{folder}/part-{place:05}.parquet"
        (tmp_path / "in").mkdir(exist_ok=True)
        table = pa.table({"order_id": [r[0] for r in rows] * 2, "order_purchase_timestamp": pa.array([r[1] for r in rows] * 2, pa.timestamp("us"))})
        pq.write_table(table, file)
        os.utime(file, (1_600_000_000 + place, 1_600_000_000 + place))  # files arrive in this order
    query = volume(spark, folder, out, state, files=4)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    merged = live.merge_late_orders(spark, out)
    assert [n for _, n in days_of(spark, out)] == [10] * 40
    assert merged == 0 if order == "forward" else merged >= 10 * 30  # all but the first batches come late
    assert len(held) >= 10 and max(held) <= 10 * (4 + 4 + 3), held  # two batches and the delay, not 400


def test_batch_size_does_not_change_the_volume(spark, small, tmp_path):
    orders = retail(spark, small)["orders"]
    folder = str(tmp_path / "orders")
    orders.repartition(4, "order_id").write.parquet(folder)
    totals = []
    for files in (1, 4):
        out = str(tmp_path / f"out{files}")
        volume(spark, folder, out, str(tmp_path / f"c{files}"), "7 days", "14 days", files, orders.schema)
        live.merge_late_orders(spark, out)
        totals.append(sorted(map(tuple, live.order_volume(spark, out).collect())))
    assert totals[0] == totals[1] and sum(t[2] for t in totals[0]) == orders.count()


def test_ids_are_dealt_by_window(spark, tmp_path):
    """A window has few files, however many tasks hold the state, and one with most of the rows has several."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    first, tasks = datetime(2017, 1, 1, 12), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(d * 1000 + k, first + timedelta(days=d)) for d in range(40) for k in range(20)]
    rows += [(100_000 + k, first + timedelta(days=20)) for k in range(1000)]
    rows += [(None, first), (None, first), (100, None)]
    spark.createDataFrame(rows * 2, ORDERS).repartition(3).write.parquet(folder)
    volume(spark, folder, out, str(tmp_path / "state"), files=None)
    expected = {(first + timedelta(days=d)).date().isoformat(): 20 + 1000 * (d == 20) + (d == 0) for d in range(40)}
    assert live.merge_late_orders(spark, out) == 0 and dict(days_of(spark, out)) == expected
    assert {p.parent.name for p in tmp_path.glob("out/*/batch=*/*.parquet")} | {"batch=0"} == {"batch=0"}, "a batch without rows writes nothing"
    files = [p.parent.name for p in tmp_path.glob("out/ids/batch=*/*/*.parquet")]
    assert len(files) <= 40 + tasks
    assert 1 < sum("2017-01-21" in name for name in files) <= tasks


def test_no_rows_at_all(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, folder, [(1, None), (None, None)])
    volume(spark, folder, out, str(tmp_path / "state"))
    assert live.merge_late_orders(spark, out) == 0 and days_of(spark, out) == []


def test_running_kpis_equal_the_batch(spark, small, tmp_path):
    r = retail(spark, small)
    names = ("orders", "order_items", "order_reviews")
    folders = {n: str(tmp_path / n) for n in names}
    halves = {n: r[n].randomSplit([0.5, 0.5], seed=7) for n in names}
    state, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    for part in (0, 1):
        for n in names:
            halves[n][part].repartition(2).write.mode("append").parquet(folders[n])
        streams = [live.read_arriving(spark, folders[n], r[n].schema) for n in names]
        live.keep_snapshot(live.live_kpis(live.kpi_feed(*streams)), state, checkpoint).awaitTermination()
    result = live.snapshot(spark, state)
    (found,) = result.select(*[F.round(c, 2) for c in result.columns]).collect()
    (expected,) = kpis.kpi_dashboard(r["orders"], r["order_items"], r["order_reviews"]).collect()
    assert list(found) == [round(v, 2) for v in expected]
