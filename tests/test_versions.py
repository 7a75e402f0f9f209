"""Tables replaced at once, and derived tables that follow their files."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tradewind.operators import forecast
from tradewind.plans.registry import retail
from tradewind.sources.versions import current, publish, published


def test_readers_see_the_old_or_the_new_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        current(spark, path)
    assert publish(spark.range(3), path) == 0
    before = current(spark, path)
    assert publish(spark.range(5), path) == 1
    assert before.count() == 3 and current(spark, path).count() == 5  # opened before the rewrite: still whole
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, path)
    assert current(spark, path).count() == 5


def test_old_versions_go_and_a_batch_run_again_replaces_its_own(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(6):
        publish(spark.range(n), path, number=n)
    assert sorted(published(spark, path)) == [4, 5]
    assert sum(d.startswith("rows-") for d in os.listdir(path)) == 2
    publish(spark.range(50), path, number=5)
    assert sorted(published(spark, path)) == [4, 5] and current(spark, path).count() == 50
    assert sum(d.startswith("rows-") for d in os.listdir(path)) == 2


def test_derived_tables_follow_the_files(spark, small, tmp_path):
    folder = str(tmp_path / "sf")
    shutil.copytree(small, folder)
    first = retail(spark, folder)
    assert retail(spark, folder) is first
    persons = first.rfm.count()
    os.chmod(folder, 0o755)
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    few = orders.filter("o_custkey % 2 = 0").toPandas()
    os.remove(f"{folder}/orders.parquet")
    few.to_parquet(f"{folder}/orders.parquet", coerce_timestamps="us")
    again = retail(spark, folder)
    assert again is not first and 0 < again.rfm.count() < persons


@pytest.mark.parametrize("rows", [100_000, 400])
def test_forest_does_not_follow_the_shuffle_width(spark, small, monkeypatch, rows):
    """Equal trees at widths 4 and 64, with one partition and with several."""
    monkeypatch.setattr(forecast, "ROWS_PER_PARTITION", rows)
    panel = retail(spark, small).panel_split.persist()
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for width in ("4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        model = forecast.train_forest(panel, group_cols=["customer_state"], trees=5)
        found.append(model.stages[-1].toDebugString.partition("\n")[2])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and (rows > 1000 or panel.count() > 2 * rows)
