"""Replacing a table: all or nothing, also from its own rows."""

import os

import pytest
from pyspark.sql import functions as F

from tradewind.sources.tables import scan_table, write_replace


def test_a_table_is_replaced_by_rows_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    write_replace(spark.range(10), path)
    write_replace(scan_table(spark, path).filter("id % 2 = 0"), path)
    assert sorted(r.id for r in scan_table(spark, path).collect()) == [0, 2, 4, 6, 8]
    assert os.listdir(tmp_path) == ["t"]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_replace(spark.range(3), path)
    with pytest.raises(Exception, match="lost"):
        write_replace(spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), path)
    assert scan_table(spark, path).count() == 3 and os.listdir(tmp_path) == ["t"]


def test_partitions_that_are_gone_go(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6).withColumn("part", F.col("id") % 3)
    write_replace(rows, path, ["part"])
    write_replace(rows.filter("part = 1"), path, ["part"])
    assert sorted(d for d in os.listdir(path) if d.startswith("part=")) == ["part=1"]
    assert scan_table(spark, path).count() == 2
