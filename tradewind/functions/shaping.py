"""Small relational helpers that stay safe when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.session import workspace

# Optional column that loaders add to remember the order of rows in the files.
ROW_ORDER = "_row_order"


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first one by ``order_by``, remaining columns breaking ties.

    Without ``order_by`` the file order decides where the loader recorded it.  A
    minimum over structs merges on the map side, so a key with billions of copies
    sends one row per task instead of its whole group, as a window would.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if order_by is None:
        order_by = [ROW_ORDER] if ROW_ORDER in rest else []
    ordered = [c for c in order_by if c not in keys]
    ordered += [c for c in rest if c not in ordered]
    first = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("first"))
    return first.select(*[F.col(c) if c in keys else F.col("first")[c].alias(c) for c in df.columns])


def left_join_fanout(left: DataFrame, keys: DataFrame, key: str, *sides: DataFrame) -> DataFrame:
    """Left join of one row per key with several sides that may each hold many rows per key.

    Adaptive execution can split a hot key of any side in an inner join, but not the right side of a left join.  So each
    side gets one row of NULLs for every key of ``keys``, the keys of ``left``, that it lacks, and all joins are inner ones.  The sides
    do not nest: each is read once for its rows and once for its keys, a narrow scan.  Rows of ``left`` without
    key come with NULLs.
    """
    known = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    joined, bare = left, left.filter(F.col(key).isNull())
    for side in sides:
        missing = known.join(side.select(key), key, "left_anti")
        filler = {f.name: F.lit(None).cast(f.dataType) for f in side.schema if f.name != key}
        joined = joined.join(side.unionByName(missing.select(key, *[v.alias(n) for n, v in filler.items()])), key)
        bare = bare.withColumns(filler)
    return joined.unionByName(bare)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to a table in the shared work folder and read them back.

    Cuts lineage before a step that reads its input several times: a lost executor
    then costs a re-read instead of a re-run of the shuffles behind it.
    """
    spark = df.sparkSession
    path = workspace(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unpivot_row(df: DataFrame, fields: dict[str, dict[str, Column]], label: str) -> DataFrame:
    """Turn one aggregated row into one row per entry of ``fields``."""
    rows = [
        F.struct(F.lit(name).alias(label), *[value.alias(k) for k, value in values.items()])
        for name, values in fields.items()
    ]
    return df.select(F.inline(F.array(*rows)))
