"""Exact quantiles by narrowing histograms, without a column in one task.

``percentile`` keeps every distinct value of a column in a single buffer, and sketches of
all tasks meet in one reducer.  Here every wanted order statistic has a range that holds it.
A round counts the values of each range in a fixed number of cells, with a hash
aggregation whose partial results have at most that many rows a task, and keeps the cell that
holds the rank.  Cells remember their least and greatest value, so the ranges shrink to one
value.  A range with no more rows than cells is counted by value, which ends it.  Every size of input takes the same path.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tradewind.functions.shaping import materialize

CELLS = 1024

#: Per column a least and a greatest value, or None for a column without values.
Bounds = Mapping[str, tuple[float, float] | None]


class Range(NamedTuple):
    """Values of a column between two bounds, both included, and the number of rows that hold them, once it is known."""

    column: str
    low: float
    high: float
    rows: int | None = None


def _number(column: str) -> Column:
    """A column as doubles, NaN as NULL."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _cell(value: Column, low: float, high: float, cells: int) -> Column:
    """Number of the cell of a value; the two bounds have cells of their own."""
    width = high / 2 - low / 2  # halves do not overflow
    inner = F.lit(1).cast("long")
    if math.isfinite(width) and width > 0:
        share = (value / 2 - F.lit(low / 2)) / F.lit(width)
        inner = F.least(F.greatest(F.floor(share * (cells - 2)) + 1, F.lit(1)), F.lit(cells - 2)).cast("long")
    return F.when(value == F.lit(low), 0).when(value == F.lit(high), cells - 1).otherwise(inner).cast("int")


def _counts(values: DataFrame, ranges: Sequence[Range], cells: int) -> dict[int, list]:
    """Per range the filled cells in order: rows with n, low and high."""
    inside = [F.col(r.column).between(F.lit(r.low), F.lit(r.high)) for r in ranges]
    few = [r.rows is not None and r.rows <= cells for r in ranges]
    hits = [
        F.when(hit, F.struct(F.lit(i).alias("slot"),
                             (F.lit(None).cast("int") if few[i] else _cell(F.col(r.column), r.low, r.high, cells)).alias("cell"),
                             (F.col(r.column) if few[i] else F.lit(None).cast("double")).alias("value"),
                             F.col(r.column).alias("v")))
        for i, (r, hit) in enumerate(zip(ranges, inside, strict=True))
    ]
    counted = (
        values.filter(reduce(Column.__or__, inside))
        .select(F.inline(F.array(*hits)))  # a filter of the array would run outside the generated code
        .filter("slot IS NOT NULL")
        .groupBy("slot", "cell", "value")
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    found: dict[int, list] = {i: [] for i in range(len(ranges))}
    for row in sorted(counted.collect(), key=lambda row: (row["slot"], row["low"])):
        found[row["slot"]].append(row)
    return found


def observed_bounds(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Callable[[], Bounds]]:
    """The same rows, and what gives the bounds of some columns once a job has written them all.

    Bounds are taken by the job itself, without a pass of their own, and stay right when tasks run again.  Only a job that has
    rows tells them: an empty result may be left out of its plan.
    """
    ends = Observation()
    lows = [F.min(_number(c)).alias(f"low {c}") for c in columns]
    highs = [F.max(_number(c)).alias(f"high {c}") for c in columns]

    def bounds() -> Bounds:
        seen = ends.get
        return {c: None if seen[f"low {c}"] is None else (seen[f"low {c}"], seen[f"high {c}"]) for c in columns}

    return df.observe(ends, *lows, *highs), bounds


def quantile_values(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], cells: int = CELLS, bounds: Bounds | None = None
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, one per wanted probability; NULL and NaN are skipped.

    A column without values has None.  A round reads the input once, with the ranges as filters
    that reach a Parquet scan, and brings at most ``cells`` rows per range to the driver.  ``bounds`` between which all values
    lie, also those of more rows, save the pass that looks for them.
    """
    values = df.select(*[_number(c).alias(c) for c in wanted])
    if bounds is None:
        ends = values.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in wanted]).first()
        bounds = {c: None if ends[c]["low"] is None else tuple(ends[c]) for c in wanted}
    whole = [Range(c, *bounds[c]) for c in wanted if bounds[c] is not None]
    counts = dict(zip(whole, _counts(values, whole, cells).values(), strict=True)) if whole else {}
    rows = {c: 0 for c in wanted} | {r.column: sum(row["n"] for row in cells_) for r, cells_ in counts.items()}
    open_: dict[tuple[str, int], tuple[Range, int]] = {}  # order statistic -> its range, and the rows below it
    for r in whole:
        n = rows[r.column]
        for p in wanted[r.column] if n else ():
            rank = math.floor(p * (n - 1))
            open_ |= {(r.column, k): (r, 0) for k in {rank, min(rank + 1, n - 1)}}
    solved: dict[tuple[str, int], float] = {}
    while open_:
        for (c, k), (r, below) in list(open_.items()):
            for row in counts[r]:
                if k < below + row["n"]:
                    open_[c, k] = Range(c, row["low"], row["high"], row["n"]), below
                    break
                below += row["n"]
            else:
                raise RuntimeError("the input changed between two rounds")
        solved |= {key: r.low for key, (r, _) in open_.items() if r.low == r.high}
        open_ = {key: state for key, state in open_.items() if key not in solved}
        if ranges := sorted({r for r, _ in open_.values()}):
            counts = dict(zip(ranges, _counts(values, ranges, cells).values(), strict=True))

    def at(c: str, p: float) -> float | None:
        n = rows[c]
        if not n:
            return None
        rank = math.floor(p * (n - 1))
        low, high = solved[c, rank], solved[c, min(rank + 1, n - 1)]
        return low if low == high else low + (high - low) * (p * (n - 1) - rank)

    return {c: [at(c, float(p)) for p in probs] for c, probs in wanted.items()}


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], cells: int = CELLS, bounds: Bounds | None = None
) -> DataFrame:
    """The same quantiles as rows (column, probability, value); a column without values has none."""
    found = quantile_values(df, wanted, cells, bounds)
    rows = [(c, float(p), v) for c, probs in wanted.items() for p, v in zip(probs, found[c], strict=True) if v is not None]
    return df.sparkSession.createDataFrame(rows, "column string, probability double, value double")


def _cell_between(value: Column, low: Column, high: Column, cells: int) -> Column:
    """Number of the cell of a value in a range given by columns; the two bounds have cells of their own."""
    width = high / 2 - low / 2
    share = (value / 2 - low / 2) / width
    inner = F.least(F.greatest(F.floor(share * (cells - 2)) + 1, F.lit(1).cast("long")), F.lit(cells - 2).cast("long"))
    usable = (width > 0) & (width < float("inf"))
    return F.when(value == low, 0).when(value == high, cells - 1).when(usable, inner).otherwise(1).cast("int")


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, probabilities: Sequence[float], cells: int = CELLS
) -> DataFrame:
    """Linearly interpolated quantiles per group: the keys and an array ``quantiles`` in the order of ``probabilities``.

    The ranges of all groups are a table that each round joins to the values and replaces by a narrower one, so groups
    may be many, and one group may hold most of the rows: a task sends at most one row per group, range and cell,
    and adaptive execution splits a hot group's join.  NULL and NaN are skipped; rows with a NULL key
    and groups without values have no result.
    """
    keys = list(keys)
    v = F.col(column).cast("double")
    values = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v")).dropna(subset=keys)
    ends = values.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    ends = materialize(ends, "quantile-ends")
    last = F.col("_n") - 1
    lower = {p: F.floor(F.lit(float(p)) * last) for p in probabilities}
    wanted = F.array_distinct(F.array(*[F.least(k + step, last) for k in lower.values() for step in (0, 1)]))
    none = F.lit(0).cast("long")
    state = materialize(ends.select(*keys, F.explode(wanted).alias("_rank"), "_low", "_high", none.alias("_below")), "quantile-ranges")
    place = Window.partitionBy(*keys, "_rank").orderBy("_cell")  # at most ``cells`` rows
    while not (open_ := state.filter("_low < _high")).isEmpty():
        ranges = open_.select(*keys, "_low", "_high").distinct()
        inside = values.join(ranges, keys).filter("_v BETWEEN _low AND _high")
        cell = _cell_between(F.col("_v"), F.col("_low"), F.col("_high"), cells)
        counted = inside.groupBy(*keys, "_low", "_high", cell.alias("_cell")).agg(
            F.count("_v").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
        )
        found = open_.join(counted, [*keys, "_low", "_high"]).withColumn("_before", F.col("_below") + F.sum("_n").over(place) - F.col("_n"))
        found = found.filter("_rank >= _before AND _rank < _before + _n")
        narrower = found.select(*keys, "_rank", F.col("_least").alias("_low"), F.col("_most").alias("_high"), F.col("_before").alias("_below"))
        state = materialize(state.filter("_low = _high").unionByName(narrower), "quantile-ranges")
    solved = state.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_low"))).alias("_at"))
    at = F.col("_at")

    def between(p: float, k: Column) -> Column:
        low, high = at[k], at[F.least(k + 1, last)]
        part = F.lit(float(p)) * last - k
        return F.when((low == high) | (part == 0), low).otherwise(low + (high - low) * part)

    quantiles = F.array(*[between(p, k) for p, k in lower.items()])
    return ends.join(solved, keys).select(*keys, quantiles.alias("quantiles"))
