"""Recency, frequency and spend per person, scores, and k-means segments."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.days import floor_days
from tradewind.functions.quantiles import quantile_values
from tradewind.functions.shaping import materialize

PERSON = "customer_unique_id"
FEATURES = ["recency", "frequency", "monetary"]
SCALED = [f"z_{c}" for c in FEATURES]
# Names of the segments by spend, edges of the frequency score.
SEGMENTS = ["High Value", "Medium Value", "Low Value"]
FREQUENCY_EDGES = [1, 2, 3, 5]
QUINTILES = [0.2, 0.4, 0.6, 0.8]
SEED = 42
RESTARTS = 10
MAX_ITERATIONS = 300
TOLERANCE = 1e-4  # a fit has settled when no coordinate of a center moves further
SAMPLE = 5_000  # persons that the starting centers are chosen from
POINTS_PER_TASK = 131_072  # a pass costs much per person and few bytes, so file sizes do not decide on its tasks


def order_value(payments: DataFrame) -> DataFrame:
    """Σ payments per order."""
    paid = payments.filter(F.col("order_id").isNotNull()).groupBy("order_id")
    return paid.agg(F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("payment_value"))


def rfm_base(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Delivered orders with their person and value."""
    return (
        orders.filter(F.col("order_status") == "delivered")
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(customers.select("customer_id", PERSON), "customer_id")
        .join(order_value(payments), "order_id")
        .select("order_id", PERSON, "order_purchase_timestamp", "payment_value")
    )


def rfm_values(base: DataFrame) -> DataFrame:
    """Per person: days since the last order, orders, and total spend.

    Days count back from one day after the last order of anybody.
    """
    persons = (
        base.filter(F.col(PERSON).isNotNull())
        .groupBy(PERSON)
        .agg(
            F.max("order_purchase_timestamp").alias("last_order"),
            F.count("order_id").alias("frequency"),
            F.sum("payment_value").alias("monetary"),
        )
    )
    # the joins and the grouping run once, not again for the last order of anybody
    persons = materialize(persons, "persons")
    latest = persons.agg(F.max("last_order")).scalar()
    reference = latest + F.expr("INTERVAL '1' DAY")
    return persons.select(PERSON, floor_days(reference, F.col("last_order")).alias("recency"), "frequency", "monetary")


def bucket(value: Column, edges: Sequence[float]) -> Column:
    """Number of the right-closed bin: 1 up to the first edge, then 2, ..."""
    chain = F.when(value.isNull(), F.lit(None).cast("int"))
    for number, edge in enumerate(edges, start=1):
        chain = chain.when(value <= F.lit(edge), number)
    return chain.otherwise(len(edges) + 1)


def fixed_bucket(value: Column, edges: Sequence[float] = FREQUENCY_EDGES) -> Column:
    """Score by fixed edges: (0,1] (1,2] (2,3] (3,5] (5,inf); NULL outside."""
    return F.when(value > 0, bucket(value, edges))


def quantile_bucket(df: DataFrame, column: str, alias: str, probabilities: Sequence[float] = QUINTILES) -> DataFrame:
    """Adds the number of the quantile bin of a column.

    Equal values share a bin, unlike ``ntile``; equal edges merge their bins.
    """
    edges = quantile_values(df, {column: probabilities})[column]
    return df.withColumn(alias, bucket(F.col(column), edges))


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Adds scores 1 to 5 (recent, frequent, spending = 5) and their sum.

    Reads ``rfm`` several times, so pass a written table.
    """
    edges = quantile_values(rfm, {"recency": QUINTILES, "monetary": QUINTILES})
    return rfm.withColumns(
        {
            "r_score": 6 - bucket(F.col("recency"), edges["recency"]),
            "f_score": fixed_bucket(F.col("frequency")),
            "m_score": bucket(F.col("monetary"), edges["monetary"]),
        }
    ).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def rfm_score_distribution(scored: DataFrame) -> DataFrame:
    """Persons per combined score."""
    return scored.groupBy("rfm_score").agg(F.count("*").alias("persons")).orderBy("rfm_score")


def _z_scores(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, int]:
    stats = df.agg(
        F.count("*").alias("rows"),
        *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("dev")).alias(c) for c in columns],
    ).first()
    scaled = df.withColumns(
        {f"z_{c}": (F.col(c) - F.lit(stats[c]["mean"])) / F.lit(stats[c]["dev"] or 1.0) for c in columns}
    )
    return scaled, stats["rows"]


def standardize(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Adds z-scores (population deviation); a constant column becomes zero."""
    return _z_scores(df, columns)[0]


Starts = dict[tuple[int, int], np.ndarray]  # (k, restart) -> k centers


def _points(scaled: DataFrame) -> DataFrame:
    return scaled.select(*[F.col(c).cast("double").alias(c) for c in SCALED])


def _dealt(points: DataFrame) -> DataFrame:
    """The points in as many even parts as their number asks for, however few files they come from."""
    return points.repartition(max(1, math.ceil(points.count() / POINTS_PER_TASK)))


def spread_starts(scaled: DataFrame, ks: Sequence[int], restarts: int, seed: int) -> Starts:
    """Starting centers by k-means++ on a sample of at most ``SAMPLE`` persons, drawn by a hash of the id.

    Neither the input files nor the cluster decide on the sample, and each next center is the best of a few drawn ones.
    """
    drawn = scaled.orderBy(F.xxhash64(PERSON, F.lit(seed)), PERSON).limit(SAMPLE).select(*SCALED).collect()
    sample = np.array([tuple(row) for row in drawn], float).reshape(-1, len(SCALED))
    starts: Starts = {}
    for k in ks if len(sample) else ():
        for restart in range(restarts):
            rng = np.random.default_rng([seed, k, restart])
            centers = sample[[rng.integers(len(sample))]]
            nearest = ((sample - centers[0]) ** 2).sum(axis=1)
            while len(centers) < k:
                p = nearest / nearest.sum() if nearest.sum() > 0 else None
                tried = sample[rng.choice(len(sample), 2 + int(math.log(k)), p=p)]
                left = np.minimum(nearest, ((sample[None] - tried[:, None]) ** 2).sum(axis=2))
                best = int(left.sum(axis=1).argmin())
                centers, nearest = np.vstack([centers, tried[best]]), left[best]
            starts[k, restart] = centers
    return starts


def lloyd_pass(points: DataFrame, centers: Starts) -> dict[tuple[int, int], tuple[np.ndarray, float]]:
    """For all sets of centers from one scan: the means of the points nearest to each, and the cost of the set.

    A task sends one row per center, however many points it has read; an empty cluster keeps its center.
    """
    keys = sorted(centers)
    every = np.vstack([centers[key] for key in keys])
    edges = np.cumsum([0] + [len(centers[key]) for key in keys])
    squares = (every**2).sum(axis=1)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cost = np.zeros((len(every), every.shape[1] + 1)), np.zeros(len(keys))
        for batch in batches:
            whole = np.column_stack([*[c.to_numpy(zero_copy_only=False) for c in batch.columns], np.ones(batch.num_rows)])
            for at in range(0, len(whole), 2048):
                x = whole[at : at + 2048]
                # a row per center: the squared distance without that of the point itself, which decides nothing
                distance = -2 * every @ x[:, :-1].T + squares[:, None]
                norm = (x[:, :-1] ** 2).sum(axis=1)
                nearest = np.empty(distance.shape, bool)
                for n, (a, b) in enumerate(itertools.pairwise(edges)):
                    least = distance[a:b].min(axis=0)
                    cost[n] += np.maximum(least + norm, 0).sum()
                    np.equal(distance[a:b], least, out=nearest[a:b])
                found = nearest.astype(float) @ x
                for n in np.flatnonzero(np.add.reduceat(found[:, -1], edges[:-1]) != len(x)):  # ties go to the first one
                    a, b = edges[n : n + 2]
                    first = distance[a:b].argmin(axis=0)
                    found[a:b] = np.column_stack([np.bincount(first, column, b - a) for column in x.T])
                sums += found
        places = np.append(np.arange(len(every)), -1 - np.arange(len(keys)))  # costs have negative numbers
        values = np.vstack([sums, np.column_stack([cost, np.zeros((len(keys), every.shape[1]))])])
        yield pa.RecordBatch.from_arrays([pa.array(places), *map(pa.array, values.T)], names=names)

    names = ["place", *[f"v{k}" for k in range(every.shape[1] + 1)]]
    parts = points.mapInArrow(work, ", ".join(f"{n} {'long' if n == 'place' else 'double'}" for n in names))
    found = {row[0]: row[1:] for row in parts.groupBy("place").agg(*[F.sum(n).alias(n) for n in names[1:]]).collect()}
    moved = {}
    for n, (key, (a, b)) in enumerate(zip(keys, itertools.pairwise(edges), strict=True)):
        sums = np.array([found[k] for k in range(a, b)])
        held = sums[:, -1:] > 0
        moved[key] = np.where(held, sums[:, :-1] / np.maximum(sums[:, -1:], 1), centers[key]), float(found[-1 - n][0])
    return moved


def fit_kmeans(
    scaled: DataFrame, ks: Sequence[int], restarts: int = RESTARTS, seed: int = SEED, cost_tolerance: float = 0.0
) -> dict[int, tuple[np.ndarray, float]]:
    """Per k the centers and the cost of the cheapest of several k-means fits with different starts.

    A fit has settled when its centers hardly move, or when a pass lowers its cost by no more than a share of ``cost_tolerance``.

    All fits move together: one scan of the points is one iteration for every k and restart that has not settled, so there are
    at most ``MAX_ITERATIONS`` scans.  Centers come sorted, so that equal fits have equal cluster numbers.
    """
    points = _dealt(_points(scaled)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        open_ = spread_starts(scaled, ks, restarts, seed)
        done: dict[tuple[int, int], tuple[np.ndarray, float]] = {}
        for _ in range(MAX_ITERATIONS):
            if not open_:
                break
            for key, (centers, cost) in lloyd_pass(points, open_).items():
                before = done[key][1] if key in done else math.inf
                settled = np.abs(centers - open_[key]).max() <= TOLERANCE or before - cost <= cost_tolerance * cost
                done[key], open_[key] = (centers, cost), centers
                if settled:
                    del open_[key]
    finally:
        points.unpersist()
    best: dict[int, tuple[np.ndarray, float]] = {}
    for (k, _), (centers, cost) in sorted(done.items(), key=lambda x: x[0]):
        if k not in best or cost < best[k][1] * (1 - 1e-9):
            order = np.lexsort(np.round(centers, 6).T)
            best[k] = centers[order], cost
    return best


def elbow(rfm: DataFrame, max_k: int = 10, restarts: int = RESTARTS) -> DataFrame:
    """Within-cluster sum of squares for k = 1 .. max_k; no rows without persons."""
    scaled, rows = _z_scores(rfm, FEATURES)
    if not rows:
        return rfm.sparkSession.createDataFrame([], "k int, inertia double")
    squares = sum(F.col(z) * F.col(z) for z in SCALED)
    costs = [(1, scaled.agg(F.sum(squares)).first()[0])]
    fits = fit_kmeans(scaled, range(2, max_k + 1), restarts, cost_tolerance=1e-5)
    costs += [(k, cost) for k, (_, cost) in sorted(fits.items())]
    return rfm.sparkSession.createDataFrame(costs, "k int, inertia double")


def nearest_center(centers: np.ndarray) -> Column:
    """Number of the nearest center, the smaller one on ties."""
    distances = [
        F.struct(sum((F.col(z) - F.lit(float(v))) * (F.col(z) - F.lit(float(v))) for z, v in zip(SCALED, center, strict=True)).alias("d"), F.lit(n).alias("n"))
        for n, center in enumerate(centers)
    ]
    return F.array_min(F.array(*distances))["n"]


def kmeans_segments(scored: DataFrame, k: int = len(SEGMENTS), restarts: int = RESTARTS) -> DataFrame:
    """Adds the cluster number of the best of several k-means fits."""
    scaled, rows = _z_scores(scored, FEATURES)
    if not rows:
        return scored.withColumn("cluster", F.lit(0))
    centers, _ = fit_kmeans(scaled, [k], restarts)[k]
    return scaled.select(*scored.columns, nearest_center(centers).alias("cluster"))


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Per cluster: persons, average recency, frequency, spend and score."""
    return clustered.groupBy("cluster").agg(
        F.count(PERSON).alias("customer_count"),
        F.round(F.avg("recency"), 2).alias("avg_recency"),
        F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        F.round(F.avg("monetary"), 2).alias("avg_monetary"),
        F.round(F.avg("rfm_score"), 2).alias("avg_rfm_score"),
    )


def label_segments(clustered: DataFrame, labels: Sequence[str] = SEGMENTS) -> DataFrame:
    """Names the clusters by average spend, highest first.

    The joined side has one row per cluster.
    """
    place = F.row_number().over(Window.orderBy(F.col("avg_monetary").desc(), "cluster"))
    names = F.array(*[F.lit(name) for name in labels])
    labelled = cluster_summary(clustered).select("cluster", F.get(names, place - 1).alias("segment"))
    return clustered.join(F.broadcast(labelled), "cluster").select(*clustered.columns, "segment")


def rfm_segments(rfm: DataFrame, restarts: int = RESTARTS) -> DataFrame:
    """Scores, cluster and segment per person (the derived table other jobs read)."""
    clustered = kmeans_segments(rfm_scores(rfm), restarts=restarts)
    # naming the clusters reads them twice
    return label_segments(materialize(clustered, "clusters"))


def segment_profile(segments: DataFrame) -> DataFrame:
    """Average features per segment, and the same scaled to 0..1 over the segments."""
    averages = segments.groupBy("segment").agg(*[F.round(F.avg(c), 2).alias(c) for c in FEATURES])
    overall = Window.partitionBy()
    scaled = {
        f"{c}_scaled": (F.col(c) - F.min(c).over(overall))
        / F.nullif(F.max(c).over(overall) - F.min(c).over(overall), F.lit(0.0))
        for c in FEATURES
    }
    return averages.withColumns(scaled).orderBy("segment")


def segment_points(segments: DataFrame, fractions: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """(recency, monetary, segment) of every person, or of a stratified sample for a plot."""
    points = segments.select("recency", "monetary", "segment")
    return points if fractions is None else points.sampleBy("segment", fractions, seed)
