"""Exact top-k inner product search over norm buckets.

Vectors are grouped by length (each bucket spans a fixed ratio) and buckets are cut into blocks
of bounded size.  A query first meets the longest vectors, which gives a lower
bound for its k-th best score.  A bucket whose longest vector cannot reach the bound is not
visited.  Within a block the bound becomes a local cosine threshold, and the block chooses:
with a high threshold, candidates are pruned by the feasible range of the query's
largest coordinates; with a low one, by length alone.  What remains is verified by exact
integer products, and the bound rises as blocks are worked through from long to short.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import store

K = 20
SCALE = 64
RATIO = 1.1  # longest over shortest vector of a bucket
BLOCK_VECTORS = 16_384
QUERY_VECTORS = 4_096
HEAD_VECTORS = 512
COORDINATE_COSINE = 0.5  # from this local threshold on, prune by coordinates
FOCUS = 3  # coordinates looked at
CHUNK = 2_048


def quantize(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, ints (floor of scaled components) and norm; vectors with a null or non-finite part go."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    rows = vectors.filter(x.isNotNull() & ~bad & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long"), ints.alias("ints"))
    squares = F.aggregate("ints", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return rows.withColumn("norm", F.sqrt(squares))


def norm_bucket(norm: Column) -> Column:
    """Bucket number; a double has a bounded number of them."""
    return F.when(norm > 0, F.floor(F.log(norm) / math.log(RATIO))).otherwise(-1).cast("int")


def matrix(arrays: list, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros, in the fastest type that is exact."""
    out = np.zeros((len(arrays), width), np.int64)
    for k, row in enumerate(arrays):
        out[k, : len(row)] = row
    return out


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """A float type that holds every partial sum of the products, else 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


class Best:
    """The k best (score, smaller id first) of some queries, improved chunk by chunk."""

    def __init__(self, queries: int, k: int, bounds: np.ndarray):
        self.k, self.bounds = k, bounds.astype(float).copy()
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(queries)]

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.bounds[q]
        if not keep.any():
            return
        ids = np.concatenate([self.found[q][0], ids[keep]])
        scores = np.concatenate([self.found[q][1], scores[keep].astype(np.int64)])
        order = np.lexsort((ids, -scores))[: self.k]
        self.found[q] = ids[order], scores[order]
        if len(order) == self.k:
            self.bounds[q] = max(self.bounds[q], scores[order][-1])


def search_block(q_ids, q_rows, q_norms, bounds, c_ids, c_rows, c_norms, k=K) -> Iterator[tuple[int, int, int]]:
    """(query, vector, score) of the k best of one block for each query, at or above its bound."""
    width = max(q_rows.shape[1], c_rows.shape[1])
    order = np.lexsort((c_ids, -c_norms))
    c_ids, c_rows, c_norms = c_ids[order], c_rows[order], c_norms[order]
    kind = exact_type(q_rows, c_rows)
    queries, rows = q_rows.astype(kind), c_rows.astype(kind)
    best = Best(len(q_ids), k, bounds)
    unit = c_rows / np.maximum(c_norms, 1e-300)[:, None]
    for start in range(0, len(c_ids), CHUNK):
        part = slice(start, start + CHUNK)
        longest = c_norms[start]
        reach = q_norms * longest
        alive = np.flatnonzero(reach * (1 + 1e-9) >= best.bounds)
        if not len(alive):
            break
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(reach[alive] > 0, best.bounds[alive] / reach[alive], -1.0)
        by_coordinate = cosine >= COORDINATE_COSINE if width else np.zeros(len(alive), bool)
        for q, t in zip(alive[by_coordinate], cosine[by_coordinate], strict=True):
            left = np.arange(start, min(start + CHUNK, len(c_ids)))
            direction = q_rows[q] / q_norms[q]
            t = min(t, 1.0)
            for f in np.argsort(-np.abs(direction), kind="stable")[:FOCUS]:
                a = direction[f]
                mid, span = a * t, math.sqrt(max(0.0, (1 - a * a) * (1 - t * t)))
                low, high = (-1.0 if a <= -t else mid - span), (1.0 if a >= t else mid + span)
                u = unit[left, f]
                left = left[(u >= low - 1e-9) & (u <= high + 1e-9)]
            if len(left):
                scores = rows[left] @ queries[q]
                mine = c_ids[left] != q_ids[q]
                best.add(q, c_ids[left][mine], scores[mine])
        plain = alive[~by_coordinate]
        if len(plain):
            products = queries[plain] @ rows[part].T
            for q, scores in zip(plain, products, strict=True):
                # rows of the query's own id go first, so that they take no place among the best
                some = np.flatnonzero((scores >= best.bounds[q]) & (c_ids[part] != q_ids[q]))
                if len(some) > 4 * k:
                    cut = np.partition(scores[some], len(some) - k)[len(some) - k]
                    some = some[scores[some] >= cut]
                best.add(q, c_ids[part][some], scores[some])
    for q, (ids, scores) in enumerate(best.found):
        for vec, score in zip(ids.tolist(), scores.tolist(), strict=True):
            yield q, vec, score


def top_inner_products(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE
) -> DataFrame:
    """Each query's k best other vectors: query_id, rank (from 1), vec_id, score; ties to the smaller id.

    Vectors null, with a null or non-finite component, or without id take no part; shorter
    vectors count as filled with zeros.  Rows with equal ids are candidates each, but never for
    a query of that id; a repeated query id is asked once, by its smallest vector.  Scores must fit 64 bits.
    """
    rows = quantize(vectors, scale).withColumn("bucket", norm_bucket(F.col("norm")))
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    width = rows.agg(F.max(F.size("ints"))).first()[0] or 0
    # one row per bucket, and there are at most a few thousand in the range of doubles
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect()
    blocks = {row.bucket: (math.ceil(row.n / BLOCK_VECTORS), row.longest) for row in sizes}
    head = rows.orderBy(F.desc("norm"), "vec_id").limit(HEAD_VECTORS).collect()
    h_ids, h_rows = np.array([r.vec_id for r in head], np.int64), matrix([r.ints for r in head], width)

    def first_bounds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("vec_id").to_pylist(), np.int64)
            ints = matrix(batch.column("ints").to_pylist(), width)
            scores = ints @ h_rows.T
            bounds = np.full(len(ids), -np.inf)
            for q in range(len(ids)):
                others = scores[q][h_ids != ids[q]]
                if len(others) >= k:
                    bounds[q] = np.partition(others, len(others) - k)[len(others) - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bounds)], names=[*batch.schema.names, "bound"])

    # the norm belongs to the vector that is asked: a smaller one would prune true results
    smallest = F.min(F.struct("ints", "norm")).alias("smallest")
    asked = rows.filter(is_query).groupBy("vec_id").agg(smallest).select("vec_id", "smallest.*")
    asked = asked.mapInArrow(first_bounds, "vec_id long, ints array<long>, norm double, bound double")
    queries = store(asked, "queries")
    groups = max(1, math.ceil(queries.count() / QUERY_VECTORS))
    # a query goes to the blocks of the buckets that can reach its bound
    plan = F.array(*[
        F.struct(F.lit(b).alias("bucket"), F.lit(n).alias("blocks"), F.lit(longest).alias("longest"))
        for b, (n, longest) in sorted(blocks.items())
    ])
    if not blocks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    reach = F.filter(plan, lambda b: F.col("norm") * b.longest * (1 + 1e-9) >= F.col("bound"))
    visits = queries.select("*", F.explode(reach).alias("to"))
    visits = visits.select("vec_id", "ints", "norm", "bound", F.col("to.bucket").alias("bucket"),
                           F.explode(F.sequence(F.lit(0), F.col("to.blocks") - 1)).alias("block"))
    visits = visits.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    cut = F.create_map(*[F.lit(x) for b, (n, _) in sorted(blocks.items()) for x in (b, n)])
    # by row, so that the copies of a vector are dealt over all blocks of their bucket
    block = F.pmod(F.xxhash64("row"), cut[F.col("bucket")]).cast("int")
    candidates = rows.withColumn("block", block)
    candidates = candidates.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    key = ["bucket", "block", "part"]

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if q.num_rows and c.num_rows:
            q_ids, c_ids = (t.column("vec_id").to_numpy() for t in (q, c))
            q_rows, c_rows = (matrix(t.column("ints").to_pylist(), width) for t in (q, c))
            found = search_block(
                q_ids, q_rows, q.column("norm").to_numpy(), q.column("bound").to_numpy(),
                c_ids, c_rows, c.column("norm").to_numpy(), k,
            )
            for query, vec, score in found:
                out[0].append(int(q_ids[query])), out[1].append(vec), out[2].append(score)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    left = visits.select("vec_id", "ints", "norm", "bound", *key).groupBy(*key)
    right = candidates.select("vec_id", "ints", "norm", *key).groupBy(*key)
    found = left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
