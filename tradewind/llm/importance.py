"""Importance resampling of documents towards a target.

Two generative models over hashed n-grams (words and pairs of neighbouring words): one of
the target texts, one of all texts.  A document's log weight is the sum over its n-grams of
the logarithm of the ratio of both.  Adding seeded Gumbel noise and keeping the highest
keys samples documents without replacement in proportion to their weights.  The counts of both
models are sums over all documents, made by tasks and added up per bucket.

Which documents are targets is settled by ids alone and kept as bits per cell of hashed ids, so
texts stay where they are read; only those whose cell holds ids of both kinds meet the ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import hash_cache, mix, store, table_batches, word_hashes, words_of

BUCKETS = 10_000
SMOOTHING = 1.0
#: Cells of hashed ids: so many a row, and in all; two bits a cell reach every executor, 32 MB at most.
CELLS_PER_ROW = 16
MOST_CELLS = 2**27


def ngram_buckets(text: str | None, cache, buckets: int) -> np.ndarray:
    """Bucket numbers of a text's words and word pairs."""
    words = word_hashes(words_of(text), cache)
    pairs = mix(words[:-1], words[1:])
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64)


def cells_of_targets(docs: DataFrame, ids: DataFrame, cells: int) -> DataFrame:
    """Bitmaps (block, targets, others) of the cells that hold ids of target rows and of other rows; null ids are in none."""
    known = docs.select("doc_id").filter("doc_id IS NOT NULL").join(ids, F.col("doc_id") == F.col("target_id"), "left")
    cell, is_target = F.pmod(F.xxhash64("doc_id"), F.lit(cells)), F.col("target_id").isNotNull()
    bits = known.select(
        F.bitmap_bucket_number(cell).alias("block"),
        F.when(is_target, F.bitmap_bit_position(cell)).alias("target"),
        F.when(~is_target, F.bitmap_bit_position(cell)).alias("other"),
    )
    # dealt by block first: a bitmap is made once, not in every task that has rows for it
    return bits.repartition("block").groupBy("block").agg(
        F.bitmap_construct_agg("target").alias("targets"), F.bitmap_construct_agg("other").alias("others")
    )


def marked_texts(docs: DataFrame, target_ids: DataFrame, cells: int | None = None) -> DataFrame:
    """text and is_target of every row.

    A cell with ids of one kind settles its rows where they are read; rows of cells with both kinds, about
    one in thirty with the usual number of cells, are joined to the ids, so more rows a cell cost only more shuffle.
    """
    ids = target_ids.select(F.col("doc_id").cast("long").alias("target_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cells = cells or min(MOST_CELLS, CELLS_PER_ROW * max(1, rows.count()))
    bitmaps = F.broadcast(store(cells_of_targets(rows, ids, cells), "target-cells"))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells))
    at = F.bitmap_bit_position(cell).cast("int")

    def has(bitmap: str) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.getbit(byte, at.bitwiseAND(7)) == 1, F.lit(False))

    placed = rows.withColumn("block", F.bitmap_bucket_number(cell)).join(bitmaps, "block", "left")
    placed = placed.select("doc_id", "text", has("targets").alias("target"), has("others").alias("other"))
    settled = placed.filter("NOT (target AND other)").select("text", F.col("target").alias("is_target"))
    unsettled = placed.filter("target AND other").join(ids, F.col("doc_id") == F.col("target_id"), "left")
    return settled.unionByName(unsettled.select("text", F.col("target_id").isNotNull().alias("is_target")))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Counts (bucket, raw, target) over all rows of (text, is_target)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, sums = hash_cache(), np.zeros((2, buckets), np.int64)
        for rows in table_batches(batches):
            for text, target in zip(rows["text"], rows["is_target"], strict=True):
                found = np.bincount(ngram_buckets(text, cache, buckets), minlength=buckets)
                sums[0] += found
                if target:
                    sums[1] += found
        seen = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(sums[0][seen]), pa.array(sums[1][seen])], names=["bucket", "raw", "target"]
        )

    parts = docs.select("text", "is_target").mapInArrow(count, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Logarithm of target over raw probability per bucket, smoothed; a fixed number of values."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in counts.collect():
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not target.sum():
        return np.zeros(buckets)
    p = (target + smoothing) / (target.sum() + smoothing * buckets)
    q = (raw + smoothing) / (raw.sum() + smoothing * buckets)
    return np.log(p) - np.log(q)


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, of_text (hash of the text), n_ngrams and log_weight of every row; a text without words weighs 0."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = hash_cache()
        for rows in table_batches(batches):
            found = [ngram_buckets(text, cache, len(ratios)) for text in rows["text"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["of_text"], pa.int64()), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([float(ratios[f].sum()) for f in found], pa.float64())],
                names=["doc_id", "of_text", "n_ngrams", "log_weight"],
            )

    schema = "doc_id long, of_text long, n_ngrams long, log_weight double"
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("of_text"), "text").mapInArrow(score, schema)


def gumbel(doc_id: Column, of_text: Column, seed: int) -> Column:
    """Seeded Gumbel noise; the same for rows equal in id and text, ids may be null or repeat."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), doc_id, of_text), 11)
    uniform = (bits.cast("double") + 0.5) / F.lit(float(2**53))
    return -F.log(-F.log(uniform))


def least_of_top(rows: DataFrame, key: str, k: int, cells: int = 1024) -> tuple[float, int]:
    """The k-th highest key and how many rows lie above it, for 0 < k <= number of rows.

    Found by counting rows per cell of a narrowing range, a fixed number of counts per round, so
    neither a sort nor one task sees all rows.  A range ends at values that occur, so it shrinks to one value.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    above = 0  # rows with a key over ``high``
    while low < high:
        width = (float(high) - float(low)) / cells
        cell = F.least(F.floor((F.col(key) - F.lit(low)).cast("double") / width), F.lit(cells - 1))
        inside = rows.filter(F.col(key).between(low, high)).groupBy(cell.alias("cell"))
        found = inside.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()
        for row in sorted(found, key=lambda r: -r.cell):
            if above + row.n >= k:
                low, high = row.low, row.high
                break
            above += row.n
        if above + 1 == k:  # the highest of the range
            low = high
    return low, above


def top_k(rows: DataFrame, key: str, k: int, tie: str) -> DataFrame:
    """Mark exactly k rows (all, if fewer) with the highest key; among equal keys those with the highest ``tie``, unique integers."""
    total = rows.count()
    if k >= total or k <= 0:
        return rows.withColumn("selected", F.lit(k > 0))
    bound, above = least_of_top(rows, key, k)
    ties = rows.filter(F.col(key) == F.lit(bound))
    last = least_of_top(ties, tie, k - above)[0]
    return rows.withColumn("selected", (F.col(key) > F.lit(bound)) | ((F.col(key) == F.lit(bound)) & (F.col(tie) >= F.lit(last))))


def resample(
    docs: DataFrame, target_ids: DataFrame, share: float, buckets: int = BUCKETS, seed: int = 11
) -> DataFrame:
    """Sample ``share`` of the documents towards those in ``target_ids``.

    Rows: doc_id, n_ngrams, log_weight, sample_key, selected.  A null or empty text weighs 0.
    Exactly the rounded share of all rows is selected; of rows equal in id and text any may be.
    Without target texts all weights are 0 and the sample is uniform.
    """
    counts = bucket_counts(marked_texts(docs, target_ids), buckets)
    weights = log_weights(docs, log_ratios(counts, buckets))
    noise = gumbel(F.col("doc_id"), F.col("of_text"), seed)
    keyed = weights.withColumn("sample_key", F.col("log_weight") + noise).drop("of_text")
    keyed = store(keyed.withColumn("row", F.monotonically_increasing_id()), "sample-keys")
    return top_k(keyed, "sample_key", round(share * keyed.count()), "row").drop("row")


def labelled_share(labels: DataFrame) -> float:
    """Share of good rows (quality 1, not toxic) among the labelled ones; 1 without labels."""
    good, total = labels.agg(F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)), F.count(F.lit(1))).first()
    return good / total if total else 1.0
