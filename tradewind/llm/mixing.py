"""Mixing sources to target weights by capped water-filling.

Sources in code-point order (null last) weigh the given cycle.  Together their targets
make up the size of all sources; no target exceeds ``max_epochs`` times its source's
size.  Sources above that are clamped and their excess goes to the others in proportion to
weight, until none is above.  A source's target over its size is its number of epochs:
every document is taken the whole part of it, and the fraction once more for
documents chosen by a seeded hash.

DataFrame functions only.  Sizes are summed per source on the map side; the choice for the
fraction is made in hash buckets of a bounded number of documents, so that a source
with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import WORD_PATTERN, store

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_DOCS = 4096


def size_of(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw_of(docs: DataFrame, seed: int) -> Column:
    """The seeded hash that orders documents: by id and text, as ids may be null or repeat; rows equal in both share it."""
    return F.xxhash64(F.lit(seed).cast("long"), docs["doc_id"].cast("long"), docs["text"])


def cycle(rank: Column, weights: Sequence[int]) -> Column:
    """Weight of the source with the given rank (from 1)."""
    position = (rank - 1) % len(weights)
    return reduce(lambda rest, k: F.when(position == k, F.lit(weights[k])).otherwise(rest), range(len(weights)), F.lit(None)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Add weight and target to one row per source (source, source_size).

    One row per round reaches the driver: what is left to share and the weight that shares it.
    Integers keep the rounds exact.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = store(sources.withColumn("weight", cycle(F.row_number().over(order), weights)), "mix-sources")
    cap = F.col("source_size") * max_epochs
    left, share = ranked.agg(F.sum("source_size"), F.sum("weight")).first() or (0, 0)
    total, clamped = left or 0, None
    while True:
        # above its cap: left * weight / share > cap
        above = F.lit(left or 0).cast("decimal(38,0)") * F.col("weight") > cap * F.lit(share or 0)
        now, rest = ranked.filter(above).agg(F.count(F.lit(1)), F.sum(cap)).first()
        if now == clamped or now == 0:
            break
        clamped = now
        left = total - rest
        share = ranked.filter(~above).agg(F.sum("weight")).first()[0]
        if not share:
            break
    target = F.when(above, cap.cast("double")).otherwise(
        F.lit(float(left or 0)) * F.col("weight") / F.lit(float(share or 1))
    )
    return ranked.withColumn("target", F.coalesce(target, F.lit(0.0)))


def mixing_plan(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> tuple[DataFrame, DataFrame]:
    """For rows (source, draw, size): targets per source, and cuts per (source, bucket).

    Within a bucket the documents taken once more are those whose draw is at most the cut.
    They add up to the wanted fraction of the bucket, to half a document.
    """
    per_draw = sized.groupBy("source", "draw").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    sources = per_draw.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("docs").alias("docs"))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = store(
        source_targets(sources, weights, max_epochs)
        .withColumn("whole", F.floor(epochs))
        .withColumn("fraction", epochs - F.floor(epochs))
        .withColumn("buckets", F.ceil(F.col("docs") / BUCKET_DOCS)),
        "mix-targets",
    )
    open_sources = targets.filter("fraction > 0").select(F.col("source").alias("s"), "fraction", "buckets")
    in_bucket = per_draw.join(open_sources, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "bucket", F.pmod("draw", "buckets")
    )
    group = Window.partitionBy("source", "bucket")
    before = F.sum("size").over(group.orderBy("draw")) - F.col("size")
    wanted = F.col("fraction") * F.sum("size").over(group)
    chosen = in_bucket.withColumn("chosen", before + F.col("size") / 2 < wanted)
    cuts = chosen.filter("chosen").groupBy("source", "bucket").agg(F.max("draw").alias("cut"))
    return targets, cuts


def apply_plan(rows: DataFrame, targets: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add source_size, target and ``times`` (how often the mix takes the row) to rows with source and draw."""
    t = targets.select(
        F.col("source").alias("t_source"), "source_size", "target", "whole",
        F.pmod(F.lit(0), "buckets").alias("_"), "buckets",
    ).drop("_")
    c = cuts.select(F.col("source").alias("c_source"), F.col("bucket").alias("c_bucket"), "cut")
    bucket = F.pmod("draw", "buckets")
    joined = rows.join(t, F.col("source").eqNullSafe(F.col("t_source")), "left").join(
        c, F.col("source").eqNullSafe(F.col("c_source")) & (bucket == F.col("c_bucket")), "left"
    )
    extra = F.coalesce((F.col("draw") <= F.col("cut")).cast("long"), F.lit(0))
    return joined.withColumn("times", F.col("whole") + extra).drop(
        "t_source", "c_source", "c_bucket", "cut", "whole", "buckets"
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 20
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted).

    A null text has size 0, null sources form one source, rows equal in id and text are taken
    alike, and an empty table gives no rows.  Only doc_id, source and text are read.
    """
    sized = store(
        docs.select(
            F.col("doc_id").cast("long"), "source", size_of(F.col("text")).alias("size"),
            draw_of(docs, seed).alias("draw"),
        ),
        "mix-sizes",
    )
    targets, cuts = mixing_plan(sized, weights, max_epochs)
    mixed = apply_plan(sized, targets, cuts)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 20
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    names = docs.columns
    sized = docs.select("source", draw_of(docs, seed).alias("draw"), size_of(F.col("text")).alias("size"))
    targets, cuts = mixing_plan(store(sized, "mix-sizes"), weights, max_epochs)
    rows = docs.select("source", draw_of(docs, seed).alias("draw"), F.struct(*[docs[n] for n in names]).alias("row"))
    mixed = apply_plan(rows, targets, cuts).filter("times > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return mixed.select("row", copies.alias("copy")).select(*[F.col("row")[n].alias(n) for n in names])
