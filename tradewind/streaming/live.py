"""Headline numbers kept up to date while rows arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tradewind.functions.days import floor_days
from tradewind.sources.versions import current, publish

KPI_FEED = "is_order boolean, price double, review_score bigint, delivery_days bigint"


def read_arriving(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream over Parquet files that arrive under ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def kpi_feed(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Arriving orders, items and reviews as one feed of rows with the cells the KPIs need."""
    delivered = F.col("order_delivered_customer_date")
    days = floor_days(delivered, F.col("order_purchase_timestamp"))
    none = {f.name: F.lit(None).cast(f.dataType) for f in StructType.fromDDL(KPI_FEED)}

    def feed(df: DataFrame, is_order: bool, **cells) -> DataFrame:
        row = {**none, **cells, "is_order": F.lit(is_order)}
        return df.select(*[row[f.name].cast(f.dataType).alias(f.name) for f in StructType.fromDDL(KPI_FEED)])

    return (
        feed(orders, True, delivery_days=days)
        .unionByName(feed(items, False, price=F.col("price")))
        .unionByName(feed(reviews, False, review_score=F.col("review_score")))
    )


def live_kpis(feed: DataFrame) -> DataFrame:
    """Running orders, revenue, average rating and average delivery days (one row)."""
    return feed.groupBy().agg(
        F.count_if("is_order").alias("total_orders"),
        F.sum("price").alias("total_revenue"),
        F.avg("review_score").alias("avg_rating"),
        F.avg("delivery_days").alias("avg_delivery_days"),
    )


def order_arrivals(orders: DataFrame, delay: str = "14 days") -> DataFrame:
    """Every arriving row (``accepted`` false) and, beside it, the first row of each id within the watermark (true).

    The state holds the ids of the last ``delay`` of purchase time and no more.  Rows behind the watermark are
    not accepted; ``keep_order_volume`` finds them among the arriving ones.
    """
    arriving = orders.select("order_id", F.col("order_purchase_timestamp").cast("timestamp").alias("purchased_at"))
    arriving = arriving.filter(F.col("purchased_at").isNotNull())
    first = arriving.withWatermark("purchased_at", delay).dropDuplicatesWithinWatermark(["order_id"])
    return arriving.withColumn("accepted", F.lit(False)).unionByName(first.withColumn("accepted", F.lit(True)))


def in_window(window: str) -> Column:
    return F.window("purchased_at", window)["start"]


def keep_order_volume(
    orders: DataFrame, path: str, checkpoint: str, window: str = "7 days", delay: str = "14 days"
) -> StreamingQuery:
    """Process what has arrived: orders per purchase-time window, each id once, with bounded state.

    Every batch appends, in folders of its own number, the accepted ids by window (``ids``), its counts
    (``counts``), the rows behind the watermark (``late``) and the latest purchase time (``progress``).  A batch that is run again
    replaces its own folders; one without rows writes none.  ``merge_late_orders`` adds the late rows to their windows; ``order_volume``
    gives the counts.  A repeated delivery must carry the same purchase time.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("window_start", in_window(window)).persist()
        if not batch.count():  # only moves the watermark; the count has run all tasks, so the state is kept
            batch.unpersist()
            return
        seen = parts(spark, path, "progress", "latest timestamp")
        latest = seen.filter(F.col("batch") < number).agg(F.max("latest")).first()[0]
        accepted, arrived = batch.filter("accepted"), batch.filter("NOT accepted")

        def put(rows: DataFrame, name: str, *by: str) -> None:
            rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}/batch={number}")

        # a file per window, not one per window and task of the state; ranges split a window that holds most rows
        ids = accepted.select("order_id", "window_start").repartitionByRange("window_start", "order_id")
        put(ids, "ids", "window_start")
        # one file; with coalesce a single task would hold the sums of all partitions
        put(accepted.groupBy("window_start").agg(F.count(F.lit(1)).alias("orders")).repartition(1), "counts")
        if latest is not None:
            # the watermark has whole milliseconds; a row too many is only a repeated id, which the merge drops
            bound = F.lit(latest) - F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 MILLISECOND")
            behind = arrived.filter(F.col("purchased_at") <= bound).join(accepted.select("order_id"), "order_id", "left_anti")
            put(behind.select("order_id", "window_start").distinct(), "late")
        put(arrived.agg(F.max("purchased_at").alias("latest")).filter("latest IS NOT NULL"), "progress")
        batch.unpersist()

    return (
        order_arrivals(orders, delay).writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def parts(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A folder of batches; without rows while no batch has written it."""
    full = f"{schema}, batch long"
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")


def merge_late_orders(spark: SparkSession, path: str) -> int:
    """Add late rows not merged so far to their windows; returns how many new orders they were.

    Reads the accepted ids of the touched windows only.  The merge is a batch of its own with a negative number, and
    what it took is named by ``merged``, which is written last: a merge that broke off is done again under the same number.
    """
    done = parts(spark, path, "merged", "of_batch long")
    taken, number = done.agg(F.max("of_batch"), F.coalesce(F.min("batch"), F.lit(0)) - 1).first()
    late = parts(spark, path, "late", "order_id long, window_start timestamp")
    late = late.filter(F.col("batch") > F.lit(-1 if taken is None else taken))
    last = late.agg(F.max("batch")).first()[0]
    if last is None:
        return 0
    ids = parts(spark, path, "ids", "order_id long, window_start timestamp").filter(F.col("batch") != number)
    fresh = late.select("order_id", "window_start").dropDuplicates(["order_id"])
    touched = fresh.select("window_start").distinct()
    held = ids.join(touched, "window_start", "left_semi").select("order_id")
    fresh = fresh.join(held, "order_id", "left_anti")
    fresh.write.mode("overwrite").partitionBy("window_start").parquet(f"{path}/ids/batch={number}")
    added = parts(spark, path, "ids", "order_id long, window_start timestamp").filter(F.col("batch") == number)
    counts = added.groupBy("window_start").agg(F.count(F.lit(1)).alias("orders"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")
    spark.createDataFrame([(last,)], "of_batch long").coalesce(1).write.mode("overwrite").parquet(f"{path}/merged/batch={number}")
    return added.count()


def order_volume(spark: SparkSession, path: str, window: str = "7 days") -> DataFrame:
    """Orders per window from what the batches and merges have counted: window_start, window_end, orders."""
    counts = parts(spark, path, "counts", "window_start timestamp, orders long")
    total = counts.groupBy("window_start").agg(F.sum("orders").alias("orders"))
    return total.select("window_start", (F.col("window_start") + F.expr(f"INTERVAL {window}")).alias("window_end"), "orders")


def keep_snapshot(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived; every batch publishes the full result as a new version and drops old ones.

    Readers use ``snapshot``.  A batch that is run again replaces its own version only, so
    a complete one is there at any time.
    """

    def write(batch: DataFrame, number: int) -> None:
        publish(batch.coalesce(1), path, number)  # a small table: one file

    return (
        result.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete result of ``keep_snapshot``."""
    return current(spark, path)
