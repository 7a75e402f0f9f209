"""Cleaning: duplicates, missing values, text timestamps and interquartile fences."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tradewind.functions.quantiles import Bounds, exact_quantiles, observed_bounds, quantile_values
from tradewind.functions.shaping import ROW_ORDER, keep_first, materialize, unpivot_row
from tradewind.schemas import ORDER_DATES, PRODUCT_MEASURES, REVIEW_DATES

FENCE_WIDTH = 1.5


def null_summary(df: DataFrame) -> DataFrame:
    """Columns with missing cells: how many, and as a percentage of all rows."""
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    fields = {
        c: {"null_count": F.col(c), "null_pct": F.col(c) * 100.0 / F.nullif(F.col("rows"), F.lit(0))}
        for c in df.columns
    }
    return unpivot_row(counts, fields, "column_name").filter("null_count > 0")


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """The first row per key; NULL keys count as equal."""
    return keep_first(df, keys, order_by)


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Drop identical rows (the place in the file is not part of a row)."""
    return df.drop(ROW_ORDER).distinct()


def fill_constant(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Replace NULLs per column by a constant."""
    return df.fillna(dict(values))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the column's exact median; an all-NULL column stays as it is.

    The columns become doubles, since the median of integers may be a half.
    """
    medians = quantile_values(df, {c: [0.5] for c in columns})
    known = {c: value for c, (value,) in medians.items() if value is not None}
    return df.withColumns({c: F.col(c).cast("double") for c in known}).fillna(known) if known else df


def coerce_timestamp(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to zone-less timestamps; unreadable text becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in columns if c in df.columns})


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of the columns."""
    return df.dropna(subset=list(columns))


def positive_only(df: DataFrame, column: str) -> DataFrame:
    """Keep rows with a value above zero; NULL is dropped too."""
    return df.filter(F.col(column) > 0)


def iqr_fence_table(df: DataFrame, columns: Sequence[str], bounds: Bounds | None = None) -> DataFrame:
    """Quartiles and fences per column, as rows; ``bounds`` of the values, if known, save a pass."""
    q1 = F.max(F.when(F.col("probability") == 0.25, F.col("value")))
    q3 = F.max(F.when(F.col("probability") == 0.75, F.col("value")))
    quartiles = (
        exact_quantiles(df, {c: [0.25, 0.75] for c in columns}, bounds=bounds)
        .groupBy(F.col("column").alias("column_name"))
        .agg(q1.alias("q1"), q3.alias("q3"))
    )
    reach = (F.col("q3") - F.col("q1")) * FENCE_WIDTH
    return quartiles.withColumns({"lower_fence": F.col("q1") - reach, "upper_fence": F.col("q3") + reach})


def iqr_fences(df: DataFrame, column: str, bounds: Bounds | None = None) -> tuple[float, float] | None:
    """Lower and upper fence of a column as numbers, or None when it has no values."""
    row = iqr_fence_table(df, [column], bounds).first()
    return None if row is None else (row["lower_fence"], row["upper_fence"])


def iqr_filter(df: DataFrame, column: str) -> DataFrame:
    """Keep rows inside the fences, ends included; NULL is dropped.

    The fences are two numbers, so the filter reaches the Parquet scan as literals.
    """
    return inside(df, column, iqr_fences(df, column))


def inside(df: DataFrame, column: str, fences: tuple[float, float] | None) -> DataFrame:
    """Rows between two fences, ends included; none where there are no fences."""
    return df.filter(F.lit(False)) if fences is None else df.filter(F.col(column).between(*fences))


def iqr_filter_chain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fence one column after the other, each computed on the rows that survived so far."""
    return reduce(iqr_filter, columns, df)


#: Called with the name of a step and its rows; returns the rows to go on with.  The first step is "rows".
Seen = Callable[[str, DataFrame], DataFrame]


def _unseen(step: str, df: DataFrame) -> DataFrame:
    return df


def clean_customers(customers: DataFrame, seen: Seen = _unseen) -> DataFrame:
    """One row per customer_id; missing city and state become 'Unknown'."""
    unique = seen("duplicates", dedup_by_key(seen("rows", customers), ["customer_id"])).drop(ROW_ORDER)
    return fill_constant(unique, {"customer_city": "Unknown", "customer_state": "Unknown"})


def clean_orders(orders: DataFrame, seen: Seen = _unseen) -> DataFrame:
    """Timestamps read, one row per order_id, purchase time required."""
    dated = coerce_timestamp(seen("rows", orders), ORDER_DATES)
    unique = seen("duplicates", dedup_by_key(dated, ["order_id"])).drop(ROW_ORDER)
    return seen("no purchase time", require_not_null(unique, ["order_purchase_timestamp"]))


def clean_order_items(items: DataFrame, seen: Seen = _unseen) -> DataFrame:
    """Identical rows dropped, then price and freight outliers.

    The distinct rows are written out once because the two fences read them several
    times, each time only one or two narrow columns.  The job that writes them takes the bounds of both columns.
    """
    unique, observed = observed_bounds(seen("duplicates", dedup_full_row(seen("rows", items))), ["price", "freight_value"])
    unique = materialize(unique, "distinct-items")
    bounds = None if unique.isEmpty() else observed()
    price = iqr_fences(unique, "price", bounds)
    freight = iqr_fences(inside(unique, "price", price), "freight_value", bounds)
    fair = seen("price outliers", inside(unique, "price", price))
    return seen("freight outliers", inside(fair, "freight_value", freight))


def clean_reviews(reviews: DataFrame, seen: Seen = _unseen) -> DataFrame:
    """Missing comments become '', timestamps read, one row per (review_id, order_id)."""
    filled = fill_constant(seen("rows", reviews), {"review_comment_title": "", "review_comment_message": ""})
    unique = dedup_by_key(coerce_timestamp(filled, REVIEW_DATES), ["review_id", "order_id"])
    return seen("duplicates", unique).drop(ROW_ORDER)


def clean_products(products: DataFrame, seen: Seen = _unseen) -> DataFrame:
    """Missing category becomes 'unknown', missing measures the median over all rows
    (duplicates included), then one row per product_id.

    The rows are written out once because the medians read them several times.
    """
    filled = materialize(fill_constant(seen("rows", products), {"product_category_name": "unknown"}), "products")
    measures = [c for c in PRODUCT_MEASURES if c in products.columns]
    return seen("duplicates", dedup_by_key(fill_median(filled, measures), ["product_id"])).drop(ROW_ORDER)


def clean_payments(payments: DataFrame, seen: Seen = _unseen) -> DataFrame:
    """Payments above zero, identical rows dropped."""
    paid = seen("zero or negative", positive_only(seen("rows", payments), "payment_value"))
    return seen("duplicates", dedup_full_row(paid))


CLEANERS = {
    "customers": clean_customers,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "order_reviews": clean_reviews,
    "products": clean_products,
    "order_payments": clean_payments,
}


class StepCounts:
    """Row counts of the steps of one table, taken in flight by the job that writes it."""

    def __init__(self, table: str):
        self.table, self.steps = table, []

    def seen(self, step: str, df: DataFrame) -> DataFrame:
        observation = Observation(f"{self.table} {step}")
        self.steps.append((step, observation))
        return df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> list[tuple[str, str, int, int]]:
        """(table, step, rows before, rows after), once the job is done."""
        counts = [(step, observation.get["rows"]) for step, observation in self.steps]
        return [(self.table, step, before, after) for (_, before), (step, after) in itertools.pairwise(counts)]


def _write(name: str, df: DataFrame) -> DataFrame:
    return materialize(df, f"clean-{name}")


def clean_tables(
    raw: Mapping[str, DataFrame], attempts: int = 3, write: Callable[[str, DataFrame], DataFrame] = _write
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every known table cleaned and written, and the report of rows before and after each step that removes rows.

    ``write`` stores the rows of a table in place of earlier ones, and returns what it has stored.

    One chain of steps per table, so each raw table is read once; the counts are observed on the way.  A stage that
    runs again after a lost executor may be counted twice, so the last count must equal the written rows, else
    the chain runs again.
    """
    cleaned, report = {}, []
    for name in [n for n in CLEANERS if n in raw]:
        for _ in range(attempts):
            counts = StepCounts(name)
            cleaned[name] = write(name, CLEANERS[name](raw[name], counts.seen))
            rows = counts.rows()
            if rows[-1][3] == cleaned[name].count() and all(before >= after for *_, before, after in rows):
                break
        else:
            raise RuntimeError(f"the steps of {name} could not be counted: stages ran again in {attempts} attempts")
        report += [(*row, row[2] - row[3]) for row in rows]
    spark = next(iter(raw.values())).sparkSession
    columns = "table_name string, step string, rows_before bigint, rows_after bigint, rows_removed bigint"
    return cleaned, spark.createDataFrame(report, columns)


def clean_report(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after each cleaning step that removes rows."""
    return clean_tables(raw)[1]


def clean_summary(cleaned: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and remaining missing cells per cleaned table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])
        return df.agg(
            F.count("*").alias("row_count"), F.coalesce(F.sum(missing), F.lit(0)).alias("remaining_nulls")
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in cleaned.items()])
