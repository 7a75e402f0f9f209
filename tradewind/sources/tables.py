"""Reading, writing and describing whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructType

from tradewind.functions.shaping import ROW_ORDER, unpivot_row
from tradewind.schemas import FREE_TEXT_TABLES, RAW_SCHEMAS
from tradewind.sources.quoted_csv import read_quoted_csv


# Cell texts that the usual CSV readers take as missing.
MISSING = ["NA", "N/A", "n/a", "NaN", "nan", "-NaN", "-nan", "null", "NULL", "None", "<NA>", "#N/A", "#NA", "1.#IND",
           "1.#QNAN", "-1.#IND", "-1.#QNAN", "#N/A N/A"]


def _typed(name: str, kind: DataType) -> Column:
    """Text to a type; unreadable text becomes NULL, and '5.0' is read as the integer 5.

    The marks for missing cells are NULL in every column.
    """
    cell = F.when(~F.col(name).isin(MISSING), F.col(name))
    if isinstance(kind, StringType):
        return cell.alias(name)
    if isinstance(kind, IntegralType):
        return F.coalesce(cell.try_cast(kind), cell.try_cast("double").try_cast(kind)).alias(name)
    return cell.try_cast(kind).alias(name)


def load_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    row_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """A headered CSV file or folder; columns are found by name and typed by the schema.

    Columns the schema does not know stay text.  ``multi_line`` accepts line breaks in
    quoted text; such a file is split over tasks too (``quoted_csv``).  With
    ``row_order`` each row remembers its place in the files, for "first row" rules.
    """
    if multi_line:
        lines = read_quoted_csv(spark, path)
        place = F.struct("_place.file", "_place.block", F.col("_place.line").alias("row"))
    else:
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
        # headers of further files must agree with the first instead of being skipped
        lines = reader.option("enforceSchema", False).csv(path)
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    kinds = {f.name: f.dataType for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema)}
    cells = [_typed(c, kinds[c]) if c in kinds else F.col(c) for c in lines.columns if not (multi_line and c == "_place")]
    if row_order:
        cells.append(place.alias(ROW_ORDER))
    return lines.select(*cells)


def load_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, StructType | str] = RAW_SCHEMAS,
    row_order: bool = False,
) -> tuple[dict[str, DataFrame], list[str]]:
    """Load every CSV table in ``paths``; also returns the names that were not found.

    A missing file is reported and skipped, the others still load.
    """
    tables, missing = {}, []
    for name, path in paths.items():
        try:
            tables[name] = load_csv(spark, path, schemas[name], row_order, name in FREE_TEXT_TABLES)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    return tables, missing


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(path)


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``, which the rows may come from.

    The new rows are written in full beside the old ones and then take their place by renaming, so a job that
    fails leaves the old table as it was.  Partitioned output is first rebalanced by the partition columns,
    which splits a hot partition over several files instead of one task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    spark, path = df.sparkSession, path.rstrip("/")
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fresh, old = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    try:
        df.write.partitionBy(*partition_by).parquet(fresh)
    except Exception:
        files.delete(at(fresh), True)
        raise
    if files.exists(at(path)) and not files.rename(at(path), at(old)):
        raise OSError(f"{path} could not be replaced; the new rows are in {fresh}")
    if not files.rename(at(fresh), at(path)):
        files.rename(at(old), at(path))
        raise OSError(f"{path} could not be replaced; the new rows are in {fresh}")
    files.delete(at(old), True)
    spark.catalog.refreshByPath(path)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, row count and column count per table, sorted by name."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).orderBy("table_name")


def schema_info(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Data type and number of non-NULL cells per column; one pass per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
        fields = {c: {"data_type": F.lit(t), "non_null_count": F.col(c)} for c, t in df.dtypes}
        return unpivot_row(counts, fields, "column_name").select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])
