"""Records of CSV files with line breaks in quoted text, read by many tasks per file.

Whether a line begins a record depends on the quotes of all lines before it, so a plain reader gives such a file to one task.  Here
the files are read as lines, in blocks of bytes.  A first scan counts the quotes of each block; the sum over the
blocks before it tells whether a block begins within quotes.  A second scan knows this and finds the lines that begin
records.  Lines that are whole records pass at once; only lines of longer records meet, by the place of the record's first line,
which may lie in a block before.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
LINES = "value string, file string, block long, line long, quotes long, within boolean, start_outside long, start_within long"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place (file, block, line) and, for a block that begins outside or within quotes, the line where
    the record of each line begins; -1 if that is in a block before.  ``within`` holds for a block that begins outside.
    """

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, line, quotes, starts = None, 0, 0, [-1, -1]
        for batch in batches:
            files, blocks = batch.column("file"), batch.column("block").to_numpy()
            # a task reads its blocks one after the other
            changed = np.flatnonzero((blocks[1:] != blocks[:-1]) | (pc.not_equal(files[1:], files[:-1])).to_numpy(zero_copy_only=False)) + 1
            for a, b in zip([0, *changed.tolist()], [*changed.tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                if not part.num_rows:
                    continue
                place = (part.column("file")[0].as_py(), int(blocks[a]))
                if place != at:
                    at, line, quotes, starts = place, 0, 0, [-1, -1]
                own = pc.count_substring(part.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
                before = quotes + np.cumsum(own) - own
                lines = line + np.arange(b - a)
                found = [np.maximum.accumulate(np.maximum(np.where(before % 2 == side, lines, -1), starts[side])) for side in (0, 1)]
                line, quotes, starts = line + b - a, int(before[-1] + own[-1]), [int(f[-1]) for f in found]
                new = [pa.array(lines), pa.array(own), pa.array(before % 2 == 1), *map(pa.array, found)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    names = [c.split()[0] for c in LINES.split(", ")]
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).mapInArrow(number, LINES)


def block_starts(lines: DataFrame) -> DataFrame:
    """(file, block, flipped, carry): whether a block begins within quotes, and the first line of the record it begins in."""
    blocks = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.max("start_outside").alias("outside"), F.max("start_within").alias("inside")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("flipped", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    last = F.when(F.col("flipped"), F.col("inside")).otherwise(F.col("outside"))
    blocks = blocks.withColumn("last", F.when(last >= 0, F.struct("block", last.alias("line"))))
    return blocks.select("file", "block", "flipped", F.last("last", ignorenulls=True).over(before).alias("carry"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, record) of all records, headers included; empty lines between records are left out.

    A quote that is never closed makes the rest of its file one record, as for any reader.
    """
    lines = numbered_lines(spark, path)
    starts = block_starts(lines).withColumn("known", F.lit(True))
    lines = lines.join(starts, ["file", "block"], "left")
    same = F.when(F.col("known"), True).otherwise(F.raise_error(F.lit("the files were cut into other blocks by the second scan")))
    start = F.when(F.col("flipped"), F.col("start_within")).otherwise(F.col("start_outside"))
    owner = F.when(start >= 0, F.struct("block", start.alias("line"))).otherwise(F.col("carry"))
    inside = F.col("within") != F.col("flipped")
    lines = lines.filter(same).withColumn("owner", owner).withColumn("whole", ~inside & (F.col("quotes") % 2 == 0))
    whole = lines.filter("whole").select("file", "block", "line", F.col("value").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    longer = lines.filter("NOT whole").groupBy("file", "owner.block", "owner.line").agg(parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    longer = longer.select("file", "block", "line", text.alias("record"))
    records = whole.unionByName(longer).withColumn("record", F.regexp_replace("record", "\\r$", ""))
    return records.filter("record <> ''")


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, columns by the header, and ``_place`` (file, block, line) of each record.

    The same rows as the ``multiLine`` reader.  Every file has the header of the first one, else reading fails.
    """
    names = spark.read.options(**OPTIONS).option("header", True).csv(path).columns
    schema = ", ".join(f"`c{k}` string" for k in range(len(names)))
    cells = F.from_csv("record", schema, OPTIONS)
    rows = csv_records(spark, path).withColumn("cells", cells)
    header = (F.col("block") == 0) & (F.col("line") == 0)
    found = F.array(*[F.col(f"cells.c{k}") for k in range(len(names))])
    agrees = F.when(found == F.array(*map(F.lit, names)), False).otherwise(F.raise_error(F.concat(F.lit("other header in "), F.col("file"))))
    rows = rows.filter(F.when(header, agrees).otherwise(True))
    columns: list[Column] = [F.col(f"cells.c{k}").alias(n) for k, n in enumerate(names)]
    return rows.select(*columns, F.struct("file", "block", "line").alias("_place"))
