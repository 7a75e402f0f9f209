"""What several operators share: words, cached word hashes, shared intermediates, batches."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tradewind.session import workspace

#: A word is a run of characters other than space, tab, line ends and form feed.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)
CACHE_ENTRIES = 300_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


class Cache(dict):
    """Values per key, computed once per task process; emptied when full, so memory is bounded."""

    def __init__(self, compute: Callable, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.entries = compute, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def word_hashes(words: list[str], cache: Cache) -> np.ndarray:
    """64-bit hashes of the words, in order."""
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def hash_cache() -> Cache:
    return Cache(xxhash.xxh3_64_intdigest)


def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Combine two arrays of 64-bit hashes; the order of the two matters."""
    with np.errstate(over="ignore"):
        x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(b) if np.isscalar(b) else (
            (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
        )
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(31))


def table_batches(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[dict[str, list]]:
    """Arrow batches as dicts of Python lists, a bounded number of rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).to_pydict()


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and survives lost executors.

    Shuffle files of the finished job are dropped with the garbage of the driver, which
    is collected here so that disk does not hold the files of every finished phase.
    """
    spark = df.sparkSession
    path, schema = workspace(spark, purpose), df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    stored = spark.read.schema(schema).parquet(path)
    stored.stored_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete intermediates of ``store`` that nothing reads any more."""
    for df in stored:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
