"""Small tables that are replaced at once: each write is a folder of its own, and a list of files names the current one.

A version is written in full before its number is published by a rename, which either happens or does not.  A reader
opens the highest published number, so during a rewrite it sees the old rows or the new ones.  Versions
superseded long enough are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    """(file system, function from names to its paths)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, lambda *names: hadoop.Path("/".join([path, *names]))


def published(spark: SparkSession, path: str) -> dict[int, str]:
    """Folder of each published version."""
    system, at = _files(spark, path)
    if not system.exists(at("_published")):
        return {}
    names = [status.getPath().getName() for status in system.listStatus(at("_published"))]
    return {int(number): folder for number, _, folder in (n.partition("-") for n in names if not n.startswith((".", "_")))}


def publish(df: DataFrame, path: str, number: int | None = None, keep: int = 2) -> int:
    """Write a new version and make it the current one; returns its number.

    With a ``number`` that is published already (a batch run again) the version is replaced: the new
    folder is published beside the old one, which is withdrawn afterwards.  The last ``keep`` versions stay, so
    that readers that have just opened an older one can finish.
    """
    spark = df.sparkSession
    system, at = _files(spark, path)
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    known = published(spark, path)
    number = max(known, default=-1) + 1 if number is None else number
    system.mkdirs(at("_published"))
    waiting = at(f"_waiting-{folder}")
    system.create(waiting, True).close()
    # the name says it all, so the file needs no content that could be read half-written
    if not system.rename(waiting, at("_published", f"{number:012d}-{folder}")):
        raise OSError(f"version {number} of {path} could not be published")
    for old, name in known.items():
        if old == number or old <= number - keep:
            system.delete(at("_published", f"{old:012d}-{name}"), False)
            system.delete(at(name), True)
    return number


def current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version."""
    versions = published(spark, path)
    if not versions:
        raise FileNotFoundError(f"nothing has been published in {path}")
    return spark.read.parquet(f"{path}/{versions[max(versions)]}")
