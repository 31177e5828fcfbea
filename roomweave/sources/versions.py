"""Tables that are kept from batch to batch: every batch writes a new version.

Of tables that are written anew the last complete version counts (`latest`, `save`), of tables that only grow all of them
(`parts`, `append`). An unfinished write is never seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _complete(spark: SparkSession, folder: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/version=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or [])


def latest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The last complete version, None if there is none; an unfinished write is never seen."""
    known = _complete(spark, folder)
    return spark.read.parquet(f"{folder}/version={known[-1]}") if known else None


def save(table: DataFrame, folder: str) -> DataFrame:
    """Write the next version and return it; what the table was computed from may be the version before."""
    spark = table.sparkSession
    n = max(_complete(spark, folder), default=0) + 1
    table.write.mode("overwrite").parquet(f"{folder}/version={n}")
    return spark.read.parquet(f"{folder}/version={n}")


def parts(spark: SparkSession, folder: str) -> DataFrame | None:
    """All complete versions of a table that only grows, None if there is none."""
    known = _complete(spark, folder)
    return spark.read.parquet(*(f"{folder}/version={n}" for n in known)) if known else None


def append(rows: DataFrame, folder: str) -> DataFrame:
    """Write rows as the next part of a growing table and return the whole table."""
    save(rows, folder)
    return parts(rows.sparkSession, folder)
