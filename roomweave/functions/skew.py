"""Joins that keep hot keys out of single tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key outside the HOT_KEYS most frequent ones holds less than 1/HOT_KEYS of the rows.
HOT_KEYS = 1000
#: Keys below this many rows are never treated as hot.
HOT_ROWS = 20_000


def hot_keys(rows: DataFrame, key: str, most: int = HOT_KEYS, least: int = HOT_ROWS) -> DataFrame:
    """The at most `most` keys with more than `least` rows: counted with map-side combine, bounded by the limit."""
    return (
        rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_roomweave_n")).where(F.col("_roomweave_n") > least)
        .orderBy(F.desc("_roomweave_n"), key).limit(most).select(key)
    )


def skew_left_join(rows: DataFrame, lookup: DataFrame, key: str, most: int = HOT_KEYS, least: int = HOT_ROWS, n_rows: int | None = None) -> DataFrame:
    """rows LEFT JOIN lookup ON key, where `lookup` has one row a key and `rows` may have very hot keys.

    The hot keys (at most `most`, a fixed bound) are counted first, in a job of their own. Their lookup rows are broadcast, so
    that rows of hot keys stay where they are; all other rows meet in a shuffle whose largest key is bounded. Null keys never
    shuffle then. Without hot keys the rows are simply joined; where `n_rows`, the number of rows, is given and no more than
    `least`, no key can be hot and nothing is counted. Columns of `rows` that the lookup has too are replaced.
    """
    rows = rows.drop(*(c for c in lookup.columns if c != key))
    values = [c for c in lookup.columns if c != key]
    columns = [*rows.columns, *values]
    found = [] if n_rows is not None and n_rows <= least else hot_keys(rows, key, most, least).collect()
    if not found:
        return rows.join(lookup, key, "left").select(columns)
    hot = rows.sparkSession.createDataFrame(found, rows.select(key).schema)
    tagged = rows.join(F.broadcast(hot.withColumn("_roomweave_hot", F.lit(True))), key, "left")
    small = F.broadcast(lookup.join(F.broadcast(hot), key, "left_semi"))
    kept = tagged.where(F.col("_roomweave_hot") | F.col(key).isNull()).drop("_roomweave_hot").join(small, key, "left")
    rest = tagged.where(F.col("_roomweave_hot").isNull() & F.col(key).isNotNull()).drop("_roomweave_hot").join(lookup, key, "left")
    return kept.select(columns).unionByName(rest.select(columns))
