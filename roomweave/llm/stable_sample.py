"""A reproducible sample that keeps its members as data grow.

Two kept tables only grow. `rates` holds each epoch's rate, frozen when the epoch is first seen. `records` holds each
record's first-seen epoch, that epoch's frozen rate and its first delivery. A record is a member if a counter-based random
number, made from the seed and the record's name alone, is below its frozen rate. Hence reruns and other partitionings give
the same sample, later epochs never touch earlier members, and all deliveries of a record share its fate, late ones
included: what the ledger knows is only met again, never changed.

Defined cases: rows without scene or pose index are records of their own, named by their row; null epochs come before all
others (epoch 0); a batch that comes again, and repeated rows, change nothing; a record that comes late gets the frozen rate
of its own epoch; an epoch without a given rate gets the default; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomweave.functions.skew import skew_left_join
from roomweave.llm.records import named
from roomweave.session import durable
from roomweave.sources import versions

SEED = 20_240
RATE = 0.1


def uniform(seed: int, name: Column, counter: int = 0) -> Column:
    """The counter-th random number of a name, in [0, 1): 52 bits of md5 over seed, counter and name."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{counter}:"), name)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def with_record(questions: DataFrame) -> DataFrame:
    return named(questions).withColumn("record", F.coalesce("record", F.concat(F.lit("#"), F.col("q_row").cast("string"))))


def _unknown(rows: DataFrame, known: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key isn't known. The known keys are first cut down to those of the batch, so that a small batch is sent to them."""
    if known is None:
        return rows
    met = known.select(key).join(rows.select(key).distinct(), key, "left_semi")
    return rows.join(met.distinct(), key, "left_anti")


def update(rows: DataFrame, folder: str, rates: dict[int, float] | None = None, default: float = RATE) -> DataFrame:
    """The kept ledger (record, epoch, rate, first_row) in `folder` after a batch of rows (record, row, epoch).

    A batch may hold rows of many epochs. Rows only meet as one small entry a record and partition.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col("record").isNotNull()).select("record", "row", F.coalesce("epoch", F.lit(0)).alias("epoch"))
    rate = F.lit(float(default))
    if rates:
        rate = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for e, r in rates.items() for x in (int(e), float(r)))), F.col("epoch")), rate)
    frozen = versions.append(_unknown(rows.select("epoch").distinct(), versions.parts(spark, f"{folder}/rates"), "epoch").select("epoch", rate.alias("rate")), f"{folder}/rates")
    seen = rows.groupBy("record").agg(F.min("epoch").alias("epoch"), F.min("row").alias("first_row"))
    fresh = _unknown(seen, versions.parts(spark, f"{folder}/records"), "record").join(frozen, "epoch")
    return versions.append(fresh.select("record", "epoch", "rate", "first_row"), f"{folder}/records")


def members(entries: DataFrame, seed: int = SEED) -> DataFrame:
    return entries.where(uniform(seed, F.col("record")) < F.col("rate"))


def sample(rows: DataFrame, entries: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows (all deliveries) of the ledger's members, with epoch and rate."""
    return skew_left_join(rows.where(F.col("record").isNotNull()), members(entries, seed).select("record", F.col("epoch").alias("first_epoch"), "rate"), "record").where(F.col("rate").isNotNull())


def deliveries(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """(q_row_a, q_row_b): the pairs of rows that the ledger treats as one record; rows (record, row).

    A row that isn't its record's first delivery is a later one; only records with such rows are joined with themselves.
    Names meet as 128 bits; Spark splits the joins where a name is hot. Each pair comes once, the smaller row first.
    """
    name = [F.xxhash64("record").alias("h"), F.xxhash64(F.lit(1), "record").alias("g")]
    first = entries.select(*name, "first_row")
    met = rows.where(F.col("record").isNotNull()).select(*name, "row").join(first, ["h", "g"])
    later = durable(met.where(F.col("row") != F.col("first_row")).distinct())
    members = later.select("h", "g", "row").unionByName(later.select("h", "g", F.col("first_row").alias("row")).distinct())
    a, b = members.withColumnRenamed("row", "q_row_a"), members.withColumnRenamed("row", "q_row_b")
    return a.join(b, ["h", "g"]).where(F.col("q_row_a") < F.col("q_row_b")).select("q_row_a", "q_row_b")
