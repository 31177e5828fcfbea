"""References to records that are missing, deleted or late.

Parent and child keys are put into one long, tagged form and grouped by parent table and key; a group without a parent
row holds only missing references. For groups with parents, what was there at the time of each reference follows from
running sums over the parents' arrivals and removals. References of one key and time find the same and are summed up before
they meet, so a batch that delivers a hot key again is one entry. The running sums are taken in two steps, per hour and
within an hour, so that no task ever holds more than the different times of one hour of one key, however hot the key is.
Only the times that find nothing go back to their references, in a join that Spark splits where a key is hot.

Defined cases: a null key refers to nothing; a null reference time, or a parent row without arrival, is never there; a
removal at or before the arrival means that the row was never there, though it counts as arrived; a removal at the very
time of the reference counts as removed, an arrival as arrived. Repeated parent rows add up. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomweave.session import written


GROUP = ["ref_table", "ref_key"]
#: Microseconds of an hour; what stands for no time, before and after all others.
HOUR, BEFORE, NEVER = 3_600_000_000, -(2**63), 2**63 - 1


def _micros(at: Column, none: int) -> Column:
    return F.coalesce(F.unix_micros(at.cast("timestamp")), F.lit(none))


def long_form(children: DataFrame, parents: DataFrame) -> DataFrame:
    """children (ref_table, ref_key, child_id, at) and parents (ref_table, ref_key, arrived_at, removed_at), one row an event.

    (ref_table, ref_key, t, there, come, tag, child_id): `t` is the time in microseconds; `there` and `come` are what the
    event adds to the rows that are there and that have ever arrived; `tag` is 1 for references, 0 for parents' events.
    """
    shown = F.col("removed_at").isNull() | (F.col("removed_at") > F.col("arrived_at"))
    event = lambda t, there, come: F.struct(t.alias("t"), there.cast("int").alias("there"), F.lit(come).alias("come"))
    events = F.array(event(_micros(F.col("arrived_at"), NEVER), shown, 1), event(F.when(shown, F.unix_micros(F.col("removed_at").cast("timestamp"))), F.lit(-1), 0))
    arrivals = (
        parents.where(F.col("ref_key").isNotNull()).select(*GROUP, F.explode(events).alias("e")).where(F.col("e.t").isNotNull())
        .select(*GROUP, "e.t", "e.there", "e.come", F.lit(0).alias("tag"), F.lit(None).cast(children.schema["child_id"].dataType).alias("child_id"))
    )
    references = children.where(F.col("ref_key").isNotNull()).select(*GROUP, _micros(F.col("at"), BEFORE).alias("t"), F.lit(0).alias("there"), F.lit(0).alias("come"), F.lit(1).alias("tag"), "child_id")
    return references.unionByName(arrivals)


def orphan_references(children: DataFrame, parents: DataFrame) -> DataFrame:
    """(ref_table, child_id, at, reason): one row a reference whose key has no row that is there at its time."""
    rows = long_form(children, parents).withColumn("hour", F.floor(F.col("t") / HOUR))
    sums = [F.sum("there").alias("there"), F.sum("come").alias("come"), F.max("tag").alias("tag")]
    earlier = Window.partitionBy(*GROUP).orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = (
        rows.groupBy(*GROUP, "hour").agg(*sums, F.max(1 - F.col("tag")).alias("parent"))
        .withColumn("there0", F.coalesce(F.sum("there").over(earlier), F.lit(0)))
        .withColumn("come0", F.coalesce(F.sum("come").over(earlier), F.lit(0)))
        .withColumn("known", F.max("parent").over(Window.partitionBy(*GROUP)))
        # Hours without references, and those in which all references find a row, need no look at single times.
        .where((F.col("tag") == 1) & ((F.col("parent") == 1) | (F.col("there0") <= 0)))
        .select(*GROUP, "hour", "there0", "come0", "known")
    )
    looked = written(rows.join(hours, [*GROUP, "hour"]))
    within = Window.partitionBy(*GROUP, "hour").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    reason = F.when(F.col("known") == 0, "missing").when(F.col("there_then") > 0, None).when(F.col("come_then") > 0, "deleted").otherwise("late")
    found = (
        looked.groupBy(*GROUP, "hour", "t").agg(*sums, F.max("there0").alias("there0"), F.max("come0").alias("come0"), F.max("known").alias("known"))
        .withColumn("there_then", F.col("there0") + F.sum("there").over(within))
        .withColumn("come_then", F.col("come0") + F.sum("come").over(within))
        .withColumn("reason", reason)
        .where((F.col("tag") == 1) & F.col("reason").isNotNull())
        .select(*GROUP, "t", "reason")
    )
    at = F.timestamp_micros(F.when(F.col("t") != BEFORE, F.col("t"))).cast(children.schema["at"].dataType)
    return looked.where(F.col("tag") == 1).join(found, [*GROUP, "t"]).select("ref_table", "child_id", at.alias("at"), "reason")


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Counts per referenced table, month of the reference and reason."""
    return orphans.groupBy("ref_table", F.date_trunc("month", "at").alias("month"), "reason").agg(F.count(F.lit(1)).alias("orphans"))
