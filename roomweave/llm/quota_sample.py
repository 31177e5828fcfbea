"""A sample whose categories have given shares.

Each category's reservoir is the set of its records with the smallest random priorities, which is mergeable: the
reservoir of a union is the smallest of both. Priorities hang on the record alone. One pass over the rows makes the kept
state: one small entry a record (priority, its row, its categories), written once; `merged` joins the states of two batches.
Everything else is read from that state: the counts of priorities by range and category, which add up over partitions; from
the final counts the feasible quotas and what is exhausted; and the range in which each quota's last record lies. Records
below that range are taken, records in it are ranked among themselves. The result is the bottom-quota reservoir of each
category, without any category in one task.

Quotas are trimmed uniformly: if a category has fewer records than its share asks, the whole plan is scaled down to the
largest total at which every share can be met, so that the shares stay as given; min_rows are kept before that, and both
may still ask for more than there is. Categories without any record can't be met at any total and are left out of the scale.

Defined cases: a null value is of no category; a record delivered several times counts once, with the least of its values
(so that the choice doesn't hang on order); a row without scene or pose index is a record of its own; a category that the
plan names but no row has is available zero times; several plans may name the same field; the quota is the scaled share
rounded by largest remainder within a plan, at least min_rows, at most what there is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomweave.functions.normalize import category_key
from roomweave.llm.records import named
from roomweave.session import durable

FIELDS = ("question_type", "answer_type", "answer")
#: Ranges of priorities for which counts are kept per category.
RANGES = 4096
#: Up to so many plan rows are sent to all tasks; more are joined by shuffles.
PLAN_ROWS = 10_000


def reservoirs(questions: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The kept state (record_hash, priority, q_row, the fields' categories): one row a record, q_row being its smallest."""
    name = F.coalesce("record", F.concat(F.lit("#"), F.col("q_row").cast("string")))
    priority = F.conv(F.substring(F.md5(F.concat(F.lit("quota:"), name)), 1, 15), 16, 10).cast("bigint")
    rows = named(questions).select(F.xxhash64(name).alias("record_hash"), priority.alias("priority"), "q_row", *(category_key(F.col(c)).alias(c) for c in fields))
    return durable(_least(rows, fields))


def _least(rows: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    return rows.groupBy("record_hash", "priority").agg(F.min("q_row").alias("q_row"), *(F.min(c).alias(c) for c in fields))


def merged(one: DataFrame, other: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The state of two batches from the states of each."""
    return durable(_least(one.unionByName(other), fields))


def _sent(plan_rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows that are no more than the plans', broadcast if these are few: their number is counted first."""
    return F.broadcast(plan_rows) if plans.limit(PLAN_ROWS + 1).count() <= PLAN_ROWS else plan_rows


def by_plan(state: DataFrame, plans: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(q_row, field_name, category, bucket, priority) for the categories that any plan names."""
    wanted = plans.select("field_name", category_key(F.col("category")).alias("category")).distinct()
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("category")) for f in fields))
    long = state.select("q_row", "priority", F.explode(pairs).alias("p")).select("q_row", "p.field_name", "p.category", "priority", (F.shiftright("priority", 48)).cast("int").alias("bucket"))
    return long.where(F.col("category").isNotNull()).join(_sent(wanted, plans), ["field_name", "category"])


def counts(state: DataFrame, plans: DataFrame) -> DataFrame:
    """(field_name, category, bucket, n): the final counts of the reservoirs by range of priorities."""
    return by_plan(state, plans).groupBy("field_name", "category", "bucket").agg(F.count(F.lit(1)).alias("n"))


def quotas(plans: DataFrame, ranges: DataFrame) -> DataFrame:
    """Plan rows with `available`, `needed`, `quota`, `share`, by the final counts.

    Shares are counted in billionths, so that all quotas are whole-number divisions: size x share / 10^9 as asked, or, at the
    largest total that a scarce category allows, its records x share / its share.
    """
    available = ranges.groupBy("field_name", F.col("category").alias("key")).agg(F.sum("n").alias("available"))
    plan = Window.partitionBy("plan_id")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    joined = plans.withColumn("key", category_key(F.col("category"))).join(available, ["field_name", "key"], "left").withColumn("available", F.coalesce("available", F.lit(0)))
    joined = joined.withColumn("nano", F.round(F.coalesce("target_share", F.lit(0.0)) * 1_000_000_000).cast("bigint")).withColumn("least", F.coalesce(F.col("min_rows").cast("bigint"), F.lit(0)))
    as_asked = F.struct((F.col("sample_size") / F.lit(1e9)).alias("rate"), F.lit("").alias("at"), F.col("sample_size").alias("times"), F.lit(1_000_000_000).cast("bigint").alias("of"))
    scarce = F.when((F.col("available") > 0) & (F.col("nano") > 0), F.struct((F.col("available") / F.col("nano")).alias("rate"), F.col("category").alias("at"), F.col("available").alias("times"), F.col("nano").alias("of")))
    return (
        joined.withColumn("scale", F.min(F.least(as_asked, F.coalesce(scarce, as_asked))).over(plan)).select("*", "scale.times", "scale.of")
        .withColumn("product", big("nano") * big("times"))
        .withColumn("whole", F.expr("product div of")).withColumn("rest", F.col("product") % F.col("of"))
        .withColumn("spare", F.expr("(2 * sum(product) OVER (PARTITION BY plan_id) + of) div (2 * of)") - F.sum("whole").over(plan))
        .withColumn("rounded", F.col("whole") + F.when(F.row_number().over(plan.orderBy(F.desc("rest"), "category")) <= F.col("spare"), 1).otherwise(0))
        .withColumn("needed", F.greatest("least", F.ceil(F.col("target_share").cast("decimal(18,9)") * F.col("sample_size")).cast("bigint")))
        .withColumn("quota", F.least(F.col("available"), F.greatest(F.col("least"), F.col("rounded").cast("bigint"))))
        .withColumn("share", F.col("quota") / F.sum("quota").over(plan))
        .select("plan_id", "field_name", "category", "key", "target_share", "min_rows", "sample_size", "available", "needed", "quota", "share")
    )


def report(state: DataFrame, plans: DataFrame) -> DataFrame:
    """Every plan row with what is available, what is needed, the feasible quota, the share met and whether it is exhausted."""
    return quotas(plans, counts(state, plans)).withColumn("exhausted", F.col("available") < F.col("needed"))


def sample(state: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_id, category, q_row): the sampled records of every plan."""
    ranges = durable(counts(state, plans))
    below = F.coalesce(F.sum("n").over(Window.partitionBy("field_name", "category").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most RANGES rows a category
    limits = quotas(plans, ranges).where(F.col("quota") > 0).select("plan_id", "field_name", "category", "key", "quota")
    last = (F.col("below") < F.col("quota")) & (F.col("below") + F.col("n") >= F.col("quota"))  # the range of the quota's last record
    cut = limits.join(ranges.withColumn("below", below).withColumnRenamed("category", "key"), ["field_name", "key"]).where(last)
    cut = cut.select("plan_id", "field_name", "category", "key", F.col("bucket").alias("last"), (F.col("quota") - F.col("below")).alias("take"), "n")
    met = by_plan(state, plans).withColumnRenamed("category", "key").join(_sent(cut, plans), ["field_name", "key"]).where(F.col("bucket") <= F.col("last"))
    whole = (F.col("bucket") < F.col("last")) | (F.col("n") == F.col("take"))
    rank = F.row_number().over(Window.partitionBy("plan_id", "key", "bucket").orderBy("priority", "q_row"))
    parted = met.where(~whole).withColumn("rank", rank).where(F.col("rank") <= F.col("take"))
    return met.where(whole).select("plan_id", "category", "q_row").unionByName(parted.select("plan_id", "category", "q_row"))
