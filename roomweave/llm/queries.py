"""Queries of the operators for training data over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomweave.functions.normalize import category_key, scan_key, scene_key
from roomweave.functions.skew import skew_left_join
from roomweave.llm import langid, leakage, quota_sample, splits, stable_sample, tokenize
from roomweave.session import scratch_dir, table


def _scene_edges(spark: SparkSession, d: str) -> list[DataFrame]:
    """The edges in two batches: all entries before the last recorded month, and those of that month."""
    s = table(spark, d, "scene_sources").withColumn("scene", scene_key(F.col("scene_id")))
    last = table(spark, d, "scene_sources").agg(F.date_trunc("month", F.max("recorded_at"))).first()[0]
    late = F.coalesce(F.col("recorded_at") >= F.lit(last), F.lit(False))
    edges = s.select(late.alias("late"), F.explode(F.array(F.struct(F.col("scene").alias("a"), scan_key(F.col("scan_ref")).alias("b")), F.struct(F.col("scene").alias("a"), scene_key(F.col("made_from")).alias("b")))).alias("e")).select("late", "e.a", "e.b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    return [edges.where(~F.col("late")).drop("late"), edges.where("late").drop("late")]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(spark, "components")
    groups = [splits.merge(batch, folder) for batch in _scene_edges(spark, d)][-1]
    groups = groups.where(F.col("node") != F.col("root")).select(F.col("node").alias("scene"), "root")
    q = table(spark, d, "questions").where(F.col("scene_id").isNotNull()).select("q_row", "scene_id", scene_key(F.col("scene_id")).alias("scene"))
    group = F.coalesce("root", "scene")
    return skew_left_join(q, groups, "scene").where(F.col("scene_id") != group).select("q_row", group.alias("group_scene"))


def _split_rows(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "questions").select("q_row", scene_key(F.col("scene_id")).alias("entity"), category_key(F.col("question_type")).alias("stratum"))
    folder = scratch_dir(spark, "splits")
    ledger = [splits.update(q, batch, folder) for batch in _scene_edges(spark, d)][-1]
    return splits.split_of(q, ledger, "entity", F.col("q_row"))


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    return _split_rows(spark, d).select("q_row", F.coalesce("root", "entity").alias("group_scene"), "split")


def p2_split_shares(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_report(_split_rows(spark, d)).select(F.col("stratum").alias("question_type"), "split", "rows", "share")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.report(quota_sample.reservoirs(table(spark, d, "questions")), table(spark, d, "sample_plans")).where("exhausted").select("plan_id", "category")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.report(quota_sample.reservoirs(table(spark, d, "questions")), table(spark, d, "sample_plans")).select("plan_id", "category", "available", "needed", "quota", "share", "exhausted")


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.sample(quota_sample.reservoirs(table(spark, d, "questions")), table(spark, d, "sample_plans"))


def _ledger(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The rows by record, and the kept ledger after the backlog of batches and then the last one."""
    rows = stable_sample.with_record(table(spark, d, "questions")).select(F.col("q_row").alias("row"), "record", F.coalesce("batch_no", F.lit(0)).alias("epoch"))
    last = table(spark, d, "questions").agg(F.max("batch_no")).first()[0] or 0
    folder = scratch_dir(spark, "stable-sample")
    stable_sample.update(rows.where(F.col("epoch") < last), folder)
    return rows, stable_sample.update(rows.where(F.col("epoch") >= last), folder)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return stable_sample.deliveries(*_ledger(spark, d))


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return stable_sample.sample(*_ledger(spark, d)).select(F.col("row").alias("q_row"), "first_epoch", "rate")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.wrong_labels(table(spark, d, "documents"), table(spark, d, "lang_samples"))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return langid.segments(table(spark, d, "documents"), table(spark, d, "lang_samples"))


def p9_languages(spark: SparkSession, d: str) -> DataFrame:
    return langid.languages(table(spark, d, "documents"), table(spark, d, "lang_samples"))


QUERIES = {f.__name__: f for f in (p2_found, p2_splits, p2_split_shares, p4_found, p4_report, p4_sample, p5_found, p5_sample, p7_ids, p8_found, p9_found, p9_segments, p9_languages)}
