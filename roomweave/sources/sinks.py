"""Question files, metadata and dashboard files."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomweave.operators import rollup

#: Rows that one task writes into one file.
FILE_ROWS = 500_000


def _json(q: DataFrame) -> Column:
    """A question as one JSON line; choices between numbers are written as numbers."""
    plain = [c for c in q.columns if c not in ("pattern_name", "choices")]
    text = F.to_json(F.struct(*plain))
    numbers = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("choices"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"])), ", "), F.lit("}"))
    choices = F.when(F.col("mc_source_type").isNotNull(), numbers).otherwise(F.to_json("choices"))
    return F.when(F.col("choices").isNull(), text).otherwise(F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(', "choices": '), choices, F.lit("}")))


def _spread(q: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a group in one task, groups of more than FILE_ROWS rows in as many tasks as they need."""
    sizes = q.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FILE_ROWS)
    parted = q.join(sizes, by, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("value"), F.ceil(F.col("_n") / FILE_ROWS)), F.lit(0)))
    return parted.repartition(*by, "_part").drop("_n", "_part")


def _files(spark: SparkSession, pattern: str) -> tuple[Any, Any, list]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(pattern).getFileSystem(conf)
    return fs, path, list(fs.globStatus(path(pattern)) or [])


def _move(fs: Any, source: Any, target: Any) -> None:
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{source} can't be moved to {target}")


def _values(path: Any, depth: int) -> list[str]:
    """The values of the last `depth` partition folders that hold a file, outermost first."""
    out = []
    for _ in range(depth):
        path = path.getParent()
        out.append(unquote(path.getName().split("=", 1)[1]))
    return out[::-1]


def write_questions(q: DataFrame, out: str) -> None:
    """{out}/pattern={pattern}/scene={scene}/part-*.txt, one JSON question a line, each scene's rows together."""
    lines = q.select(_json(q).alias("value"), F.col("pattern_name").alias("pattern"), F.col("scene_id").alias("scene"))
    _spread(lines, ["pattern", "scene"]).write.partitionBy("pattern", "scene").mode("overwrite").text(out)


def publish_scene_files(spark: SparkSession, written: str, out: str, name: str = "questions.jsonl", pattern_folder: bool = True) -> int:
    """Move part files below pattern=…/scene=… to {out}/{pattern}/{scene}/{name}; returns how many.

    A scene of several parts has its further ones beside the first, with numbers in their names. Works on file names only.
    """
    fs, path, found = _files(spark, f"{written}/pattern=*/scene=*/part-*")
    done: dict[str, int] = {}
    for source in sorted((s.getPath() for s in found), key=str):
        pattern, scene = _values(source, 2)
        folder = f"{out}/{pattern}/{scene}" if pattern_folder else f"{out}/{scene}"
        n = done[folder] = done.get(folder, -1) + 1
        _move(fs, source, path(f"{folder}/{name}" if n == 0 else f"{folder}/{n:05d}.{name}"))
    fs.delete(path(written), True)
    return sum(done.values()) + len(done)


def write_document(spark: SparkSession, document: dict[str, Any], where: str) -> None:
    """One small JSON file, from the driver."""
    fs, path, _ = _files(spark, where)
    stream = fs.create(path(where), True)
    stream.write(bytearray(json.dumps(document, ensure_ascii=False, indent=2, default=str).encode()))
    stream.close()


def write_runs(meta: DataFrame, out: str) -> None:
    """{out}/{pattern}/{scene}/metadata.json of every run, and an empty questions.jsonl for runs without questions."""
    spark = meta.sparkSession
    fields = ["scene_id", F.col("pattern_name").alias("pattern"), "num_cameras", "num_questions", "focus_objects", "num_focus_objects", "num_focus_pairs", "question_types"]
    lines = meta.select(F.to_json(F.struct(*fields)).alias("value"), F.col("pattern_name").alias("pattern"), F.col("scene_id").alias("scene"))
    lines.repartition("pattern", "scene").write.partitionBy("pattern", "scene").mode("overwrite").text(f"{out}/_runs")
    publish_scene_files(spark, f"{out}/_runs", out, "metadata.json")
    fs, path, _ = _files(spark, out)
    for r in meta.where("num_questions = 0").select("pattern_name", "scene_id").toLocalIterator():
        fs.create(path(f"{out}/{r.pattern_name}/{r.scene_id}/questions.jsonl"), True).close()


def write_categories(q: DataFrame, out: str, by_scene: bool = False) -> None:
    """{out}/mc|numerical/{sub}/questions.jsonl and {out}/mc/all_mc.jsonl, {out}/numerical/all_numerical.jsonl, as folders of
    parts: questions by answer category and sub-type, and each category in one. With by_scene below {out}/{scene}."""
    spark = q.sparkSession
    split = rollup.category_split(q.withColumn("value", _json(q))).select("value", "category", "sub", F.col("scene_id").alias("scene"))
    by = ["scene", "category", "sub"] if by_scene else ["category", "sub"]
    for combined in (False, True):
        rows = split.withColumn("sub", F.concat(F.lit("all_"), "category")) if combined else split
        rows.select("value", *by).write.partitionBy(*by).mode("overwrite").text(f"{out}/_categories")
        fs, path, found = _files(spark, f"{out}/_categories/{'/'.join(f'{c}=*' for c in by)}")
        for s in found:
            *upper, name = [unquote(x.split("=", 1)[1]) for x in s.getPath().toString().split("/")[-len(by) :]]
            _move(fs, s.getPath(), path("/".join([out, *upper, f"{name}.jsonl" if combined else f"{name}/questions.jsonl"])))
        fs.delete(path(f"{out}/_categories"), True)


def update_image_paths(q: DataFrame, images: DataFrame, out: str) -> int:
    """Questions with the paths of images that are there, to a new folder in the layout that is read: what is read is never overwritten."""
    write_questions(rollup.with_image_paths(q, images), f"{out}/_parts")
    return publish_scene_files(q.sparkSession, f"{out}/_parts", out)


def write_dataset(q: DataFrame, out: str, config: dict[str, Any], scenes: DataFrame) -> dict[str, Any]:
    """The library's dataset: per scene questions and categories, the whole in {out}/questions.jsonl (a folder of parts) and
    by category, {out}/scene_stats (questions of every scene, none included) and metadata.json with totals and settings."""
    spark = q.sparkSession
    write_questions(q.withColumn("pattern_name", F.lit("all")), f"{out}/_parts")
    publish_scene_files(spark, f"{out}/_parts", out, pattern_folder=False)
    q.select(_json(q).alias("value")).write.mode("overwrite").text(f"{out}/questions.jsonl")
    write_categories(q, out, by_scene=True)
    write_categories(q, out)
    per_scene = scenes.select("scene_id").distinct().join(q.groupBy("scene_id").agg(F.count(F.lit(1)).alias("num_questions")), "scene_id", "left").na.fill(0)
    per_scene.write.mode("overwrite").json(f"{out}/scene_stats")
    types = {r.question_type: r.n for r in q.groupBy(F.coalesce("question_type", F.lit("unknown")).alias("question_type")).agg(F.count(F.lit(1)).alias("n")).orderBy("question_type").collect()}
    said = {"generated_at": datetime.now(UTC).isoformat(), "total_questions": sum(types.values()), "num_scenes": spark.read.json(f"{out}/scene_stats").count(), "question_type_stats": types, "config": config}
    write_document(spark, said, f"{out}/metadata.json")
    return said


def dashboard(q: DataFrame, meta: DataFrame, types: list[str]) -> dict[str, Any]:
    """The small, collected part of a dashboard: its size hangs on types, patterns and the top labels, not on questions."""
    rows = lambda d: [r.asDict(recursive=True) for r in d.collect()]
    return {
        "summary": rows(rollup.run_summary(q))[0], "question_type_counts": rows(rollup.type_stats(q)), "pattern_type_cross": rows(rollup.heatmap(q, "pattern_name", "question_type", types)),
        "yes_no_counts": rows(rollup.yes_no(q)), "mc_counts": rows(rollup.choice_answers(q)), "numeric_answer_stats": rows(rollup.numeric_summary(q)),
        "numeric_histograms": rows(rollup.histogram(q)), "top_object_labels": rows(rollup.top_labels(q)),
    }


def write_dashboard(q: DataFrame, meta: DataFrame, out: str, types: list[str]) -> None:
    """dashboard.json from the driver; what grows with scenes and questions is written by the executors."""
    spark = q.sparkSession
    text = json.dumps(dashboard(q, meta, types), ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/dashboard")
    rollup.compact(q).write.mode("overwrite").json(f"{out}/question_index")
    rollup.scene_overview(q, meta).write.mode("overwrite").json(f"{out}/scene_overview")
    rollup.chunk_manifest(q, meta).write.mode("overwrite").json(f"{out}/chunk_manifest")
