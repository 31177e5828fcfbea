"""Statistics of question datasets: counters, cross-tabs, distributions, histograms and scene overviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YES_NO_TYPES = ("relative_size", "relative_distance", "relative_distance_to_camera")
NUMERIC_TYPES = ("object_size", "object_distance_to_camera", "object_pair_distance_center")


def type_stats(q: DataFrame) -> DataFrame:
    return q.groupBy(F.coalesce("question_type", F.lit("unknown")).alias("question_type")).agg(F.count(F.lit(1)).alias("n"))


def counters(q: DataFrame) -> DataFrame:
    """All one- and two-way counts over pattern, type and scene in one pass; absent keys are null, `level` names the set."""
    base = q.select(F.coalesce("pattern_name", F.lit("?")).alias("pattern_name"), F.coalesce("question_type", F.lit("unknown")).alias("question_type"), F.coalesce("scene_id", F.lit("?")).alias("scene_id"))
    sets = [["pattern_name"], ["question_type"], ["scene_id"], ["pattern_name", "question_type"], ["scene_id", "pattern_name"], ["scene_id", "question_type"]]
    # One fine partial count first: the sets then expand counts instead of rows.
    fine = base.groupBy("pattern_name", "question_type", "scene_id").agg(F.count(F.lit(1)).alias("n"))
    keys = ["pattern_name", "question_type", "scene_id"]
    return fine.groupingSets(sets, *keys).agg(F.sum("n").alias("n"), F.grouping_id().cast("int").alias("level"))


def label_counts(q: DataFrame) -> DataFrame:
    """Labels of nested objects, empty ones apart, with their counts."""
    labels = q.select(F.explode(F.transform("objects", lambda o: o["label"])).alias("label"))
    return labels.where(F.col("label").isNotNull() & (F.col("label") != "")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def top_labels(q: DataFrame, most: int = 100) -> DataFrame:
    """The most frequent labels; ties by name."""
    return label_counts(q).orderBy(F.desc("n"), "label").limit(most)


def yes_no(q: DataFrame) -> DataFrame:
    text = F.coalesce(F.nullif("answer_text", F.lit("")), "answer")
    return q.where(F.col("question_type").isin(*YES_NO_TYPES)).groupBy("question_type", text.alias("answer_text")).agg(F.count(F.lit(1)).alias("n"))


def choice_answers(q: DataFrame) -> DataFrame:
    return q.where(F.col("question_type") == "mc").groupBy("answer", F.coalesce("mc_source_type", F.lit("unknown")).alias("mc_source_type")).agg(F.count(F.lit(1)).alias("n"))


def numeric_answers(q: DataFrame) -> DataFrame:
    value = F.expr("try_cast(answer AS double)")
    return q.where(F.col("question_type").isin(*NUMERIC_TYPES)).select("question_type", value.alias("v")).where(F.col("v").isNotNull())


def _round4(c: Column) -> Column:
    return F.rint(c * 10000.0) / 10000.0


#: Equal ranges of a type's values, of which those with the middle are looked into.
MEDIAN_RANGES = 4096


def numeric_summary(q: DataFrame) -> DataFrame:
    """count, min, max, mean and exact median per numeric type.

    The median comes from counts per value: by MEDIAN_RANGES equal ranges from least to most first, and then among the
    values of the one or two ranges that hold the middle, so that no task holds all values of a type.
    """
    v = F.col("v")
    values = numeric_answers(q).where(v.isNotNull()).groupBy("question_type", "v").agg(F.count(F.lit(1)).alias("c"))
    totals = numeric_answers(q).groupBy("question_type").agg(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"))
    at = F.least(F.coalesce(F.floor(F.try_divide(v - F.col("low"), F.col("high") - F.col("low")) * MEDIAN_RANGES), F.lit(0)), F.lit(MEDIAN_RANGES - 1))
    ranged = values.join(F.broadcast(totals), "question_type").withColumn("range", at)  # a row per numeric type
    before = lambda by, order: F.coalesce(F.sum("c").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = lambda: (F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))
    holds = lambda rank: (F.col("before") <= rank) & (rank < F.col("before") + F.col("c"))
    lower, upper = ends()
    ranges = ranged.groupBy("question_type", "range", "n").agg(F.sum("c").alias("c")).withColumn("before", before(["question_type"], "range"))
    middle = ranges.where(holds(lower) | holds(upper)).select("question_type", "range", F.col("before").alias("below"))
    near = ranged.join(F.broadcast(middle), ["question_type", "range"]).withColumn("before", F.col("below") + before(["question_type", "range"], "v"))
    ends_of = near.groupBy("question_type").agg(F.min(F.when(holds(lower), v)).alias("a"), F.min(F.when(holds(upper), v)).alias("b"))
    made = totals.join(F.broadcast(ends_of), "question_type", "left")
    return made.select("question_type", "n", _round4(F.col("low")).alias("least"), _round4(F.col("high")).alias("most"), _round4(F.col("mean")).alias("mean"), _round4((F.col("a") + F.col("b")) / 2).alias("median"))


def histogram(q: DataFrame, bins: int = 20) -> DataFrame:
    """(question_type, bin, low, high, n): equal bins from least to most, the last closed; a constant gets bins half around it."""
    values = numeric_answers(q)
    span = values.groupBy("question_type").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    flat = F.col("a") == F.col("b")
    span = span.select("question_type", F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("a"), F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("b"))
    at = F.least(F.floor((F.col("v") - F.col("a")) / (F.col("b") - F.col("a")) * bins), F.lit(bins - 1)).cast("int")
    counts = values.join(F.broadcast(span), "question_type").groupBy("question_type", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # a row per numeric type
    width = (F.col("b") - F.col("a")) / bins
    every = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).withColumn("low", _round4(F.col("a") + width * F.col("bin"))).withColumn("high", _round4(F.col("a") + width * (F.col("bin") + 1)))
    return every.join(counts, ["question_type", "bin"], "left").select("question_type", "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


def pose_references(q: DataFrame) -> DataFrame:
    """Per scene, distinct pattern and pose index; rows without an index count for none."""
    ref = F.when(F.col("camera_pose_idx").isNotNull(), F.struct(F.coalesce("pattern_name", F.lit("")), "camera_pose_idx"))
    return q.groupBy("scene_id").agg(F.countDistinct(ref).alias("pose_refs"))


def focus_labels(meta: DataFrame) -> DataFrame:
    """Per scene the sorted distinct focus labels of its runs."""
    labels = meta.select("scene_id", F.explode("focus_objects").alias("label")).where(F.col("label").isNotNull())
    return labels.groupBy("scene_id").agg(F.array_sort(F.collect_set("label")).alias("labels")).withColumn("num_objects", F.size("labels"))


def scene_overview(q: DataFrame, meta: DataFrame) -> DataFrame:
    """Per scene: total, maps by pattern and type, distinct pose references, focus labels."""
    keyed = q.where(F.col("scene_id").isNotNull())
    side = lambda c, name: keyed.groupBy("scene_id", F.coalesce(c, F.lit("unknown")).alias("k")).agg(F.count(F.lit(1)).alias("n")).groupBy("scene_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(name))
    refs = keyed.groupBy("scene_id").agg(F.count(F.lit(1)).alias("total_questions"), F.countDistinct(F.when(F.col("camera_pose_idx").isNotNull(), F.struct("pattern_name", "camera_pose_idx"))).alias("camera_pose_refs"))
    return refs.join(side("pattern_name", "by_pattern"), "scene_id").join(side("question_type", "by_type"), "scene_id").join(focus_labels(meta), "scene_id", "left")


def heatmap(q: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Dense counts: a row a key, a column a value, 0 where there is none."""
    return q.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).na.fill(0)


def category_split(q: DataFrame) -> DataFrame:
    """With `category` and `sub`, the folders that questions are written to: choices by their source, all else by type."""
    mc = F.coalesce(F.col("answer_type") == "mc", F.lit(False))
    kind = F.coalesce("question_type", F.lit("unknown"))
    return q.withColumn("category", F.when(mc, "mc").otherwise("numerical")).withColumn("sub", F.when(kind == "mc", F.concat(F.lit("mc_"), F.coalesce("mc_source_type", F.lit("unknown")))).otherwise(kind))


def compact(q: DataFrame) -> DataFrame:
    """The index entry of a question: labels instead of objects, the chunk file that holds it."""
    return q.select(
        "scene_id", "pattern_name", "question_id", "question_type", "answer_type", "question", "answer", "answer_text", "primary_object", "camera_pose_idx", "mc_source_type", "image", "image_path",
        F.transform("objects", lambda o: o["label"]).alias("object_labels"), F.concat_ws("__", "pattern_name", F.concat("scene_id", F.lit(".json"))).alias("chunk_file"),
    )


def chunk_manifest(q: DataFrame, meta: DataFrame) -> DataFrame:
    """Per pattern and scene: questions, chunk file and what the run's metadata say, where there are any."""
    n = q.groupBy("scene_id", "pattern_name").agg(F.count(F.lit(1)).alias("question_count"))
    m = meta.select("scene_id", "pattern_name", "num_cameras", "num_questions", "num_focus_objects", "num_focus_pairs")
    return n.join(m, ["scene_id", "pattern_name"], "left").withColumn("chunk_file", F.concat_ws("__", "pattern_name", F.concat("scene_id", F.lit(".json"))))


def run_metadata(q: DataFrame) -> DataFrame:
    """Per pattern and scene: questions and distinct types in order."""
    return q.groupBy("scene_id", "pattern_name").agg(F.count(F.lit(1)).alias("num_questions"), F.array_sort(F.collect_set("question_type")).alias("question_types"))


def run_summary(q: DataFrame) -> DataFrame:
    return q.agg(F.count(F.lit(1)).alias("total_questions"), F.countDistinct("scene_id").alias("total_scenes"), F.countDistinct("scene_id", "pattern_name").alias("runs"))


def generation_summary(scenes: DataFrame, meta: DataFrame) -> dict:
    """Totals of a batch run: its scenes, those skipped at the gate, its questions. A run that fails ends the job: none is left out."""
    skipped = [r.scene_id for r in scenes.join(meta.select("scene_id").distinct(), "scene_id", "left_anti").orderBy("scene_id").collect()]  # names of folders
    n = scenes.count()
    return {"total_questions": meta.agg(F.coalesce(F.sum("num_questions"), F.lit(0))).first()[0], "total_scenes": n, "scenes_processed": n - len(skipped), "scenes_skipped": skipped, "failed": []}


# -- images ------------------------------------------------------------------------------------------------------------


def first_poses(q: DataFrame) -> DataFrame:
    """The pose of the first question of every pose index."""
    k = F.col("camera_pose_idx")
    return q.where(k.isNotNull()).groupBy("scene_id", "pattern_name", k).agg(F.min_by("camera_pose", "q_row").alias("camera_pose"), F.min("q_row").alias("first_row"))


def image_path() -> Column:
    return F.format_string("%s/%s/images/pose_%04d.png", F.col("pattern_name"), F.col("scene_id"), F.col("camera_pose_idx"))


def missing_images(q: DataFrame, images: DataFrame) -> DataFrame:
    """(scene_id, pattern_name, camera_pose_idx, image_path): poses whose image isn't there yet."""
    poses = q.where((F.col("camera_pose_idx") >= 0) & F.col("scene_id").isNotNull()).select("scene_id", "pattern_name", "camera_pose_idx").distinct().withColumn("image_path", image_path())
    return poses.join(images.select("image_path"), "image_path", "left_anti")


def with_image_paths(q: DataFrame, images: DataFrame) -> DataFrame:
    """Questions with image_path set where the file of their pose is there."""
    there = images.select(F.col("image_path").alias("_there")).distinct()
    keyed = q.withColumn("_path", F.when(F.col("camera_pose_idx") >= 0, image_path()))
    return keyed.join(there, F.col("_path") == F.col("_there"), "left").withColumn("image_path", F.coalesce("_there", "image_path")).drop("_path", "_there")


def with_images(q: DataFrame, rendered: DataFrame) -> DataFrame:
    """Questions with `image` set from rendered (scene_id, pattern_name, camera_pose_idx, file) where their pose is rendered."""
    files = rendered.select("scene_id", "pattern_name", "camera_pose_idx", F.concat(F.lit("images/"), "file").alias("_image"))
    return q.join(files, ["scene_id", "pattern_name", "camera_pose_idx"], "left").withColumn("image", F.coalesce("_image", "image")).select(q.columns)


def view_counter(poses: DataFrame, key: Column) -> DataFrame:
    """A running number of the views of each target key, by pose index within scene and pattern."""
    w = Window.partitionBy("scene_id", "pattern_name", "object_key").orderBy("pose_idx", "pose_row")
    return poses.withColumn("object_key", key).withColumn("view", F.row_number().over(w) - 1)
