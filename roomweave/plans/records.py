"""Queries of the general record operators (p1, p3, p6) over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomweave.functions.normalize import path_key, pose_key
from roomweave.operators import compaction, nested, orphans
from roomweave.session import scratch_dir, table

LINKS = [
    nested.Link("object", "objects", "id", "objects", "id", own=True),
    nested.Link("target", "camera_pose.target_objects", "value", "objects", "label", fold=True, blank=False),
]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "questions").select("q_row", "objects", F.struct("camera_pose.target_objects").alias("camera_pose"))
    return nested.child_links(q, "q_row", ["objects", "camera_pose"], LINKS)


def _axes(column: str, prefix: str) -> list[Column]:
    return [F.get(column, F.lit(i)).alias(f"{prefix}_{a}") for i, a in enumerate("xyz")]


#: The records' columns that are neither nested nor times.
PLAIN = ["question", "answer", "answer_type", "question_type", "question_id", "primary_object", "scene_id", "pattern_name", "camera_pose_idx", "answer_text", "answer_value", "mc_source_type", "room", "camera_yaw", "image", "image_path", "batch_no"]


def _micros(column: str, name: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp")).alias(name)


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """The records' own table: all that is not nested, times in microseconds."""
    columns = [*PLAIN, "created_at", "ingested_at"]
    flat = nested.flat_table(table(spark, d, "questions").select("q_row", *columns), ["q_row"], columns)
    return flat.select("q_row", *PLAIN, _micros("created_at", "created_us"), _micros("ingested_at", "ingested_us"))


def p1_poses(spark: SparkSession, d: str) -> DataFrame:
    """The poses' table, one row a record; vectors as coordinates (`p1_records_whole` has them as arrays of any length)."""
    flat = nested.flat_table(table(spark, d, "questions").select("q_row", "camera_pose"), ["q_row"], ["camera_pose"])
    return flat.select("q_row", "camera_pose_yaw", "camera_pose_pitch", "camera_pose_radius", *_axes("camera_pose_position", "position"), *_axes("camera_pose_target", "target"))


def p1_objects(spark: SparkSession, d: str) -> DataFrame:
    """The objects' table; vectors as coordinates (`p1_objects_whole` has them as arrays of any length)."""
    flat = nested.flat_table(table(spark, d, "questions"), ["q_row"], ["objects"], "objects")
    vectors = [c for v in ("center", "dims", "aabb_min", "aabb_max") for c in _axes(v, v)]
    return flat.select("q_row", "objects_pos", "present", "id", "label", "room_index", "volume", *vectors)


def p1_target_links(spark: SparkSession, d: str) -> DataFrame:
    """Each pose target with the position of the object that it names; -1 if it names none."""
    return p1_found(spark, d).where("child_kind = 'target'").select("q_row", F.col("child_pos").alias("camera_pose_target_objects_pos"), F.col("link_pos").alias("objects_pos"))


def p1_records_whole(spark: SparkSession, d: str) -> DataFrame:
    """The records' own table with every column that is not repeated; vectors stay arrays of any length."""
    q = table(spark, d, "questions")
    return nested.flat_table(q, ["q_row"], [c for c in q.columns if c != "q_row"])


def p1_objects_whole(spark: SparkSession, d: str) -> DataFrame:
    """The objects' table with every column; vectors stay arrays of any length."""
    return nested.flat_table(table(spark, d, "questions"), ["q_row"], ["objects"], "objects")


def p1_pose_targets(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_table(table(spark, d, "questions"), ["q_row"], ["camera_pose"], "camera_pose.target_objects")


def p1_choices(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_table(table(spark, d, "questions"), ["q_row"], ["choices"], "choices")


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    q = table(spark, d, "questions")
    refs = F.array(
        F.struct(F.lit("image_path").alias("ref_table"), path_key(F.col("image_path")).alias("ref_key")),
        F.struct(F.lit("camera_pose_idx").alias("ref_table"), pose_key(F.col("scene_id"), F.col("pattern_name"), F.col("camera_pose_idx")).alias("ref_key")),
    )
    children = q.select(F.col("q_row").alias("child_id"), F.col("ingested_at").alias("at"), F.explode(refs).alias("r")).select("child_id", "at", "r.ref_table", "r.ref_key")
    images = table(spark, d, "rendered_images").select(F.lit("image_path").alias("ref_table"), path_key(F.col("image_path")).alias("ref_key"), "arrived_at", "removed_at")
    poses = table(spark, d, "camera_poses").select(F.lit("camera_pose_idx").alias("ref_table"), pose_key(F.col("scene_id"), F.col("pattern_name"), F.col("pose_idx")).alias("ref_key"), "arrived_at", "removed_at")
    return children, images.unionByName(poses)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(*_references(spark, d)).select(F.col("child_id").alias("q_row"), F.col("ref_table").alias("ref_field"), "reason")


def p3_orphans_by_month(spark: SparkSession, d: str) -> DataFrame:
    found = orphans.orphan_counts(orphans.orphan_references(*_references(spark, d)))
    return found.select(F.col("ref_table").alias("ref_field"), F.date_format("month", "yyyy-MM").alias("month"), "reason", "orphans")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return compaction.line_fates(table(spark, d, "small_files")).where(F.col("fate") != "keep")


def p6_broken(spark: SparkSession, d: str) -> DataFrame:
    """The lines of p6_found that are not one complete JSON object."""
    return p6_found(spark, d).where(F.col("fate") == "broken").select("file_id", "line_no")


def p6_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Consolidates the files into the shared folder and returns the manifest, without the files' random names."""
    out = scratch_dir(spark, "compacted")
    made = compaction.compact(spark, table(spark, d, "small_files"), out, target_bytes=8 << 20)
    return made.select("out_group", "files", "records", "bytes")


QUERIES = {f.__name__: f for f in (p1_found, p1_records, p1_poses, p1_objects, p1_target_links, p1_records_whole, p1_objects_whole, p1_pose_targets, p1_choices, p3_found, p3_orphans_by_month, p6_found, p6_broken, p6_manifest)}
