"""The batch generator: from labels and structures of scenes to question records, one lazy plan over all scenes."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomweave.config import MAIN_CAMERAS, MAIN_QUESTIONS, MAX_FOCUS_OBJECTS, MIN_FOCUS_OBJECTS, PATTERNS, Cameras, Questions, Selection
from roomweave.operators import cameras, questions, rollup, scenes, selection
from roomweave.session import durable


def focus(labels: DataFrame, structure: DataFrame, cfg: Selection | None = None, most: int = MAX_FOCUS_OBJECTS, least: int = MIN_FOCUS_OBJECTS) -> DataFrame:
    return selection.gated(selection.focus_objects(selection.single_objects(scenes.objects_of(labels, structure), cfg), most), least)


def poses_of(pattern: str, count: int, sub_pattern: str | None, items: DataFrame, scene_ids: DataFrame, structure: DataFrame, boxes: DataFrame, occluders: DataFrame, cfg: Cameras) -> DataFrame:
    """(scene_id, item, seq, pose, pose columns) of a pattern: pose is dense per scene by first appearance of position and target."""
    if pattern == "rotation":
        centers = scenes.room_centers(structure).join(scene_ids, "scene_id", "left_semi")
        turned = cameras.strided(cameras.rotation_poses(centers, boxes, cfg))
        return turned.join(items.select("scene_id", "item"), "scene_id").select("scene_id", "item", F.col("pose").alias("seq"), "pose", *cameras.POSE, F.array().cast("array<string>").alias("target_labels"))
    own = dataclasses.replace(cfg, linear_sub_pattern=sub_pattern or cfg.linear_sub_pattern)
    found = cameras.sample_poses(pattern, items, count, boxes, scenes.room_polygons(structure), scenes.bounds(structure), occluders, own)
    return cameras.dense_index(found, ["px", "py", "pz", "tx", "ty", "tz"], ["scene_id"], ["item", "seq"], "pose").select("scene_id", "item", "seq", "pose", *cameras.POSE, F.transform("targets", lambda t: t["label"]).alias("target_labels"))


def generate(labels: DataFrame, structure: DataFrame, patterns: tuple = PATTERNS, select: Selection | None = None, camera: Cameras = MAIN_CAMERAS, question: Questions = MAIN_QUESTIONS, per_scene: int | None = None, most: int = MAX_FOCUS_OBJECTS, least: int = MIN_FOCUS_OBJECTS) -> DataFrame:
    """All questions of all scenes and patterns, with nested objects and poses."""
    chosen = durable(focus(labels, structure, select, most, least))
    pairs = durable(selection.focus_pairs(chosen))
    boxes = durable(scenes.all_objects(labels, structure).join(chosen.select("scene_id").distinct(), "scene_id", "left_semi"))
    hiding = scenes.occluders(labels, structure)
    items = durable(cameras.items_of(chosen, pairs))
    scene_ids = chosen.select("scene_id").distinct()
    parts = []
    for pattern, count, sub in patterns:
        poses = durable(poses_of(pattern, count, sub, items, scene_ids, structure, boxes, hiding, camera).withColumn("pattern_name", F.lit(pattern)))
        each = poses.dropDuplicates(["scene_id", "pose"]).select("scene_id", "pose", F.struct(*cameras.POSE, "target_labels").alias("camera"))
        poses = durable(poses.join(each, ["scene_id", "pose"]))  # the pose of a question's number goes along, so that questions meet nothing further
        single, pair = cameras.singles(poses), cameras.of_pairs(poses)
        multi = poses if pattern == "rotation" else poses.where(F.col("pose") < 3 * count)
        parts.append(questions.for_poses(chosen, pairs, single, pair, multi, question, keep=("camera",)))
    made = parts[0]
    for p in parts[1:]:
        made = made.unionByName(p)
    if per_scene:
        made = questions.capped(made, per_scene)
    volume = selection.measures()["volume"]
    body = F.struct("id", "label", F.array("cx", "cy", "cz").alias("center"), F.array("dx", "dy", "dz").alias("dims"), F.array("x0", "y0", "z0").alias("aabb_min"), F.array("x1", "y1", "z1").alias("aabb_max"), "room_index", volume.alias("volume"))
    known = chosen.select("scene_id", F.struct("rank", body.alias("o")).alias("r")).groupBy("scene_id").agg(F.map_from_entries(F.collect_list("r")).alias("known"))  # the focus objects of a scene
    out = made.select("*", "camera.*").drop("camera").join(known, "scene_id").withColumn("objects", F.transform("object_ranks", lambda r: F.col("known")[r]))
    return out.withColumn("camera_pose", cameras.pose_struct(F.col("target_labels"))).withColumn("camera_pose_idx", F.col("pose")).drop("known", "object_ranks", "target_labels", *cameras.POSE)




def runs(labels: DataFrame, structure: DataFrame, made: DataFrame, patterns: tuple = PATTERNS, select: Selection | None = None, most: int = MAX_FOCUS_OBJECTS, least: int = MIN_FOCUS_OBJECTS) -> DataFrame:
    """The metadata of every run, a scene that passes the gate under one pattern, those without questions included.

    made (scene_id, pattern_name, question_type) are the questions that were written.
    """
    chosen = durable(focus(labels, structure, select, most, least))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("rank", "label"))), lambda r: r["label"])  # at most `most` a scene
    per_scene = chosen.groupBy("scene_id").agg(in_order.alias("focus_objects"), F.count(F.lit(1)).cast("int").alias("num_focus_objects"))
    pairs = selection.focus_pairs(chosen).groupBy("scene_id").agg(F.count(F.lit(1)).cast("int").alias("num_focus_pairs"))
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("pattern_name"), F.lit(n).alias("num_cameras")) for p, n, _ in patterns)))
    planned = per_scene.join(pairs, "scene_id", "left").select("*", each.alias("p")).select("scene_id", "p.*", "focus_objects", "num_focus_objects", F.coalesce("num_focus_pairs", F.lit(0)).alias("num_focus_pairs"))
    counted = rollup.run_metadata(made).withColumn("num_questions", F.col("num_questions").cast("int"))
    return planned.join(counted, ["scene_id", "pattern_name"], "left").withColumns({"num_questions": F.coalesce("num_questions", F.lit(0)), "question_types": F.coalesce("question_types", F.array().cast("array<string>"))})
