"""The library pipeline: all valid objects of a scene instead of a few focus objects, and questions on what each pose shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomweave.config import Cameras, Pipeline, Questions, Selection
from roomweave.operators import cameras, questions, scenes, selection, visibility
from roomweave.session import durable, spread, written

BOX = [f"{a}{n}" for a in "xyz" for n in (0, 1)]


def _ranked(objects: DataFrame) -> DataFrame:
    return objects.withColumn("rank", F.col("ord"))


def rotation_questions(labels: DataFrame, structure: DataFrame, camera: Cameras | None = None, question: Questions | None = None, select: Selection | None = None) -> DataFrame:
    """For every turn in every room, questions on the objects that it shows, with `room` and `camera_yaw`."""
    camera = camera or Cameras()
    objects = durable(_ranked(selection.single_objects(scenes.objects_of(labels, structure), select)))
    boxes = scenes.all_objects(labels, structure)
    turned = cameras.rotation_poses(scenes.room_centers(structure), boxes, camera)
    poses = cameras.dense_index(turned, ["px", "py", "pz", "tx", "ty", "tz"], ["scene_id"], ["room_idx", "angle_idx"], "pose")
    poses = poses.withColumns({"pattern_name": F.lit("rotation"), "room": F.concat(F.lit("room_"), F.col("room_idx").cast("string")), "camera_yaw": F.col("yaw")})
    keep = ("room", "camera_yaw")
    view = ["scene_id", "pattern_name", "pose", *cameras.POSE, *keep]
    shown = visibility.visible_objects(spread(poses.select(view), "scene_id"), objects.select("scene_id", *questions.KEEP, *BOX), camera)
    # A row a pose with what it shows: all questions are made within it, without a further join.
    posed = written(questions.together(shown, view))
    side = lambda o, x: [o[c].alias(f"{x}_{c}") for c in questions.KEEP]
    first = posed.select("*", F.posexplode("seen").alias("_at", "_a"))
    single = first.select(*view, F.col("_a.rank").alias("item"), *side(F.col("_a"), "a"))
    both = first.select(*view, "_a", F.explode(F.slice("seen", F.col("_at") + 2, F.size("seen"))).alias("_b"))
    pair = both.select(*view, F.xxhash64("_a.rank", "_b.rank").alias("item"), *side(F.col("_a"), "a"), *side(F.col("_b"), "b"))
    return questions.of_rows(single, pair, posed, question, keep).withColumn("camera_pose_idx", F.col("pose"))


def object_questions(labels: DataFrame, structure: DataFrame, pattern: str, camera: Cameras | None = None, question: Questions | None = None, select: Selection | None = None) -> DataFrame:
    """Poses around every valid object and every valid pair, questions on them, samples on what the first poses show."""
    camera = camera or Cameras()
    all_boxes = durable(scenes.all_objects(labels, structure))
    objects = durable(_ranked(selection.single_objects(scenes.objects_of(labels, structure), select)))
    pairs = durable(selection.valid_pairs(_ranked(all_boxes), 100, select).withColumns({"a_rank": F.col("a_ord"), "b_rank": F.col("b_ord")}))
    items = cameras.items_of(objects, pairs)
    hiding = scenes.occluders(labels, structure)
    n = camera.num_cameras_per_item
    found = cameras.sample_poses(pattern, items, n, all_boxes, scenes.room_polygons(structure), scenes.bounds(structure), hiding, camera)
    poses = durable(cameras.dense_index(found, ["px", "py", "pz", "tx", "ty", "tz"], ["scene_id"], ["item", "seq"], "pose").withColumn("pattern_name", F.lit(pattern)))
    view = ["pattern_name", "pose", *cameras.POSE]
    first = poses.where(F.col("pose") < 3 * n)
    shown = visibility.visible_objects(first.select("scene_id", *view).distinct(), objects.select("scene_id", "rank", "id", *BOX), camera)
    seen = objects.join(shown.select("scene_id", "rank", *view), ["scene_id", "rank"])
    made = questions.for_poses(objects, pairs, cameras.singles(poses), cameras.of_pairs(poses), first, question, seen)
    return made.withColumn("camera_pose_idx", F.col("pose"))


def run(labels: DataFrame, structure: DataFrame, cfg: Pipeline) -> DataFrame:
    """Questions of all chosen scenes under one configuration: pattern, caps and least number of views."""
    if cfg.scene_list:
        labels, structure = (d.where(F.col("scene_id").isin(*cfg.scene_list)) for d in (labels, structure))
    pattern = cfg.camera_sampling.move_pattern
    if pattern == "rotation":
        made = rotation_questions(labels, structure, cfg.camera_sampling, cfg.question_config, cfg.object_selection)
    else:
        made = object_questions(labels, structure, pattern, cfg.camera_sampling, cfg.question_config, cfg.object_selection)
    made = questions.capped(made, cfg.max_questions_per_scene)
    return questions.enough_views(made, cfg.min_views_required) if pattern in ("around", "spherical") else made


