"""Queries of the scene, question and statistics operators over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomweave.config import MAIN_CAMERAS, MAIN_QUESTIONS, Cameras, Selection
from roomweave.functions import geometry as g
from roomweave.functions import naming
from roomweave.operators import cameras, questions, rollup, scenes, screen, selection, visibility
from roomweave.plans import generate as generator
from roomweave.plans import library
from roomweave.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STRICT = Selection(enable_dim_filter=True, enable_volume_filter=True, enable_aspect_ratio_filter=True)
TYPES = ["mc", "object_comparison_absolute_distance", "object_comparison_relative_distance", "object_distance_to_camera", "object_pair_distance_center", "object_pair_distance_center_w_size", "object_pair_distance_vector", "object_size", "object_size_comparison_absolute", "object_size_comparison_relative", "relative_distance", "relative_distance_to_camera", "relative_size"]
SPLIT = ["around", "linear", "rotation", "spherical"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _labels(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scene_labels")


def _structure(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "scene_structure")


def _objects(s: SparkSession, d: str) -> DataFrame:
    return scenes.objects_of(_labels(s, d), _structure(s, d))


def _focus(s: SparkSession, d: str) -> DataFrame:
    return generator.focus(_labels(s, d), _structure(s, d))


def _poses(s: SparkSession, d: str) -> DataFrame:
    """Complete camera poses, one row each."""
    p = table(s, d, "camera_poses")
    full = (F.size(F.filter("camera_pose.position", lambda v: v.isNotNull())) == 3) & (F.size(F.filter("camera_pose.target", lambda v: v.isNotNull())) == 3)
    return p.where(full).select("scene_id", "pose_row", "pattern_name", "pose_idx", *(c.alias(n) for n, c in cameras.read_pose(F.col("camera_pose")).items()))


def _seen(s: SparkSession, d: str) -> DataFrame:
    return _poses(s, d).join(_focus(s, d).select("scene_id", "id", "label", *(f"{a}{n}" for a in "xyz" for n in (0, 1))), "scene_id")


# -- scenes ------------------------------------------------------------------------------------------------------------


@query
def scan_objects(s: SparkSession, d: str) -> DataFrame:
    return scenes.parse_objects(_labels(s, d))


@query
def obb_dims(s: SparkSession, d: str) -> DataFrame:
    return scenes.parse_objects(_labels(s, d)).select("scene_id", "ord", *(c.alias(n) for n, c in selection.measures().items()))


@query
def point_in_polygon_room(s: SparkSession, d: str) -> DataFrame:
    return _objects(s, d).select("scene_id", "ord", "room_index")


@query
def room_centers(s: SparkSession, d: str) -> DataFrame:
    return scenes.room_centers(_structure(s, d))


@query
def room_areas(s: SparkSession, d: str) -> DataFrame:
    rooms = scenes.room_polygons(_structure(s, d)).select("scene_id", F.posexplode("polygons").alias("room_idx", "p"))
    return rooms.select("scene_id", "room_idx", g.polygon_area(F.col("p")).alias("area"))


@query
def object_room_boundary(s: SparkSession, d: str) -> DataFrame:
    """How far each object's centre is from its room's outline."""
    o = _objects(s, d).where(F.col("room_index").isNotNull()).join(scenes.room_polygons(_structure(s, d)), "scene_id")
    return o.select("scene_id", "ord", "room_index", g.boundary_distance(F.col("cx"), F.col("cy"), F.col("polygons")[F.col("room_index")]).alias("dist"))


@query
def walls_to_aabb(s: SparkSession, d: str) -> DataFrame:
    return scenes.walls(_structure(s, d))


@query
def walls_to_aabb_camera(s: SparkSession, d: str) -> DataFrame:
    return scenes.walls(_structure(s, d), "cameras")


@query
def objects_and_walls(s: SparkSession, d: str) -> DataFrame:
    return scenes.all_objects(_labels(s, d), _structure(s, d)).groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "wall").alias("walls"), F.max("z1").alias("top"))


@query
def scene_bounds(s: SparkSession, d: str) -> DataFrame:
    return scenes.bounds(_structure(s, d))


# -- selection ---------------------------------------------------------------------------------------------------------


@query
def filter_blacklist(s: SparkSession, d: str) -> DataFrame:
    return _objects(s, d).where(selection.reject_reason() == "ok").select("scene_id", "ord", "id", "label")


@query
def filter_geometric_reason(s: SparkSession, d: str) -> DataFrame:
    return scenes.parse_objects(_labels(s, d)).select("scene_id", "ord", selection.reject_reason(STRICT).alias("reason"))


@query
def label_unique_room(s: SparkSession, d: str) -> DataFrame:
    return selection.single_objects(_objects(s, d)).select("scene_id", "ord", "id", "label", "room_index")


@query
def focus_top5(s: SparkSession, d: str) -> DataFrame:
    return selection.focus_objects(selection.single_objects(_objects(s, d))).select("scene_id", "rank", "id", "label", "volume")


@query
def focus_min_gate(s: SparkSession, d: str) -> DataFrame:
    return _focus(s, d).select("scene_id", "rank", "id")


@query
def scene_gate(s: SparkSession, d: str) -> DataFrame:
    objects = _objects(s, d)
    return selection.gate_report(objects, selection.focus_objects(selection.single_objects(objects)))


@query
def pairs_valid_capped(s: SparkSession, d: str) -> DataFrame:
    return selection.valid_pairs(_objects(s, d)).select("scene_id", "pair_ord", "a_ord", "b_ord")


@query
def pair_reject_reasons(s: SparkSession, d: str) -> DataFrame:
    return selection.joined(_objects(s, d)).groupBy("scene_id", selection.pair_reason().alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query
def triples_valid_capped(s: SparkSession, d: str) -> DataFrame:
    return selection.valid_triples(_objects(s, d))


@query
def focus_pairs_oriented(s: SparkSession, d: str) -> DataFrame:
    return selection.focus_pairs(_focus(s, d)).select("scene_id", "pair_ord", "turned", "a_id", "b_id")


def _sides(p: str) -> list[g.Vec]:
    return [tuple(F.col(f"{p}_{a}{n}") for a in "xyz") for n in (0, 1)]


@query
def aabb_gap(s: SparkSession, d: str) -> DataFrame:
    return selection.joined(_objects(s, d)).select("scene_id", "a_ord", "b_ord", g.box_gap(*_sides("a"), *_sides("b")).alias("gap"))


@query
def aabb_overlap(s: SparkSession, d: str) -> DataFrame:
    return selection.joined(_objects(s, d)).select("scene_id", "a_ord", "b_ord", g.box_overlap(*_sides("a"), *_sides("b")).alias("ratio"))


@query
def center_distances(s: SparkSession, d: str) -> DataFrame:
    return selection.joined(_objects(s, d)).select("scene_id", "a_ord", "b_ord", g.distance(tuple(F.col(f"a_c{a}") for a in "xyz"), tuple(F.col(f"b_c{a}") for a in "xyz")).alias("dist"))


@query
def scene_statistics(s: SparkSession, d: str) -> DataFrame:
    return selection.scene_statistics(_objects(s, d), scenes.room_polygons(_structure(s, d)))


@query
def label_histogram(s: SparkSession, d: str) -> DataFrame:
    return selection.label_histogram(_objects(s, d))


# -- cameras -----------------------------------------------------------------------------------------------------------


@query
def camera_height(s: SparkSession, d: str) -> DataFrame:
    return _focus(s, d).groupBy("scene_id").agg(F.max("z1").alias("top")).select("scene_id", cameras.camera_height(F.col("top"), Cameras()).alias("height"))


def _rotation(s: SparkSession, d: str) -> DataFrame:
    boxes = scenes.all_objects(_labels(s, d), _structure(s, d))
    return cameras.rotation_poses(scenes.room_centers(_structure(s, d)), boxes, MAIN_CAMERAS)


@query
def rotation_poses(s: SparkSession, d: str) -> DataFrame:
    return _rotation(s, d).select("scene_id", "room_idx", "angle_idx", "px", "py", "pz", "yaw", *(F.rint(F.col(c) * 1e6).alias(c) for c in ("tx", "ty")))


@query
def rotation_stride6(s: SparkSession, d: str) -> DataFrame:
    return cameras.strided(_rotation(s, d)).select("scene_id", "pose", "room_idx", "angle_idx")


@query
def position_valid_anti(s: SparkSession, d: str) -> DataFrame:
    st = _structure(s, d)
    boxes = scenes.all_objects(_labels(s, d), st)
    return visibility.valid_positions(_poses(s, d), ["pose_row"], boxes, scenes.room_polygons(st), scenes.bounds(st)).select("scene_id", "pose_row")


@query
def ray_box_hits(s: SparkSession, d: str) -> DataFrame:
    """Rays from each camera along its look against all boxes of its scene."""
    p = _poses(s, d).withColumns({f"v{a}": F.col(f"t{a}") - F.col(f"p{a}") for a in "xyz"})
    both = p.join(_objects(s, d).select("scene_id", "ord", *(f"{a}{n}" for a in "xyz" for n in (0, 1))), "scene_id")
    first, last, hit = g.ray_box(g.vec("p"), g.vec("v"), *visibility.box())
    return both.where(hit).select("pose_row", "ord", first.alias("enter"), last.alias("leave"))


@query
def wall_occlusion_ratio(s: SparkSession, d: str) -> DataFrame:
    return visibility.occlusion(_seen(s, d), scenes.occluders(_labels(s, d), _structure(s, d)), ["scene_id", "pose_row", "id"], walls_only=True)


@query
def object_occlusion_ratio(s: SparkSession, d: str) -> DataFrame:
    return visibility.occlusion(_seen(s, d), scenes.occluders(_labels(s, d), _structure(s, d)), ["scene_id", "pose_row", "id"])


@query
def fov_center_visible(s: SparkSession, d: str) -> DataFrame:
    return visibility.with_projection(_seen(s, d)).select("pose_row", "id", visibility.fov_reason().alias("reason"))


@query
def visible_corner_count(s: SparkSession, d: str) -> DataFrame:
    return visibility.visible_corners(_seen(s, d)).select("pose_row", "id", "corners")


@query
def unhidden_corner_count(s: SparkSession, d: str) -> DataFrame:
    return visibility.unhidden_corners(_seen(s, d), scenes.occluders(_labels(s, d), _structure(s, d)), ["scene_id", "pose_row", "id"])


@query
def visible_objects(s: SparkSession, d: str) -> DataFrame:
    return visibility.visible_objects(_poses(s, d), _focus(s, d).select("scene_id", "id", *(f"{a}{n}" for a in "xyz" for n in (0, 1)))).select("pose_row", "id")


@query
def visible_pairs(s: SparkSession, d: str) -> DataFrame:
    seen = visibility.visible_objects(_poses(s, d), _focus(s, d).select("scene_id", "rank", "id", *(f"{a}{n}" for a in "xyz" for n in (0, 1)))).select("pose_row", "rank", "id")
    a, b = (seen.select("pose_row", F.col("rank").alias(f"{x}_rank"), F.col("id").alias(f"{x}_id")) for x in "ab")
    return a.join(b, "pose_row").where(F.col("a_rank") < F.col("b_rank")).select("pose_row", "a_id", "b_id")


@query
def projected_centers(s: SparkSession, d: str) -> DataFrame:
    milli = lambda c: F.rint(F.col(c) * 1000.0)
    at = visibility.with_projection(_seen(s, d))
    return at.select("pose_row", "id", *(milli(f"{c}{visibility.CENTER}").alias(n) for c, n in (("u", "u"), ("v", "v"), ("w", "z"))))


@query
def render_matrices(s: SparkSession, d: str) -> DataFrame:
    axes = g.with_render_axes(_poses(s, d))
    return axes.select("pose_row", *(F.rint(F.col(f"{n}_{a}") * 1e6).alias(f"{n}_{a}") for n in ("right", "down", "forward") for a in "xyz"))


@query
def projected_area(s: SparkSession, d: str) -> DataFrame:
    return screen.projected_area(_seen(s, d)).select("pose_row", "id", F.rint("area").alias("area"))


@query
def covered_area(s: SparkSession, d: str) -> DataFrame:
    return screen.covered_area(_seen(s, d), scenes.occluders(_labels(s, d), _structure(s, d)), ["scene_id", "pose_row", "id"], Cameras())


@query
def all_targets_in_fov(s: SparkSession, d: str) -> DataFrame:
    seen = visibility.all_in_fov(_seen(s, d), ["pose_row"])
    return seen.select("pose_row", "all_visible", F.size("failures").alias("failed"))


@query
def sampled_poses_around(s: SparkSession, d: str) -> DataFrame:
    return _sampled(s, d, "around")


@query
def sampled_poses_spherical(s: SparkSession, d: str) -> DataFrame:
    return _sampled(s, d, "spherical")


@query
def sampled_poses_linear(s: SparkSession, d: str) -> DataFrame:
    return _sampled(s, d, "linear")


def _sampled(s: SparkSession, d: str, pattern: str) -> DataFrame:
    st = _structure(s, d)
    boxes = scenes.all_objects(_labels(s, d), st)
    focus = _focus(s, d)
    items = cameras.items_of(focus, selection.focus_pairs(focus))
    return cameras.sample_poses(pattern, items, 3, boxes, scenes.room_polygons(st), scenes.bounds(st), scenes.occluders(_labels(s, d), st), MAIN_CAMERAS).select("scene_id", "item", "seq", *cameras.POSE)


# -- questions ---------------------------------------------------------------------------------------------------------


def _single(s: SparkSession, d: str) -> DataFrame:
    a = _focus(s, d).select("scene_id", *(F.col(c).alias(f"a_{c}") for c in questions.KEEP))
    return a


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return selection.joined(_focus(s, d), "rank", questions.KEEP)


def _on_poses(objects: DataFrame, s: SparkSession, d: str) -> DataFrame:
    return objects.join(_poses(s, d).drop("pattern_name"), "scene_id")


@query
def q_object_size(s: SparkSession, d: str) -> DataFrame:
    return questions.object_size(_single(s, d)).select("scene_id", "question_id", "value", "answer", "question")


@query
def q_distance_to_camera(s: SparkSession, d: str) -> DataFrame:
    return questions.distance_to_camera(_on_poses(_single(s, d), s, d)).select("pose_row", "question_id", "value", "answer")


@query
def q_size_ratio(s: SparkSession, d: str) -> DataFrame:
    return questions.size_ratio(_pairs(s, d)).select("scene_id", "question_id", "value", "answer", "question")


@query
def q_size_absolute(s: SparkSession, d: str) -> DataFrame:
    return questions.size_absolute(_pairs(s, d)).select("scene_id", "question_id", "value", "answer", "question")


@query
def q_pair_distance(s: SparkSession, d: str) -> DataFrame:
    return questions.pair_distance(_pairs(s, d)).select("scene_id", "question_id", "value", "answer", "question")


@query
def q_pair_distance_w_size(s: SparkSession, d: str) -> DataFrame:
    return questions.pair_distance_sized(_pairs(s, d)).select("scene_id", "question_id", "value", "answer", "question")


@query
def q_pair_vector(s: SparkSession, d: str) -> DataFrame:
    """Vectors in thousandths: sines differ in their last bit between engines."""
    p = _on_poses(_pairs(s, d), s, d)
    v = g.to_camera_space(tuple(F.col(f"b_c{a}") - F.col(f"a_c{a}") for a in "xyz"), F.col("yaw"), F.col("pitch"))
    return p.select("pose_row", "a_id", "b_id", *(F.rint(c * 1e3 + 1e-7).alias(f"v{a}") for a, c in zip("xyz", v, strict=True)))


def _fours(s: SparkSession, d: str) -> DataFrame:
    """The first four focus objects of each scene, in order, as a, b, x, y."""
    f = _focus(s, d)
    at = lambda k: F.max(F.when(F.col("rank") == k, F.struct(*questions.KEEP)))
    four = f.groupBy("scene_id").agg(*(at(k).alias(r) for k, r in enumerate("abxy"))).where(F.col("y").isNotNull())
    return four.select("scene_id", *(F.col(r)[c].alias(f"{r}_{c}") for r in "abxy" for c in questions.KEEP))


@query
def q_multi_abs(s: SparkSession, d: str) -> DataFrame:
    return questions.multi_absolute(_fours(s, d)).select("scene_id", "question_id", "value", "answer", "question")


@query
def q_multi_ratio(s: SparkSession, d: str) -> DataFrame:
    return questions.multi_ratio(_fours(s, d)).select("scene_id", "question_id", "value", "answer", "question")


@query
def q_relative_size(s: SparkSession, d: str) -> DataFrame:
    return questions.relative_size(_pairs(s, d), ["scene_id"]).select("scene_id", "question_id", "answer_text", "answer", "question")


@query
def q_relative_distance(s: SparkSession, d: str) -> DataFrame:
    return questions.relative_distance(_fours(s, d), ["scene_id"]).select("scene_id", "question_id", "answer_text", "answer", "question")


@query
def q_relative_distance_camera(s: SparkSession, d: str) -> DataFrame:
    return questions.relative_distance_to_camera(_on_poses(_pairs(s, d), s, d), ["scene_id", "pose_row"]).select("pose_row", "question_id", "answer_text", "answer")


@query
def mc_choices(s: SparkSession, d: str) -> DataFrame:
    made = questions.multiple_choice(questions.pair_distance(_pairs(s, d)), ["scene_id"])
    return made.select("scene_id", "question_id", "answer_value", "answer", *(F.col("choices")[x].alias(f"choice_{x.lower()}") for x in "ABCD"))


def _letters(made: DataFrame, *scope: str) -> DataFrame:
    return made.select(*scope, "question_id", "answer_value", "answer", *(F.col("choices")[x].alias(f"choice_{x.lower()}") for x in "ABCD"))


@query
def mc_size_choices(s: SparkSession, d: str) -> DataFrame:
    return _letters(questions.multiple_choice(questions.object_size(_single(s, d)), ["scene_id"]), "scene_id")


@query
def mc_camera_choices(s: SparkSession, d: str) -> DataFrame:
    return _letters(questions.multiple_choice(questions.distance_to_camera(_on_poses(_single(s, d), s, d)), ["pose_row"]), "pose_row")


@query
def multi_object_draws(s: SparkSession, d: str) -> DataFrame:
    return questions.draws(_focus(s, d), ["scene_id"], "draw", 5).select("scene_id", "draw", "a_id", "b_id", "x_id", "y_id")


@query
def pivot_triples(s: SparkSession, d: str) -> DataFrame:
    return questions.pivots(_focus(s, d), ["scene_id"]).select("scene_id", "a_id", "b_id", "x_id")


@query
def generated_questions(s: SparkSession, d: str) -> DataFrame:
    made = generator.generate(_labels(s, d), _structure(s, d), question=MAIN_QUESTIONS)
    return made.select("scene_id", "pattern_name", "camera_pose_idx", "question_type", "question_id", "answer")


@query
def library_rotation_questions(s: SparkSession, d: str) -> DataFrame:
    """Questions on what each turn in a room shows, every 5 degrees."""
    made = library.rotation_questions(_labels(s, d), _structure(s, d), Cameras())
    return made.select("scene_id", "room", "camera_yaw", "camera_pose_idx", "question_type", "question_id", "answer")


# -- statistics --------------------------------------------------------------------------------------------------------


def _q(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "questions")


def _meta(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "run_metadata")


@query
def type_stats(s: SparkSession, d: str) -> DataFrame:
    return rollup.type_stats(_q(s, d))


@query
def cross_tab_counters(s: SparkSession, d: str) -> DataFrame:
    return rollup.counters(_q(s, d))


@query
def label_top100(s: SparkSession, d: str) -> DataFrame:
    return rollup.top_labels(_q(s, d))


@query
def yes_no_balance(s: SparkSession, d: str) -> DataFrame:
    return rollup.yes_no(_q(s, d))


@query
def choice_answers(s: SparkSession, d: str) -> DataFrame:
    return rollup.choice_answers(_q(s, d))


@query
def numeric_summary(s: SparkSession, d: str) -> DataFrame:
    return rollup.numeric_summary(_q(s, d))


@query
def histogram20(s: SparkSession, d: str) -> DataFrame:
    return rollup.histogram(_q(s, d))


@query
def pose_refs_distinct(s: SparkSession, d: str) -> DataFrame:
    return rollup.pose_references(_q(s, d))


@query
def heatmap_scene_pattern(s: SparkSession, d: str) -> DataFrame:
    return rollup.heatmap(_q(s, d).where(F.col("scene_id").isNotNull()), "scene_id", "pattern_name", SPLIT)


@query
def heatmap_pattern_type(s: SparkSession, d: str) -> DataFrame:
    return rollup.heatmap(_q(s, d), "pattern_name", "question_type", TYPES)


@query
def focus_labels(s: SparkSession, d: str) -> DataFrame:
    f = rollup.focus_labels(_meta(s, d))
    return f.select("scene_id", F.array_join("labels", "|").alias("labels"), "num_objects")


@query
def scene_overview(s: SparkSession, d: str) -> DataFrame:
    o = rollup.scene_overview(_q(s, d), _meta(s, d))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")
    return o.select("scene_id", "total_questions", "camera_pose_refs", text("by_pattern").alias("by_pattern"), text("by_type").alias("by_type"), F.coalesce("num_objects", F.lit(0)).alias("num_objects"))


@query
def category_split_counts(s: SparkSession, d: str) -> DataFrame:
    return rollup.category_split(_q(s, d)).groupBy("category", "sub").agg(F.count(F.lit(1)).alias("n"))


@query
def question_index(s: SparkSession, d: str) -> DataFrame:
    c = rollup.compact(_q(s, d).where(F.col("scene_id").isNotNull()))
    return c.withColumn("object_labels", F.array_join(F.transform("object_labels", lambda x: F.coalesce(x, F.lit("?"))), "|"))


@query
def chunk_manifest(s: SparkSession, d: str) -> DataFrame:
    return rollup.chunk_manifest(_q(s, d), _meta(s, d))


@query
def run_metadata(s: SparkSession, d: str) -> DataFrame:
    m = rollup.run_metadata(_q(s, d))
    return m.select("scene_id", "pattern_name", "num_questions", F.array_join("question_types", "|").alias("question_types"))


@query
def run_summary(s: SparkSession, d: str) -> DataFrame:
    return rollup.run_summary(_q(s, d))


@query
def min_views_semijoin(s: SparkSession, d: str) -> DataFrame:
    return questions.enough_views(_q(s, d), 2).select("q_row", "scene_id", "question_id")


@query
def scene_cap_prefix(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("scene_id").orderBy("q_row")
    return _q(s, d).where(F.col("scene_id").isNotNull()).withColumn("k", F.row_number().over(w)).where(F.col("k") <= 100).select("q_row", "scene_id", "k")


@query
def type_cap_prefix(s: SparkSession, d: str) -> DataFrame:
    q = _q(s, d).where(F.col("scene_id").isNotNull() & F.col("camera_pose_idx").isNotNull())
    return questions.first_of_type(q, ["scene_id", "pattern_name", "camera_pose_idx"], ["q_row"], 5).select("q_row", "scene_id", "question_type")


@query
def pose_index_dense(s: SparkSession, d: str) -> DataFrame:
    q = _q(s, d).where(F.col("scene_id").isNotNull() & F.col("camera_pose.position").isNotNull() & F.col("camera_pose.target").isNotNull())
    flat = q.select("q_row", "scene_id", "pattern_name", F.array_join("camera_pose.position", ",").alias("pos"), F.array_join("camera_pose.target", ",").alias("tgt"))
    return cameras.dense_index(flat, ["pos", "tgt"], ["scene_id", "pattern_name"], ["q_row"]).select("q_row", "scene_id", "pattern_name", "pose_idx")


@query
def first_pose_per_idx(s: SparkSession, d: str) -> DataFrame:
    q = _q(s, d).where(F.col("scene_id").isNotNull())
    return rollup.first_poses(q).select("scene_id", "pattern_name", "camera_pose_idx", "first_row", F.col("camera_pose.yaw").alias("yaw"))


@query
def view_counter(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "camera_poses").withColumn("labels", F.filter(F.coalesce("camera_pose.target_objects", F.array().cast("array<string>")), lambda t: t.isNotNull()))
    return rollup.view_counter(p, naming.object_key(F.col("labels"))).select("pose_row", "object_key", "view")


@query
def missing_images_anti(s: SparkSession, d: str) -> DataFrame:
    return rollup.missing_images(_q(s, d), table(s, d, "rendered_images"))


@query
def image_path_update(s: SparkSession, d: str) -> DataFrame:
    return rollup.with_image_paths(_q(s, d), table(s, d, "rendered_images")).select("q_row", "image_path")


@query
def question_images(s: SparkSession, d: str) -> DataFrame:
    """Questions with the image of their pose, where that is rendered; the first row of a path counts."""
    parts = F.regexp_extract_all("image_path", F.lit("^([^/]+)/([^/]+)/images/(pose_(\\d+)[.]png)$"), 0)
    images = table(s, d, "rendered_images").where(F.size(parts) == 1)
    part = lambda i: F.regexp_extract("image_path", "^([^/]+)/([^/]+)/images/(pose_(\\d+)[.]png)$", i)
    rendered = images.select(part(2).alias("scene_id"), part(1).alias("pattern_name"), part(4).cast("int").alias("camera_pose_idx"), part(3).alias("file")).distinct()
    return rollup.with_images(_q(s, d), rendered).select("q_row", "image")


@query
def sanitize_names(s: SparkSession, d: str) -> DataFrame:
    return _labels(s, d).where(F.col("label").isNotNull()).select("scene_id", "label_ord", naming.sanitize(F.col("label")).alias("name"))


@query
def json_props_extract(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))
