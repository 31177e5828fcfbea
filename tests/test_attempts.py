"""Attempts by arrays against the plans of visibility, and what hopeless items cost."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from roomweave.config import MAIN_CAMERAS, Cameras
from roomweave.operators import attempts, cameras, scenes, selection, visibility
from roomweave.plans import generate

TRIES = 60


def parts(spark, small):
    labels, structure = (spark.read.parquet(f"{small}/{t}.parquet").where("scene_id <= (SELECT sort_array(collect_set(scene_id))[3] FROM s)") for t in ("scene_labels", "scene_structure"))
    focus = generate.focus(labels, structure)
    items = cameras.items_of(focus, selection.focus_pairs(focus)).localCheckpoint()
    return items, scenes.all_objects(labels, structure).localCheckpoint(), scenes.room_polygons(structure), scenes.bounds(structure), scenes.occluders(labels, structure).localCheckpoint()


@pytest.mark.parametrize(("pattern", "skip"), [("around", True), ("around", False), ("spherical", True), ("linear", True)])
def test_attempts_are_those_that_the_plans_accept(spark, small, pattern, skip):
    spark.read.parquet(f"{small}/scene_structure.parquet").createOrReplaceTempView("s")
    items, boxes, rooms, bounds, occluders = parts(spark, small)
    line = pattern == "linear"
    cfg = Cameras(max_tries=TRIES if line else TRIES // 10, skip_occlusion_check=skip)
    key = ["scene_id", "item", "attempt", "step"]
    every = cameras.aimed(items, cfg).withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(TRIES - 1))))
    poses = visibility.valid_positions(cameras.GENERATORS[pattern](every, cfg), key, boxes, rooms, bounds, cfg)
    looks = poses.select(*key, *cameras.POSE, F.posexplode("targets").alias("place", "o")).select(*key, *cameras.POSE, "place", F.col("o.id").alias("id"), *(F.col(f"o.{a}{n}").alias(f"{a}{n}") for a in "xyz" for n in (0, 1)))
    shown = visibility.in_fov(looks, cfg, center=not line, border=0 if line else 5).localCheckpoint()
    each = [*key, "place", "id"]
    if skip:
        clear = visibility.occlusion(shown, occluders, each, walls_only=True, threshold=0.7 if line else 0.5).where("NOT occluded")
    else:
        clear = visibility.unhidden_corners(shown, occluders, each, cfg).where(F.col("corners") >= cfg.min_visible_corners)
    good = {}
    for r in clear.groupBy("scene_id", "item", "attempt").count().collect():
        needed = (2 if r.item >= cameras.PAIR_ITEMS else 1) * (cfg.linear_num_steps if line else 1)
        if r["count"] == needed:
            good.setdefault((r.scene_id, r.item), []).append(r.attempt)
    want = {(s, i, a) for (s, i), found in good.items() for a in sorted(found)[:1]}
    got = cameras.sample_poses(pattern, items, 1, boxes, rooms, bounds, occluders, cfg)
    assert {(r.scene_id, r.item, r.attempt) for r in got.collect()} == want and want


def test_hopeless_items_need_no_further_jobs(spark):
    box = "x0 double, y0 double, z0 double, x1 double, y1 double, z1 double"
    t = "struct<id: string, label: string, x0: double, y0: double, z0: double, x1: double, y1: double, z1: double>"
    apart = [("a", "bed", -9.0, 0.0, 0.0, -8.5, 1.0, 1.0), ("b", "sofa", 0.0, 0.0, 90.0, 1.0, 1.0, 91.0)]
    items = spark.createDataFrame([("s", 0, apart)], f"scene_id string, item bigint, targets array<{t}>")
    none = spark.createDataFrame([], f"scene_id string, id string, label string, {box}")
    rooms = spark.createDataFrame([("s", [])], "scene_id string, polygons array<array<array<double>>>")
    spark.sparkContext.setJobGroup("hopeless", "hopeless")
    try:
        found = cameras.sample_poses("around", items, 3, none, rooms, spark.createDataFrame([], f"scene_id string, {box}"), none, Cameras(skip_occlusion_check=True, max_tries=100))
        assert found.count() == 0
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("hopeless")) < 20
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("given", [{}, {"skip_occlusion_check": False}, {"check_wall_occlusion": False}, {"image_width": 640, "image_height": 480, "max_distance": 2.5}])
def test_cells_leave_out_no_accepted_attempt(spark, small, monkeypatch, given):
    spark.read.parquet(f"{small}/scene_structure.parquet").createOrReplaceTempView("s")
    items, boxes, rooms, bounds, occluders = parts(spark, small)
    cfg = dataclasses.replace(MAIN_CAMERAS, **given)
    rows = [r.asDict(recursive=True) for r in cameras._by_scene(cameras.aimed(items, cfg), boxes, rooms, bounds, occluders).collect()]
    with_cells = attempts.accepted([attempts.Scene(r) for r in rows], "spherical", 3, 3000, 42, cfg)
    monkeypatch.setattr(attempts, "LOOK", 1 << 40)
    without = attempts.accepted([attempts.Scene(r) for r in rows], "spherical", 3, 3000, 42, cfg)
    assert with_cells == without and max(a for *_, a in without) >= 100


def test_pairs_that_no_place_shows_use_up_few_attempts(monkeypatch):
    near = {"id": "a", "box": [0.0, 0.0, 0.0, 1.0, 1.0, 1.0]}
    beside = {"id": "b", "box": [2.6, 0.0, 0.0, 3.6, 1.0, 1.0]}
    wall = {"id": "wall_0", "is_wall": True, "box": [1.75, -9.0, 0.0, 1.85, 9.0, 2.8]}
    far = {"id": "c", "box": [0.0, 8.0, 0.0, 1.0, 9.0, 1.0]}
    item = lambda n, *t: {"item": n, "ox": sum(o["box"][0] + o["box"][3] for o in t) / 4, "oy": sum(o["box"][1] + o["box"][4] for o in t) / 4, "oz": 0.5, "height": 1.2, "targets": list(t)}
    scene = {"scene_id": "s", "items": [item(0, near, beside), item(1, near, far)], "boxes": [o["box"] for o in (near, beside, wall, far)], "bounds": None, "polygons": None, "occluders": [wall]}
    made, uniform = [], attempts.uniform
    monkeypatch.setattr(attempts, "uniform", lambda names, who, attempt: made.append(len(who)) or uniform(names, who, attempt))
    assert attempts.accepted([attempts.Scene(scene)], "spherical", 3, 3000, 42, MAIN_CAMERAS) == []
    assert sum(made) < 3 * 2 * 100
