import numpy as np
import pytest

from roomweave.config import Cameras, Pipeline, Questions
from roomweave.operators import screen
from roomweave.plans import library


def test_hulls_and_masks():
    square = np.array([[0, 0], [4, 0], [4, 4], [0, 4], [2, 2], [4, 4]], float)
    assert screen.hull_area(square) == 16.0 and len(screen.hull(square)) == 4
    assert screen.hull_area(square[:2]) == 0.0
    assert screen.mask(square, 8, 8).sum() == 25 and screen.mask(square[:1], 8, 8).sum() == 1


def test_nearer_boxes_cover(spark):
    look = "px double, py double, pz double, tx double, ty double, tz double, "
    box = "x0 double, y0 double, z0 double, x1 double, y1 double, z1 double"
    seen = spark.createDataFrame([("s", 1, "t", 0.0, 0.0, 1.0, 4.0, 0.0, 1.0, 4.0, -0.5, 0.5, 5.0, 0.5, 1.5)], "scene_id string, pose_row int, id string, " + look + box)
    near = spark.createDataFrame([("s", "o", 2.0, -3.0, 0.0, 2.1, 3.0, 3.0), ("s", "t", 4.0, -0.5, 0.5, 5.0, 0.5, 1.5), ("s", "behind", 8.0, -3.0, 0.0, 9.0, 3.0, 3.0)], "scene_id string, id string, " + box)
    r = screen.covered_area(seen, near, ["scene_id", "pose_row", "id"], Cameras(image_width=64, image_height=64)).first()
    assert r.target_px > 0 and r.ratio_of_target == 1.0
    free = screen.covered_area(seen, near.where("id <> 'o'"), ["scene_id", "pose_row", "id"], Cameras(image_width=64, image_height=64)).first()
    assert free.covered_px == 0.0 and free.visible_px == r.target_px
    area = screen.projected_area(seen).first()
    assert area.area == pytest.approx((443.4050067376326 / 4) ** 2, rel=1e-6)


def test_rotation_run(spark, small):
    labels, structure = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("scene_labels", "scene_structure"))
    scene = labels.selectExpr("min(scene_id) AS s").first().s
    cfg = Pipeline(scene_list=[scene], max_questions_per_scene=40, camera_sampling=Cameras(move_pattern="rotation", rotation_interval=60.0), question_config=Questions(enabled_question_types=("object_size", "relative_distance", "object_pair_distance_center")))
    rows = library.run(labels, structure, cfg).collect()
    assert 0 < len(rows) <= 40 and {r.scene_id for r in rows} == {scene} and all(r.room.startswith("room_") and r.camera_yaw % 60 == 0 for r in rows)


def test_questions_of_a_pose_need_no_shuffle(spark, small):
    """Once it is known what each pose shows, no row of a question leaves its task."""
    labels, structure = (spark.read.parquet(f"{small}/{t}.parquet").where("scene_id < '1000'") for t in ("scene_labels", "scene_structure"))
    made = library.rotation_questions(labels, structure, Cameras(rotation_interval=120.0))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Scan parquet" in plan
