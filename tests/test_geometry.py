import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomweave.functions import geometry as g
from roomweave.functions import naming
from roomweave.operators import visibility

ROOMS = [[[-1.0, -1.0], [5.0, -1.0], [5.0, 2.0], [-1.0, 2.0]], [[-1.0, 2.0], [5.0, 2.0], [5.0, 5.0], [-1.0, 5.0]]]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def v3(*x):
    return g.lits(*x)


def test_ray_and_box(spark):
    def ray(o, d, lo, hi):
        first, last, hit = g.ray_box(v3(*o), v3(*d), v3(*lo), v3(*hi))
        return tuple(spark.range(1).select(first, last, hit).first())

    assert ray((0, 0, 0), (1, 0, 0), (2, -1, -1), (3, 1, 1)) == (2.0, 3.0, True)
    assert ray((0, 0, 0), (-1, 0, 0), (2, -1, -1), (3, 1, 1))[2] is False
    assert ray((0, 0, 0), (1, 0, 0), (2, 4, -1), (3, 6, 1))[2] is False
    assert ray((0, 0, 0), (1, 0, 0), (-1, -1, -1), (1, 1, 1)) == (-1.0, 1.0, True)


def test_projection(spark):
    k = g.intrinsics(512, 512, 60.0)
    assert k[0] == pytest.approx(443.4050067376326)
    row = spark.sql("SELECT 0D px, 0D py, 1D pz, 1D tx, 0D ty, 1D tz")
    df = g.with_view(row)
    at = lambda *p: df.select(*(c.alias(n) for n, c in zip("uvz", g.project(g.to_view(v3(*p), g.vec("p"), g.axes_of_view()), k), strict=True))).first()
    assert (at(2, 0, 1).u, at(2, 0, 1).v) == (256.0, 256.0)
    assert at(2, 0.5, 1).u == pytest.approx(366.8512516844082)
    assert at(2, 0, 1.5).v == pytest.approx(366.8512516844082)
    assert at(-1, 0, 1).u is None


def test_view_is_rigid(spark):
    rng = np.random.default_rng(3)
    rows = [tuple(map(float, rng.uniform(-5, 5, 9))) for _ in range(400)]
    df = spark.createDataFrame(rows, "px double, py double, pz double, tx double, ty double, tz double, qx double, qy double, qz double")
    got = g.with_view(df).select("*", *(c.alias(f"w{i}") for i, c in enumerate(g.to_view(g.vec("q"), g.vec("p"), g.axes_of_view())))).collect()
    for r in got:
        p, t, q = (np.array([r[f"{n}{a}"] for a in "xyz"]) for n in "ptq")
        forward = (t - p) / np.linalg.norm(t - p)
        right = np.cross(forward, [0, 0, 1])
        right /= np.linalg.norm(right)
        m = np.eye(4)
        m[:3, 0], m[:3, 1], m[:3, 2], m[:3, 3] = -right, np.cross(right, forward), forward, p
        assert np.allclose([r.w0, r.w1, r.w2], (np.linalg.inv(m) @ [*q, 1])[:3], atol=1e-9)


def test_camera_space(spark):
    turn = lambda yaw, pitch: tuple(round(value(spark, c), 9) + 0.0 for c in g.to_camera_space(v3(1, 2, 3), F.lit(float(yaw)), F.lit(float(pitch))))
    assert turn(90, 0) == (-3, 2, 1)
    assert turn(0, 90) == (1, -3, 2)
    rng = np.random.default_rng(4)
    for _ in range(10):
        yaw, pitch = rng.uniform(-180, 180, 2)
        w, p = math.radians(yaw), math.radians(-pitch)
        ry = np.array([[math.cos(w), 0, math.sin(w)], [0, 1, 0], [-math.sin(w), 0, math.cos(w)]])
        rx = np.array([[1, 0, 0], [0, math.cos(p), -math.sin(p)], [0, math.sin(p), math.cos(p)]])
        want = np.linalg.inv(rx @ ry) @ [1, 2, 3] if False else np.linalg.inv(ry) @ np.linalg.inv(rx) @ [1, 2, 3]
        assert np.allclose(turn(yaw, pitch), want, atol=1e-8)


def test_boxes(spark):
    a, b = (v3(0, 0, 0), v3(1, 0.5, 1)), (v3(2, 0, 0), v3(4, 1, 0.75))
    assert value(spark, g.box_gap(*a, *b)) == 1.0
    assert value(spark, g.box_gap(*b, *a)) == 1.0
    assert value(spark, g.box_overlap(*a, *b)) == 0.0
    assert value(spark, g.box_overlap(v3(0, 0, 0), v3(2, 2, 2), v3(1, 1, 1), v3(2, 2, 2))) == 1.0
    assert value(spark, g.box_overlap(v3(0, 0, 0), v3(0, 1, 1), v3(0, 0, 0), v3(1, 1, 1))) == 0.0


def test_polygons(spark):
    df = spark.createDataFrame([(0.5, 0.25), (1.0, 3.5), (9.0, 9.0)], "x double, y double")
    rooms = F.array(*(F.array(*(F.array(*(F.lit(c) for c in p)) for p in room)) for room in ROOMS))
    first = [[r.a, r.b] for r in df.select(g.in_polygon(F.col("x"), F.col("y"), rooms[0]).alias("a"), g.in_polygon(F.col("x"), F.col("y"), rooms[1]).alias("b")).collect()]
    assert first == [[True, False], [False, True], [False, False]]
    assert value(spark, g.polygon_area(rooms[0])) == 18.0
    assert value(spark, g.boundary_distance(F.lit(0.0), F.lit(0.0), rooms[0])) == 1.0
    empty = F.array().cast("array<array<double>>")
    assert value(spark, g.in_polygon(F.lit(0.0), F.lit(0.0), empty)) is False
    assert value(spark, g.polygon_area(F.lit(None).cast("array<array<double>>"))) == 0.0
    assert value(spark, g.segment_distance(*(F.lit(float(x)) for x in (3, 4, 0, 0, 0, 0)))) == 5.0


def test_names(spark):
    df = spark.createDataFrame([("  Coffee Table (Big)! ",), ("***",), ("café",)], "n string")
    assert [r.v for r in df.select(naming.sanitize(F.col("n")).alias("v")).collect()] == ["coffee_table_big", "unknown", "café"]
    assert value(spark, naming.pose_image(F.lit(7))) == "pose_0007.png"
    assert value(spark, naming.view_image(F.array(F.lit("Sofa"), F.lit("Bed")), F.lit(2))) == "bed_sofa_2.png"
    assert value(spark, naming.rotation_image(F.lit("Living Room"), F.lit(359.6))) == "living_room_000deg.png"


def test_rounding_is_half_even_on_the_scaled_value(spark):
    assert [value(spark, g.round2(F.lit(x))) for x in (0.125, 2.5155764746872635, 0.5)] == [0.12, 2.52, 0.5]


def test_occlusion_by_a_wall(spark):
    look = "px double, py double, pz double, tx double, ty double, tz double, "
    seen = spark.createDataFrame([("s", 1, "t", 0.0, 0.0, 1.0, 4.0, 0.0, 1.0, 4.0, -0.5, 0.5, 5.0, 0.5, 1.5)], "scene_id string, pose_row int, id string, " + look + "x0 double, y0 double, z0 double, x1 double, y1 double, z1 double")
    box = "scene_id string, id string, label string, x0 double, y0 double, z0 double, x1 double, y1 double, z1 double"
    wall = spark.createDataFrame([("s", "wall_0", "wall", 2.0, -3.0, 0.0, 2.1, 3.0, 3.0)], box)
    side = spark.createDataFrame([("s", "wall_0", "wall", 2.0, 2.0, 0.0, 2.1, 3.0, 3.0)], box)
    hidden = visibility.occlusion(seen, wall, ["scene_id", "pose_row", "id"], walls_only=True).first()
    assert (hidden.hidden_points, hidden.center_hidden, hidden.occluded) == (9, True, True)
    free = visibility.occlusion(seen, side, ["scene_id", "pose_row", "id"]).first()
    assert (free.hidden_points, free.occluded) == (0, False)
    assert visibility.visible_corners(seen).first().corners == 8
    assert visibility.unhidden_corners(seen, wall, ["scene_id", "pose_row", "id"]).first().corners == 0
