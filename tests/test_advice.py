import numpy as np

import __spark_entry__ as entry
from roomweave.config import Cameras
from roomweave.operators import compaction, screen
from roomweave.plans import library, reference
from tests.oracle import connect, rows


def test_spans_are_the_masks_pixels():
    r = np.random.default_rng(3)
    some = lambda: np.clip(r.normal(r.uniform(0, 64), r.choice([0.5, 3, 20, 60]), (r.integers(1, 9), 2)), 0, 63)
    for _ in range(300):
        own, over = some(), [some() for _ in range(r.integers(0, 7))]
        masks = [screen.mask(o, 64, 64) for o in over]
        hidden = screen.mask(own, 64, 64) & np.logical_or.reduce([np.zeros((64, 64), bool), *masks])
        assert screen.pixels(screen.spans(own)) == screen.mask(own, 64, 64).sum()
        assert screen.pixels_under(screen.spans(own), [piece for o in over for piece in screen.spans(o)]) == hidden.sum()


def test_covered_area_is_measured_on_whole_images(spark, small, monkeypatch):
    asked = []
    monkeypatch.setattr(screen, "covered_area", lambda *a, **k: asked.append(a[3] if len(a) > 3 else k.get("cfg") or Cameras()))
    reference.QUERIES["covered_area"](spark, small)
    assert (asked[0].image_width, asked[0].image_height) == (512, 512)


def test_library_rotation_makes_all_turns(spark, small, monkeypatch):
    asked = []
    monkeypatch.setattr(library, "rotation_questions", lambda labels, structure, camera=None, *a, **k: asked.append(camera or Cameras()) or spark.createDataFrame([], "scene_id string, room string, camera_yaw double, camera_pose_idx int, question_type string, question_id string, answer string"))
    reference.QUERIES["library_rotation_questions"](spark, small)
    assert asked[0] == Cameras() and 360 / asked[0].rotation_interval == 72


def test_flat_tables_keep_every_column(spark, small):
    duck = connect(small)
    pose = ("position", "target", "yaw", "pitch", "radius")
    flat = [c[0] for c in duck.execute("SELECT * FROM questions LIMIT 0").description if c[0] not in ("objects", "camera_pose", "choices")]
    fields = ("id", "label", "center", "dims", "aabb_min", "aabb_max", "room_index", "volume")
    has = " OR ".join(f"o.{f} IS NOT NULL" for f in fields)
    want = {
        "p1_records_whole": f"SELECT {', '.join(flat)}, {', '.join(f'camera_pose.{f} AS camera_pose_{f}' for f in pose)} FROM questions",
        "p1_objects_whole": f"WITH e AS (SELECT q_row, unnest(range(0, len(objects))) AS p, unnest(objects) AS o FROM questions) SELECT q_row, CAST(p AS INTEGER) AS objects_pos, ({has}) AS present, {', '.join(f'o.{f} AS {f}' for f in fields)} FROM e",
    }
    for name, sql in want.items():
        got, expected = entry.queries()[name](spark, small), duck.execute(sql)
        columns = [c[0] for c in expected.description]
        assert sorted(got.columns) == sorted(columns)
        assert rows(got.columns, got.collect()) == rows(columns, expected.fetchall())


def test_numbers_are_told_apart_by_every_digit():
    d = lambda n: compaction.digest(f'{{"a": {n}}}')
    long = "1." + "3" * 40
    assert d(long) != d(long + "1") and d(long) == d(long + "00") and d("1e1000000") is not None
    assert len({d("100"), d("1e2"), d("1.00E+2"), d("1000e-1")}) == 1 and d("0") == d("-0.0e5") and d("-1") != d("1") and d("10") != d("1")
