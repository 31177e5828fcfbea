"""The batch runs fit together: what one writes the next one reads."""

import json

import pytest

from roomweave import __main__ as run
from roomweave.sources import readers, sinks


def box(x, y, z, dx, dy, dz):
    return [{"x": x + i * dx, "y": y + j * dy, "z": z + k * dz} for i in (0, 1) for j in (0, 1) for k in (0, 1)]


ROOM = {"rooms": [{"floor": [[0, 0], [8, 0], [8, 8], [0, 8]]}], "walls": []}
THINGS = [("sofa", box(1, 1, 0, 2, 1, 0.8)), ("table", box(4, 1.2, 0, 1.4, 1, 0.75)), ("bed", box(3, 4, 0, 2, 1.6, 0.6)), ("cabinet", box(6, 5, 0, 1, 1, 1.2))]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("houses")
    for name, things in (("0001_000001", THINGS), ("0002_000002", THINGS[:1])):
        (base / name).mkdir()
        (base / name / "labels.json").write_text(json.dumps([{"ins_id": str(i), "label": w, "bounding_box": b} for i, (w, b) in enumerate(things, 1)]))
        (base / name / "structure.json").write_text(json.dumps(ROOM))
    return base


def test_generate_render_and_dashboard(spark, root, tmp_path):
    out = tmp_path / "out"
    assert run.main(["generate", "--scenes-root", f"file://{root}", "--output", f"file://{out}", "--max-objects", "3"]) == 0
    summary = json.loads((out / "generation_summary.json").read_text())
    assert summary["scenes_skipped"] == ["0002_000002"] and summary["scenes_processed"] == 1 and summary["failed"] == []
    q = readers.questions(spark, f"file://{out}")
    assert 0 < q.count() == summary["total_questions"]
    for pattern in ("around", "spherical", "linear", "rotation"):
        meta = json.loads((out / pattern / "0001_000001/metadata.json").read_text())
        lines = (out / pattern / "0001_000001/questions.jsonl").read_text().splitlines()
        assert meta["num_questions"] == len(lines) and meta["num_focus_objects"] == 3 == len(meta["focus_objects"]) and meta["num_cameras"] in (2, 3)
        assert meta["question_types"] == sorted({json.loads(x)["question_type"] for x in lines})
    some = q.where("camera_pose_idx = 0 AND pattern_name = 'rotation'").first()
    if some:
        (out / "rotation/0001_000001/images").mkdir()
        (out / "rotation/0001_000001/images/pose_0000.png").write_bytes(b"png")
    assert run.main(["render-tasks", "--data", f"file://{out}", "--output", f"file://{tmp_path}/tasks"]) == 0
    assert run.main(["render-tasks", "--data", f"file://{out}", "--output", f"file://{tmp_path}/updated", "--update-only"]) == 0
    back = readers.questions(spark, f"file://{tmp_path}/updated")
    assert back.count() == q.count() and (not some or back.where("image_path is not null").count() > 0)
    assert run.main(["dashboard", "--data", f"file://{out}", "--output", f"file://{tmp_path}/site"]) == 0
    assert json.loads(spark.read.text(f"file://{tmp_path}/site/dashboard").first().value)["summary"]["total_questions"] == q.count()
    assert spark.read.json(f"file://{tmp_path}/site/chunk_manifest").where("num_focus_objects = 3").count() > 0


def test_library_dataset(spark, root, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"camera_sampling": {"move_pattern": "rotation", "rotation_interval": 90.0}, "question_config": {"enabled_question_types": ["object_size", "relative_size", "mc"]}, "max_questions_per_scene": 60}))
    out = tmp_path / "data"
    assert run.main(["library", "--scenes-root", f"file://{root}", "--output", f"file://{out}", "--config", f"file://{tmp_path}/c.json"]) == 0
    meta = json.loads((out / "metadata.json").read_text())
    q = spark.read.json(f"file://{out}/questions.jsonl")
    assert meta["total_questions"] == q.count() > 0 and meta["num_scenes"] == 2 and sum(meta["question_type_stats"].values()) == q.count() and meta["config"]["max_questions_per_scene"] == 60
    both = [spark.read.json(f"file://{out}/{c}/all_{c}.jsonl").count() if (out / c / f"all_{c}.jsonl").exists() else 0 for c in ("mc", "numerical")]
    assert sum(both) == q.count()
    assert spark.read.json(f"file://{out}/numerical/object_size/questions.jsonl").count() == q.where("question_type = 'object_size'").count()
    assert len((out / "0001_000001/questions.jsonl").read_text().splitlines()) == q.where("scene_id = '0001_000001'").count()
    assert (out / "0001_000001/numerical/object_size/questions.jsonl").exists() and spark.read.json(f"file://{out}/scene_stats").count() == 2


def test_a_hot_scene_is_written_by_several_tasks(spark, small, tmp_path, monkeypatch):
    q = spark.read.parquet(f"{small}/questions.parquet").where("scene_id rlike '^[0-9]{4}_[0-9]{6}$'").select("pattern_name", "scene_id", "question_id", "question", "answer", "choices", "mc_source_type")
    monkeypatch.setattr(sinks, "FILE_ROWS", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the test's rows would fit one task
    try:
        sinks.write_questions(q, f"file://{tmp_path}/parts")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    n = sinks.publish_scene_files(spark, f"file://{tmp_path}/parts", f"file://{tmp_path}/data")
    assert n > q.select("pattern_name", "scene_id").distinct().count()
    assert readers.questions(spark, f"file://{tmp_path}/data").count() == q.count()
