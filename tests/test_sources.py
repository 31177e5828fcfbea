import json

import pytest

from roomweave.operators import scenes
from roomweave.sources import readers, sinks

BOX = [{"x": x, "y": y, "z": z} for x in (0, 1) for y in (0, 1) for z in (0, 1)]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("scenes")
    for name, labels, structure in (("0001_000001", [{"ins_id": 7, "label": "Bed", "bounding_box": BOX}], {"rooms": [{"floor": [[0, 0], [2, 0], [2, 2]]}], "walls": [{"location": [[0, 0], [1, 0]]}]}), ("0002_000002", [{"id": "x", "label": "Bed", "bounding_box": BOX[:7]}], [{"polygon": [[0, 0], [2, 0], [2, 2]]}])):
        (base / name).mkdir()
        (base / name / "labels.json").write_text(json.dumps(labels))
        (base / name / "structure.json").write_text(json.dumps(structure))
    (base / "0001_000001" / "occupancy.json").write_text(json.dumps({"lower": [0, 0, 0], "max": [2, 2, 2]}))
    (base / "0003_000003").mkdir()
    (base / "0003_000003" / "structure.json").write_text("{damaged")
    return f"file://{base}"


def test_scene_folders(spark, root):
    assert [r.scene_id for r in readers.scenes(spark, root).collect()] == ["0001_000001", "0002_000002"]
    labels, structure = readers.labels(spark, root), readers.structures(spark, root)
    assert [(r.id, r.label, r.room_index) for r in scenes.objects_of(labels, structure).collect()] == [("7", "bed", None)] or scenes.objects_of(labels, structure).count() == 1
    rooms = {r.scene_id: len(r.polygons) for r in scenes.room_polygons(structure).collect()}
    assert rooms["0001_000001"] == 1 and rooms["0002_000002"] == 1 and rooms["0003_000003"] == 0
    assert scenes.walls(structure).count() == 1 and scenes.bounds(structure).first().x1 == 2.0
    with pytest.raises(FileNotFoundError):
        readers.labels(spark, f"{root}/nothing")


def test_question_round_trip(spark, small, tmp_path):
    q = spark.read.parquet(f"{small}/questions.parquet").where("scene_id rlike '^[0-9]{4}_[0-9]{6}$'")
    made = q.select("pattern_name", *(c for c in q.columns if c in readers.schemas.QUESTION and c != "pattern_name")).drop("created_at")
    sinks.write_questions(made, f"file://{tmp_path}/parts")
    n = sinks.publish_scene_files(spark, f"file://{tmp_path}/parts", f"file://{tmp_path}/data")
    back = readers.questions(spark, f"file://{tmp_path}/data")
    assert n == made.select("pattern_name", "scene_id").distinct().count()
    keys = ["pattern_name", "scene_id", "question_id", "answer"]
    assert sorted(map(str, back.select(keys).collect())) == sorted(map(str, made.select(keys).collect()))
    assert back.where("choices is not null").count() == made.where("choices is not null").count()


def test_dashboard(spark, small, tmp_path):
    q, meta = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("questions", "run_metadata"))
    sinks.write_dashboard(q, meta, f"file://{tmp_path}/site", ["mc", "object_size"])
    text = spark.read.text(f"file://{tmp_path}/site/dashboard").first().value
    assert json.loads(text)["summary"]["total_questions"] == q.count()
    sinks.write_categories(q, f"file://{tmp_path}/cats")
    assert readers.image_paths(spark, f"file://{tmp_path}/none").count() == 0
