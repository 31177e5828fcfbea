import json

from roomweave.streaming import arrivals


def _write(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_redeliveries_over_runs(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    record = {"scene_id": "0001_000001", "pattern_name": "around", "camera_pose_idx": 0, "question_id": "object_size_1_width", "question_type": "object_size", "ingested_at": "2024-01-01T10:00:00"}
    _write(source, "a.json", [record, record | {"question_id": "Object-Size-1-Width"}, record | {"scene_id": None}, record | {"scene_id": None}])

    def run():
        rows = arrivals.first_deliveries(arrivals.arriving(spark, f"file://{source}"))
        arrivals.append(rows.select("record", "scene_id", "ingested_at"), f"file://{tmp_path}/out", f"file://{tmp_path}/state").start().awaitTermination()
        return spark.read.parquet(f"file://{tmp_path}/out")

    assert run().count() == 3
    _write(source, "b.json", [record | {"scene_id": "scene 1-000001", "ingested_at": "2024-01-02T10:00:00"}, record | {"question_id": "object_size_2_width", "ingested_at": "2024-01-02T10:00:00"}])
    assert run().count() == 4


def test_daily_counts(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    _write(source, "a.json", [{"question_type": "mc", "ingested_at": f"2024-01-{d:02d}T10:00:00"} for d in (1, 1, 2, 20)])
    counts = arrivals.daily_counts(arrivals.arriving(spark, f"file://{source}"))
    q = counts.writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((str(r.day)[:10], r.n) for r in spark.table("days").collect()) == [("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-20", 1)]
