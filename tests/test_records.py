import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roomweave.functions import normalize as n
from roomweave.functions.skew import skew_left_join
from roomweave.operators import compaction, nested, orphans
from roomweave.plans.records import LINKS

SCHEMA = "id long, present int, objects array<struct<id:string,label:string,center:array<double>>>, camera_pose struct<target_objects:array<string>>, choices map<string,string>"


def one(spark, column, *values):
    return [r.v for r in spark.createDataFrame([(v,) for v in values], "c string").select(column(F.col("c")).alias("v")).collect()]


def test_keys(spark):
    assert one(spark, n.scene_key, "0417_950417", " 417-950417/", "Scene 0417__950417", "0417950417", "x", None) == ["0417_950417"] * 4 + ["x", None]
    assert one(spark, n.scan_key, "SC0000001", "scan sc 000 0001", "Scan/sc-0000001 ", "none", "SC12", "", None) == ["SC0000001"] * 3 + [None] * 4
    assert one(spark, n.id_key, "Mc-Object_size_3_width", "\tmc_object_size_3_width​", None) == ["mc_object_size_3_width"] * 2 + [None]
    assert one(spark, n.category_key, "Object Size", " object-size ", "(A)", "a.", "-0.5", "--", "", None) == ["object_size", "object_size", "a", "a", "-0.5", None, None, None]
    assert one(spark, n.path_key, "a/b_c/images/p.png", "/a/b_c//images/./p.png ", "x/../a%2Fb_c\\images\\p.png", "../a/100%", " ", None) == ["a/b_c/images/p.png"] * 3 + ["a/100%", None, None]


def test_skewed_join_keeps_all_rows(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("4", 2), ("none", 3)], "k string, v int")
    got = skew_left_join(rows, lookup, "k", least=100)
    assert got.count() == 3000 and got.where("v = 1").count() == 1000 and got.where("v = 2").count() == 1


@pytest.fixture(scope="module")
def nested_rows(spark):
    rows = [
        (1, 7, [("a ", "Bed", [1.0]), None, (None, None, None), ("a", "bed", None), (None, "Sofa", None)], (["bed ", None, " ", "crib", "SOFA"],), {"A": "x"}),
        (2, 7, None, None, None), (3, 7, [], ([],), {}), (4, 7, [("a ", "x" * 50_000, None)], (None,), {"A": None}), (4, 7, [("b", "", None)], (["b"],), None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_links(nested_rows):
    got = sorted(map(tuple, nested.child_links(nested_rows, "id", ["objects", "camera_pose"], LINKS).collect()))
    assert got == [(1, "object", 0, 0), (1, "object", 3, 0), (1, "object", 4, 4), (1, "target", 0, 0), (1, "target", 3, -1), (1, "target", 4, 4), (4, "object", 0, 0), (4, "object", 0, 0), (4, "target", 0, -1)]


def test_flat_tables(nested_rows, spark):
    objects = nested.flat_table(nested_rows, ["id"], ["objects"], "objects").orderBy("id", "objects_pos").collect()
    assert [(r.id, r.objects_pos, r.present, r.objects_id) for r in objects][:5] == [(1, 0, True, "a "), (1, 1, False, None), (1, 2, False, None), (1, 3, True, "a"), (1, 4, True, None)] and len(objects) == 7
    assert nested.flat_table(nested_rows, ["id"], ["choices"], "choices").count() == 2
    numbers = nested.flat_table(nested_rows, ["id"], ["objects"], "objects.center", split_vectors=True).collect()
    assert [(r.id, r.objects_pos, r.objects_center_pos, r.value) for r in numbers] == [(1, 0, 0, 1.0)]
    root = nested.flat_table(nested_rows, ["id"], ["present"], "")
    assert root.columns == ["id", "present"] and root.count() == 5
    assert nested.flat_table(spark.createDataFrame([], SCHEMA), ["id"], ["objects"], "objects").count() == 0
    with pytest.raises(ValueError, match="no repeated ancestor"):
        nested.flat_table(nested_rows, ["id"], ["objects"], "nothing")


def day(d, h=0):
    return datetime(2024, 1, d, h)


def test_orphans(spark):
    parents = spark.createDataFrame([("t", "a", day(2), day(4)), ("t", "a", day(6), None), ("t", "b", None, None), ("t", "c", day(3), day(3)), ("t", None, day(1), None), ("u", "z", day(1), None), ("u", "z", day(1), None)], "ref_table string, ref_key string, arrived_at timestamp, removed_at timestamp")
    asked = [("a", day(1)), ("a", day(2)), ("a", day(3, 5)), ("a", day(4)), ("a", day(5)), ("a", day(6)), ("b", day(9)), ("c", day(9)), ("z", day(9)), (None, day(1)), ("a", None), ("nope", None)]
    children = spark.createDataFrame([("t", k, i, t) for i, (k, t) in enumerate(asked)] + [("u", "z", 90, day(9))], "ref_table string, ref_key string, child_id long, at timestamp")
    got = {r.child_id: r.reason for r in orphans.orphan_references(children, parents).collect()}
    assert got == {0: "late", 3: "deleted", 4: "deleted", 6: "late", 7: "deleted", 8: "missing", 10: "late", 11: "missing"}
    assert orphans.orphan_references(children.limit(0), parents).count() == 0
    assert orphans.orphan_references(children, parents.limit(0)).where("reason = 'missing'").count() == 12


def test_orphans_of_a_hot_key_and_time(spark):
    parents = spark.createDataFrame([("t", "hot", day(2), day(3)), ("t", "hot", day(4), None)], "ref_table string, ref_key string, arrived_at timestamp, removed_at timestamp")
    children = spark.range(20_000).select(F.lit("t").alias("ref_table"), F.lit("hot").alias("ref_key"), F.col("id").alias("child_id"), F.when(F.col("id") < 15_000, F.lit(day(3, 7))).otherwise(F.lit(day(4, 7))).alias("at"))
    got = orphans.orphan_references(children, parents)
    assert got.count() == got.where("reason = 'deleted' AND child_id < 15000").count() == 15_000
    # however many references a key and time has, the windows see one row of them
    sizes = orphans.long_form(children, parents).groupBy(*orphans.GROUP, "t").count()
    assert sizes.count() == 5


BODY = "﻿{\"a\": 1.0, \"b\": [\"é\"]}\r\n\n{\"b\": [\"\\u00e9\"], \"a\": 1}\n{\"a\": NaN}\n[1]\n{\"a\": 1} {\"a\": 2}\n{\"a\": \"1\"}"


@pytest.fixture(scope="module")
def files(spark):
    rows = [(1, BODY, "x"), (2, None, "x"), (3, "", "x"), (4, "{\"a\": 10e-1, \"b\": [\"é\"]}\n  \r\n{\"c\": -94.980}", "x"), (5, "{\"c\": -94.98}\n{\"c\": true}\n{\"c\": {\"#\": \"1\"}}\n{\"c\": 1}\n{\"tru", "x")]
    return spark.createDataFrame(rows, "file_id long, body string, fate string")


def test_line_fates(files):
    got = {(r.file_id, r.line_no): r.fate for r in compaction.line_fates(files).collect() if r.fate != "keep"}
    assert got == {(1, 3): "repeat", (1, 4): "broken", (1, 5): "broken", (1, 6): "broken", (4, 1): "repeat", (5, 1): "repeat", (5, 5): "broken"}


def test_longest_first():
    got = compaction.longest_first([(1, 5), (2, 4), (3, 3), (4, 3), (5, 3)], 2)
    assert compaction.longest_first([(True, 7, 5), (False, 7, 5)], 2) == [(False, 7, 0), (True, 7, 1)]
    loads = {g: sum(s for f, s in [(1, 5), (2, 4), (3, 3), (4, 3), (5, 3)] if dict(got)[f] == g) for g in (0, 1)}
    assert sorted(loads.values()) == [8, 10] and len(got) == 5


def test_schedule_is_balanced_whatever_the_number_of_files(spark):
    for n in (50, 5000):
        table = spark.range(n).select(F.col("id").alias("file_id"), F.repeat(F.lit("x"), (F.col("id") % 40 + F.when(F.col("id") % 25 == 0, 400).otherwise(0)).cast("int")).alias("body"))
        placed, groups = compaction.schedule(table, target_bytes=2000)
        loads = [r.n for r in placed.groupBy("out_group").agg(F.sum(F.length("body")).alias("n")).collect()]
        assert placed.count() == n and len(loads) == groups and max(loads) <= 1.25 * sum(loads) / groups


def test_compaction_round_trip(spark, files, tmp_path):
    out = f"file://{tmp_path}/out"
    manifest = compaction.compact(spark, files, out, target_bytes=60).collect()
    assert len(manifest) > 1
    got = sorted(json.dumps(json.loads(r.record), sort_keys=True) for r in compaction.read_compacted(spark, out).collect())
    kept = ['{"a": "1"}', '{"a": 1.0, "b": ["\\u00e9"]}', '{"c": -94.98}', '{"c": 1}', '{"c": true}', '{"c": {"#": "1"}}']
    assert got == sorted(kept)
    one = next((tmp_path / "out").glob("data-*/*.parquet"))
    one.with_name("group-unlisted.parquet").write_bytes(one.read_bytes())
    assert compaction.read_compacted(spark, out).count() == len(kept)
    with pytest.raises(FileExistsError):
        compaction.compact(spark, files, out)
    twice = compaction.compact(spark, files.unionByName(files.where("file_id > 3")), f"file://{tmp_path}/twice", target_bytes=60)
    assert sum(r.records for r in twice.collect()) == len(kept)
    nameless = spark.createDataFrame([(None, '{"a": 1}'), (None, '{"a": 2'), (None, '{"a": 1}\n{"a": 3}'), (7, '{"a": 1}'), (None, None)], "file_id long, body string")
    assert sum(r.records for r in compaction.compact(spark, nameless, f"file://{tmp_path}/nameless").collect()) == 2
    assert len(list((tmp_path / "out").glob("data-*"))) == 1 and not list((tmp_path / "out").glob("_manifest.tmp"))
    broken = spark.createDataFrame([(1, "{}", 0), (1, "{}", 0)], "file_id long, body string, x int").select((F.col("file_id") / 0).alias("file_id"), F.raise_error(F.lit("lost")).alias("body"))
    with pytest.raises(Exception, match="lost|ZERO"):
        compaction.compact(spark, broken, f"file://{tmp_path}/fails")
    assert not list((tmp_path / "fails").glob("data-*"))
    empty = compaction.compact(spark, files.limit(0), f"file://{tmp_path}/none")
    assert empty.count() == 0 and compaction.read_compacted(spark, f"file://{tmp_path}/none").count() == 0
