import random

import pytest
from pyspark.sql import functions as F

from roomweave.llm import quota_sample, splits, stable_sample
from roomweave.llm.sql import ORACLE
from tests.oracle import connect, rows

Q = "q_row long, scene_id string, pattern_name string, camera_pose_idx int, question_id string, question_type string, answer_type string, answer string, batch_no int, category string"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, small, name):
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, small)
    want = connect(small).execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


def edges(spark, *pairs):
    return spark.createDataFrame(pairs, "a string, b string")


def test_components_of_a_chain_a_star_and_loops(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)]
    star = [("hub", f"leaf{i}") for i in range(50)]
    got = {r.node: r.root for r in splits.components(edges(spark, *chain, *star, ("x", "x"), ("y", None), ("n005", "n004"), ("n005", "n004"))).collect()}
    assert len(got) == 41 + 51
    assert {got[f"n{i:03d}"] for i in range(41)} == {"n000"} and {v for k, v in got.items() if k[0] in "hl"} == {"hub"}
    assert splits.components(edges(spark, ("a", "b")).limit(0)).count() == 0


def test_split_keeps_groups_and_shares(spark):
    data = [(f"e{i % 300:03d}" if i % 3 else "hot", "ab"[i % 2]) for i in range(6000)] + [(None, "a")] * 5
    rows_ = spark.createDataFrame(data, "entity string, stratum string").withColumn("k", F.monotonically_increasing_id())
    links = edges(spark, *((f"e{i:03d}", f"e{i + 1:03d}") for i in range(0, 300, 3)))
    ledger = splits.split_ledger(rows_, links)
    split = {r.node: (r.root, r.split) for r in ledger.collect()}
    assert all(split[f"e{i:03d}"] == split[f"e{i + 1:03d}"] for i in range(0, 300, 3))
    out = splits.split_of(rows_, ledger, "entity", F.col("k"))
    assert out.count() == 6005 and out.where("split is null").count() == 0
    shares = {r.split: r.share for r in splits.split_report(out).where("stratum = '*'").collect()}
    assert abs(shares["train"] - 0.8) < 0.03 and abs(shares["test"] - 0.1) < 0.03

    clash = splits.split_of(rows_.withColumns({"root": F.lit(1), "split": F.lit(2)}), ledger, "entity", F.col("k"))
    assert sorted(map(str, clash.select("k", "split").collect())) == sorted(map(str, out.select("k", "split").collect()))

    # A later batch: old entities keep their split, a merge over two splits is quarantined, new ones are placed.
    by = {}
    for node, (_root, s) in split.items():
        by.setdefault(s, []).append(node)
    a, b = by["train"][0], by["test"][0]
    more = rows_.unionByName(spark.createDataFrame([("new1", "a"), ("new2", "b")], "entity string, stratum string").withColumn("k", F.lit(0).cast("long")))
    later = {r.node: r.split for r in splits.split_ledger(more, edges(spark, (a, b), ("new1", by["validation"][0])), ledger).collect()}
    full = {r.node: r for r in splits.split_ledger(more, edges(spark, (a, b), ("new1", by["validation"][0])), ledger).collect()}
    assert later[a] == later[b] == splits.QUARANTINE and (full[a].held, full[b].held) == ("train", "test") and later["new1"] == "validation" and later["new2"] in {"train", "validation", "test"}
    touched = {split[a][0], split[b][0]}
    assert all(later[n] == s for n, (root, s) in split.items() if root not in touched)


def test_a_hot_hub_and_a_long_chain(spark, monkeypatch):
    from roomweave.functions import skew

    monkeypatch.setattr(skew.skew_left_join, "__defaults__", (skew.HOT_KEYS, 20, None))
    hub = [("zz", f"leaf{i:04d}") for i in range(400)] + [("aa", f"twig{i:04d}") for i in range(400)]
    chain = [(f"m{(i * 7919) % 300:03d}", f"m{((i + 1) * 7919) % 300:03d}") for i in range(299)]
    got = {r.node: r.root for r in splits.components(edges(spark, *hub, *chain)).collect()}
    assert {v for k, v in got.items() if k[:4] == "leaf" or k == "zz"} == {"leaf0000"} and {v for k, v in got.items() if k[:4] == "twig"} == {"aa"}
    assert {v for k, v in got.items() if k[0] == "m"} == {"m000"} and len(got) == 802 + 300


def test_batches_of_edges_give_the_same_components(spark):
    rng = random.Random(4)
    pairs = [(f"n{rng.randrange(200):03d}", f"n{rng.randrange(200):03d}") for _ in range(150)]
    known = None
    for at in range(0, 150, 50):
        known = splits.components(edges(spark, *pairs[at : at + 50]), known)
    strip = lambda df: {(r.node, r.root) for r in df.collect()}
    assert strip(known) == strip(splits.components(edges(spark, *pairs)))


def test_cells_are_placed_by_one_rule_whatever_their_number(spark):
    for n in (999, 1001, 3000):
        rows_ = spark.range(n * 4).select(F.concat(F.lit("e"), (F.col("id") % n).cast("string")).alias("entity"), F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("stratum"))
        ledger = splits.split_ledger(rows_, edges(spark, ("e1", "e2")))
        shares = {(r.stratum, r.split): r.share for r in splits.split_report(splits.split_of(rows_, ledger, "entity", F.lit(1))).collect()}
        assert all(abs(shares[s, "train"] - 0.8) < 0.04 and abs(shares[s, "test"] - 0.1) < 0.04 for s in "ab*")


def test_split_of_nothing(spark):
    none = spark.createDataFrame([], "entity string, stratum string")
    assert splits.split_ledger(none, edges(spark, ("a", "b")).limit(0)).count() == 0


@pytest.fixture(scope="module")
def questions(spark):
    data = [(i, f"{1 + i % 3:04d}_100000", "around", 0 if i % 50 else None, f"object_size_{i // 2}_width", ("Object Size ", "mc", None)[i % 3], "numerical", "(A)", i % 5, "clash") for i in range(600)]
    return spark.createDataFrame(data, Q)


PLAN = "plan_id int, field_name string, category string, target_share double, min_rows int, sample_size long"


def test_quota_sample(spark, questions):
    plans = spark.createDataFrame([(1, "question_type", "object_size", 0.5, 0, 100), (1, "question_type", "mc", 0.25, 40, 100), (1, "question_type", "gone", 0.25, 3, 100), (2, "answer", "A", 0.3, 0, 7)], PLAN)
    state = quota_sample.reservoirs(questions)
    report = {(r.plan_id, r.category): r for r in quota_sample.report(state, plans).collect()}
    assert report[1, "object_size"].quota == 50 and report[1, "mc"].quota == 40
    assert report[1, "gone"].exhausted and report[1, "gone"].quota == 0 and report[1, "gone"].needed == 25
    assert report[2, "A"].needed == 3 and not report[2, "A"].exhausted and report[2, "A"].share == 1.0
    sample = lambda q: sorted(map(tuple, quota_sample.sample(quota_sample.reservoirs(q), plans).collect()))
    one = sample(questions)
    assert one == sample(questions.repartition(7)) and len(one) == 50 + 40 + 2
    halves = [quota_sample.reservoirs(questions.where(f"q_row % 2 = {i}")) for i in (0, 1)]
    assert sorted(map(tuple, quota_sample.sample(quota_sample.merged(*halves), plans).collect())) == one
    none = quota_sample.reservoirs(questions.limit(0))
    assert quota_sample.sample(none, plans).count() == 0 and quota_sample.report(state, plans.limit(0)).count() == 0


def test_quotas_are_trimmed_uniformly(spark):
    plans = spark.createDataFrame([(1, "f", "a", 0.5, 0, 100), (1, "f", "b", 0.3, 0, 100), (1, "f", "c", 0.2, 60, 100), (1, "f", "gone", 0.0, None, 100), (2, "f", "a", 0.4, 2, 25), (2, "f", "b", 0.6, None, 25)], PLAN)
    ranges = spark.createDataFrame([("f", "a", 0, 4), ("f", "a", 9, 6), ("f", "b", 0, 500), ("f", "c", 1, 500)], "field_name string, category string, bucket int, n long")
    got = {(r.plan_id, r.category): (r.quota, r.needed, round(r.share, 3)) for r in quota_sample.quotas(plans, ranges).collect()}
    assert got == {(1, "a"): (10, 50, 0.132), (1, "b"): (6, 30, 0.079), (1, "c"): (60, 60, 0.789), (1, "gone"): (0, 0, 0.0), (2, "a"): (10, 10, 0.4), (2, "b"): (15, 15, 0.6)}


def stable_rows(questions):
    return stable_sample.with_record(questions).select(F.col("q_row").alias("row"), "record", F.col("batch_no").alias("epoch"))


def test_stable_sample(spark, questions, tmp_path):
    rows_ = stable_rows(questions)
    rows_ = rows_.unionByName(rows_.where("row % 4 = 0").withColumn("row", F.col("row") + 10_000).withColumn("epoch", F.lit(4)))
    folder = f"file://{tmp_path}/ledger"
    first = stable_sample.update(rows_.where("epoch < 3"), folder, {0: 0.5, 1: 0.3})
    second = stable_sample.update(rows_.where("epoch >= 3"), folder, {0: 0.0, 3: 0.2})
    old = {r.record for r in stable_sample.members(first).collect()}
    new = {r.record for r in stable_sample.members(second).collect()}
    assert old and old <= new
    sampled = {r.row for r in stable_sample.sample(rows_, second).collect()}
    assert sampled == {r.row for r in stable_sample.sample(rows_.repartition(5), second).collect()}
    assert {r.row for r in stable_sample.sample(rows_.withColumn("rate", F.lit("x")), second).collect()} == sampled
    pairs = stable_sample.deliveries(rows_, second).collect()
    assert pairs and all((r.q_row_a in sampled) == (r.q_row_b in sampled) for r in pairs) and all(r.q_row_a < r.q_row_b for r in pairs)
    assert stable_sample.update(rows_.limit(0), f"file://{tmp_path}/none").count() == 0


def test_rates_stay_frozen_and_replays_change_nothing(spark, tmp_path):
    made = lambda *r: spark.createDataFrame(r, "record string, row long, epoch int")
    folder = f"file://{tmp_path}/ledger"
    entries = lambda df: sorted((r.record, r.epoch, r.rate, r.first_row) for r in df.collect())
    stable_sample.update(made(("a", 1, 1), ("b", 2, 1)), folder, {1: 0.5})
    # a late record of epoch 1 gets the rate that epoch 1 was closed with, whatever is said now or left unsaid
    assert entries(stable_sample.update(made(("late", 3, 1), ("c", 4, 2), ("a", 5, 2)), folder, {1: 0.9, 2: 0.2})) == [("a", 1, 0.5, 1), ("b", 1, 0.5, 2), ("c", 2, 0.2, 4), ("late", 1, 0.5, 3)]
    third = entries(stable_sample.update(made(("later", 6, 1), ("later", 6, 1)), folder))
    assert ("later", 1, 0.5, 6) in third
    assert entries(stable_sample.update(made(("a", 1, 1), ("b", 2, 1), ("later", 6, 1)), folder, {1: 0.1})) == third


def test_repeated_rows_are_all_paired(spark, tmp_path):
    rows_ = spark.createDataFrame([("r", i) for i in range(6)] + [("r", 5), ("s", 9), (None, 10), (None, 11)], "record string, row long").withColumn("epoch", F.lit(None).cast("int"))
    entries = stable_sample.update(rows_, f"file://{tmp_path}/ledger")
    assert stable_sample.deliveries(rows_, entries).count() == 15
    assert entries.where("epoch = 0").count() == 2


def test_kept_tables(spark, tmp_path):
    parts = f"file://{tmp_path}/components"
    splits.merge(edges(spark, ("c", "b"), ("y", "x")), parts)
    assert {(r.node, r.root) for r in splits.merge(edges(spark, ("b", "a"), ("y", "z")), parts).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x"), ("z", "x")}

    keyed = spark.createDataFrame([(f"e{i}", "a") for i in range(40)], "entity string, stratum string")
    table = f"file://{tmp_path}/splits"
    before = {r.node: r.split for r in splits.update(keyed, edges(spark, ("e1", "e2")), table).collect()}
    after = {r.node: r.split for r in splits.update(keyed.unionByName(keyed.limit(1).withColumn("entity", F.lit("new"))), edges(spark, ("e1", "new")), table).collect()}
    assert before["e1"] == before["e2"] == after["new"] and all(after[k] == v for k, v in before.items())
