"""Which objects and object pairs questions are asked about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomweave.config import MAX_FOCUS_OBJECTS, MIN_FOCUS_OBJECTS, Selection
from roomweave.functions.geometry import box_gap


def measures(prefix: str = "") -> dict[str, Column]:
    """length, width, height, volume and the extreme sides of a box."""
    dx, dy, dz = (F.col(f"{prefix}d{a}") for a in "xyz")
    return {"length": F.greatest(dx, dy), "width": F.least(dx, dy), "height": dz, "max_dim": F.greatest(dx, dy, dz), "min_dim": F.least(dx, dy, dz), "volume": dx * dy * dz, "top_z": F.col(f"{prefix}z1"), "bottom_z": F.col(f"{prefix}z0")}


def reject_reason(cfg: Selection | None = None) -> Column:
    """The first rule that an object breaks, or ok; rules that are off leave the plan."""
    cfg = cfg or Selection()
    m = measures()
    reason = F.when(F.col("label").isin(*cfg.blacklist), "blacklist")
    if cfg.enable_dim_filter:
        reason = reason.when(m["min_dim"] < cfg.min_dim_component, "dim_too_small").when(m["max_dim"] > cfg.max_dim_component, "dim_too_large")
    if cfg.enable_volume_filter:
        reason = reason.when(m["volume"] < cfg.min_volume, "volume_too_small")
    if cfg.enable_aspect_ratio_filter:
        reason = reason.when(m["min_dim"] / (m["max_dim"] + 1e-9) < cfg.min_aspect_ratio, "too_flat")
    return reason.otherwise("ok")


def single_objects(objects: DataFrame, cfg: Selection | None = None) -> DataFrame:
    """Valid objects whose label is alone in its room (or, with it, in its scene)."""
    alone = Window.partitionBy("scene_id", "room_index", "label")
    return objects.where(reject_reason(cfg) == "ok").withColumn("_n", F.count(F.lit(1)).over(alone)).where(F.col("_n") == 1).drop("_n")


def focus_objects(singles: DataFrame, most: int = MAX_FOCUS_OBJECTS) -> DataFrame:
    """With `rank` from 0: all singles in order where a scene has no more than `most`, else the largest of each label, by volume."""
    scene = Window.partitionBy("scene_id")
    by_label = Window.partitionBy("scene_id", "label").orderBy(F.desc("volume"), "ord")
    s = (
        singles.withColumn("volume", measures()["volume"])
        .withColumn("n", F.count(F.lit(1)).over(scene))
        .withColumn("in_label", F.row_number().over(by_label))
        .withColumn("label_first", F.min("ord").over(Window.partitionBy("scene_id", "label")))
        .where((F.col("n") <= most) | (F.col("in_label") == 1))
    )
    order = Window.partitionBy("scene_id").orderBy(F.when(F.col("n") > most, -F.col("volume")), F.when(F.col("n") > most, F.col("label_first")), "ord")
    return s.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < most).drop("n", "in_label", "label_first")


def gated(focus: DataFrame, least: int = MIN_FOCUS_OBJECTS) -> DataFrame:
    """Without scenes that have too few focus objects."""
    return focus.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("scene_id"))).where(F.col("_n") >= least).drop("_n")


def gate_report(objects: DataFrame, focus: DataFrame, least: int = MIN_FOCUS_OBJECTS) -> DataFrame:
    """Per scene: parsed objects, focus objects and whether a run skips it."""
    n = objects.groupBy("scene_id").agg(F.count(F.lit(1)).alias("objects"))
    f = focus.groupBy("scene_id").agg(F.count(F.lit(1)).alias("focus"))
    both = n.join(f, "scene_id", "left").withColumn("focus", F.coalesce("focus", F.lit(0)))
    return both.withColumn("skipped", F.col("focus") < least)


def _sides(objects: DataFrame, name: str, keep: list[str]) -> DataFrame:
    return objects.select("scene_id", *(F.col(c).alias(f"{name}_{c}") for c in keep))


PAIR_COLUMNS = ["ord", "id", "label", "x0", "y0", "z0", "x1", "y1", "z1", "cx", "cy", "cz", "dx", "dy", "dz", "room_index"]


def joined(objects: DataFrame, order: str = "ord", keep: list[str] | None = None) -> DataFrame:
    """All unordered pairs of a scene's objects (a before b), an equi-join on the scene."""
    keep = keep or PAIR_COLUMNS
    return _sides(objects, "a", keep).join(_sides(objects, "b", keep), "scene_id").where(F.col(f"a_{order}") < F.col(f"b_{order}"))


def pair_reason(cfg: Selection | None = None) -> Column:
    cfg = cfg or Selection()
    a, b = measures("a_"), measures("b_")
    gap = box_gap(*((F.col(f"{s}_x{n}"), F.col(f"{s}_y{n}"), F.col(f"{s}_z{n}")) for s in "ab" for n in (0, 1)))
    average = (a["max_dim"] + b["max_dim"]) / 2
    ratio = F.greatest(a["max_dim"], b["max_dim"]) / (F.least(a["max_dim"], b["max_dim"]) + 1e-9)
    return (
        F.when(F.col("a_label").isin(*cfg.blacklist), "blacklist_obj_a")
        .when(F.col("b_label").isin(*cfg.blacklist), "blacklist_obj_b")
        .when(F.col("a_room_index") != F.col("b_room_index"), "different_rooms")
        .when(gap < F.greatest(F.lit(cfg.min_pair_dist), cfg.dyn_min_mult * average), "too_close")
        .when(gap > F.least(F.lit(cfg.max_pair_dist), cfg.dyn_max_mult * average), "too_far")
        .when(ratio > cfg.max_pair_dim_ratio, "size_ratio")
        .when(F.abs(a["max_dim"] - b["max_dim"]) > cfg.max_pair_dim_diff, "size_diff")
        .otherwise("ok")
    )


def valid_pairs(objects: DataFrame, most: int | None = 100, cfg: Selection | None = None) -> DataFrame:
    """Valid pairs in order of their objects, the first `most` of each scene, with `pair_ord`."""
    cfg = cfg or Selection()
    usable = objects.where(~F.col("label").isin(*cfg.blacklist))  # a pair with such a label is never valid
    pairs = joined(usable).where(pair_reason(cfg) == "ok").withColumn("pair_ord", F.row_number().over(Window.partitionBy("scene_id").orderBy("a_ord", "b_ord")))
    return pairs.where(F.col("pair_ord") <= most) if most else pairs


def valid_triples(objects: DataFrame, most: int = 50, cfg: Selection | None = None) -> DataFrame:
    """(scene_id, a_ord, b_ord, c_ord): triangles of valid pairs, the first `most` of each scene."""
    edges = valid_pairs(objects, None, cfg).select("scene_id", "a_ord", "b_ord")
    ab, bc, ac = edges, edges.select("scene_id", "a_ord", "b_ord").toDF("scene_id", "b_ord", "c_ord"), edges.toDF("scene_id", "a_ord", "c_ord")
    found = ab.join(bc, ["scene_id", "b_ord"]).join(ac, ["scene_id", "a_ord", "c_ord"])
    order = Window.partitionBy("scene_id").orderBy("a_ord", "b_ord", "c_ord")
    return found.withColumn("triple_ord", F.row_number().over(order)).where(F.col("triple_ord") <= most).select("scene_id", "a_ord", "b_ord", "c_ord", "triple_ord")


def coin(*parts: Column) -> Column:
    """A fair coin that hangs on names alone."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 1), 16, 10).cast("int") >= 8


def focus_pairs(focus: DataFrame) -> DataFrame:
    """All pairs of a scene's focus objects, half of them turned round."""
    keep = [*PAIR_COLUMNS, "rank"]
    pairs = joined(focus, "rank", keep).withColumn("turned", coin(F.lit("pair"), F.col("scene_id"), F.col("a_id"), F.col("b_id")))
    pairs = pairs.withColumn("pair_ord", F.row_number().over(Window.partitionBy("scene_id").orderBy("a_rank", "b_rank")) - 1)
    turn = lambda c: [F.when(F.col("turned"), F.col(f"{s}_{c}")).otherwise(F.col(f"{t}_{c}")).alias(f"{t}_{c}") for t, s in (("a", "b"), ("b", "a"))]
    return pairs.select("scene_id", "pair_ord", "turned", *(x for c in keep for x in turn(c)))


def scene_statistics(objects: DataFrame, structure_rooms: DataFrame, cfg: Selection | None = None) -> DataFrame:
    """Per scene: objects, valid objects, valid pairs, distinct labels, rooms."""
    counts = objects.groupBy("scene_id").agg(F.count(F.lit(1)).alias("total_objects"), F.count_if(reject_reason(cfg) == "ok").alias("valid_objects"), F.countDistinct("label").alias("labels"))
    pairs = valid_pairs(objects, 100, cfg).groupBy("scene_id").agg(F.count(F.lit(1)).alias("valid_pairs"))
    rooms = structure_rooms.select("scene_id", F.size("polygons").alias("rooms"))
    return counts.join(pairs, "scene_id", "left").join(rooms, "scene_id", "left").na.fill(0, ["valid_pairs", "rooms"])


def label_histogram(objects: DataFrame, cfg: Selection | None = None) -> DataFrame:
    """Per scene and label, all and valid objects."""
    return objects.groupBy("scene_id", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(reject_reason(cfg) == "ok").alias("valid"))


