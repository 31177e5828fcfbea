"""Scenes: parsed objects, rooms, walls and bounds as flat tables keyed by scene_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomweave.functions.geometry import in_polygon, vertex_mean
from roomweave.functions.normalize import squeeze

#: Every object table has these columns; boxes are flat so that geometry stays in generated code.
OBJECT_COLUMNS = ["scene_id", "ord", "id", "label", "x0", "y0", "z0", "x1", "y1", "z1", "cx", "cy", "cz", "dx", "dy", "dz", "room_index"]


def _truthy(c: Column) -> Column:
    """The text unless it stands for nothing: null, empty and zero do."""
    return F.when(c.isNotNull() & ~c.isin("", "0"), c)


def parse_objects(labels: DataFrame) -> DataFrame:
    """Raw labels (scene_id, label_ord, ins_id, id, label, bounding_box) to boxes; rows without eight points or id leave."""
    bb = F.col("bounding_box")
    side = lambda f, a: f(F.transform(bb, lambda p: p[a]))
    return (
        labels.where(F.size(bb) >= 8)
        .withColumn("key", F.coalesce(_truthy(F.col("ins_id")), _truthy(F.col("id"))))
        .where(F.col("key").isNotNull())
        .select(
            "scene_id", F.col("label_ord").alias("ord"), F.col("key").alias("id"), F.lower(squeeze(F.coalesce("label", F.lit("")))).alias("label"),
            *(side(f, a).alias(f"{a}{n}") for n, f in ((0, F.array_min), (1, F.array_max)) for a in "xyz"),
        )
        .withColumns({f"c{a}": (F.col(f"{a}0") + F.col(f"{a}1")) / 2 for a in "xyz"} | {f"d{a}": F.col(f"{a}1") - F.col(f"{a}0") for a in "xyz"})
    )


def room_polygons(structure: DataFrame, at_least: int = 3) -> DataFrame:
    """(scene_id, polygons): valid room outlines in order, under the first of four names; a room's index is its place."""
    outline = F.transform("rooms", lambda r: F.coalesce(r["profile"], r["polygon"], r["floor"], r["boundary"]))
    return structure.select("scene_id", F.coalesce(F.filter(outline, lambda p: F.size(p) >= at_least), F.array().cast("array<array<array<double>>>")).alias("polygons"))


def room_index(x: Column, y: Column, polygons: Column) -> Column:
    """The first room that holds the point, null for none."""
    at = F.array_position(F.transform(polygons, lambda p: in_polygon(x, y, p)), True) - 1
    return F.when(at >= 0, at.cast("int"))


def with_rooms(objects: DataFrame, structure: DataFrame) -> DataFrame:
    """Objects with room_index: one join a scene, no row per object and room."""
    return objects.join(room_polygons(structure), "scene_id", "left").withColumn("room_index", room_index(F.col("cx"), F.col("cy"), F.col("polygons"))).select(OBJECT_COLUMNS)


def objects_of(labels: DataFrame, structure: DataFrame) -> DataFrame:
    return with_rooms(parse_objects(labels), structure)


def room_centers(structure: DataFrame) -> DataFrame:
    """(scene_id, room_idx, x, y): means of the outlines' points."""
    rooms = room_polygons(structure).select("scene_id", F.posexplode("polygons").alias("room_idx", "p"))
    return rooms.select("scene_id", "room_idx", vertex_mean(F.col("p"), 0).alias("x"), vertex_mean(F.col("p"), 1).alias("y"))


def walls(structure: DataFrame, mode: str = "objects") -> DataFrame:
    """Walls as boxes (scene_id, wall_idx, x0 … z1).

    `objects`: default thickness 0.1, further points ignored, walls of no length left out. `cameras`: default thickness 0.2
    (for 0 too), exactly two points, a wall of no length is a square of its thickness.
    """
    camera = mode == "cameras"
    default = lambda c, v: F.coalesce(F.nullif(c, F.lit(0.0)), F.lit(v)) if camera else F.coalesce(c, F.lit(v))
    at = lambda w, i, j: F.get(F.get(w["location"], F.lit(i)), F.lit(j))

    def line(w: Column, i: Column) -> Column:
        ax, ay, bx, by = at(w, 0, 0), at(w, 0, 1), at(w, 1, 0), at(w, 1, 1)
        length = F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))
        points = F.when(F.size(w["location"]) == 2 if camera else F.size(w["location"]) >= 2, length)
        return F.struct(i.alias("wall_idx"), ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"), points.alias("length"), (default(w["thickness"], 0.2 if camera else 0.1) / 2).alias("half"), default(w["height"], 2.8).alias("z1"))

    def across(w: Column) -> Column:
        none = w["length"] < 1e-6
        px = F.when(none, w["half"]).otherwise(-F.try_divide(w["by"] - w["ay"], w["length"]) * w["half"])
        py = F.when(none, w["half"]).otherwise(F.try_divide(w["bx"] - w["ax"], w["length"]) * w["half"])
        return F.struct(w.alias("w"), px.alias("px"), py.alias("py"))

    def box(x: Column) -> Column:
        w = x["w"]
        xs, ys = ([w[f"a{a}"] + x[f"p{a}"], w[f"a{a}"] - x[f"p{a}"], w[f"b{a}"] + x[f"p{a}"], w[f"b{a}"] - x[f"p{a}"]] for a in "xy")
        return F.struct(w["wall_idx"].alias("wall_idx"), F.least(*xs).alias("x0"), F.least(*ys).alias("y0"), F.lit(0.0).alias("z0"), F.greatest(*xs).alias("x1"), F.greatest(*ys).alias("y1"), w["z1"].alias("z1"))

    # In one array per scene: conditions on the boxes stay above the generated rows and see plain columns.
    known = F.filter(F.transform("walls", line), lambda w: w["length"].isNotNull() if camera else w["length"] >= 1e-6)
    return structure.select("scene_id", F.inline(F.transform(F.transform(known, across), box)))


def wall_objects(structure: DataFrame) -> DataFrame:
    """Walls in the form of objects, after all labels of their scene."""
    w = walls(structure)
    return w.withColumns(
        {"ord": F.lit(1_000_000) + F.col("wall_idx"), "id": F.concat(F.lit("wall_"), F.col("wall_idx").cast("string")), "label": F.lit("wall"), "room_index": F.lit(None).cast("int")}
        | {f"c{a}": (F.col(f"{a}0") + F.col(f"{a}1")) / 2 for a in "xyz"}
        | {f"d{a}": F.col(f"{a}1") - F.col(f"{a}0") for a in "xyz"}
    ).select(OBJECT_COLUMNS)


def all_objects(labels: DataFrame, structure: DataFrame) -> DataFrame:
    return objects_of(labels, structure).unionByName(wall_objects(structure))


def occluders(labels: DataFrame, structure: DataFrame) -> DataFrame:
    """Boxes that hide others: all objects, walls in both forms."""
    box = ["scene_id", "id", "label", "x0", "y0", "z0", "x1", "y1", "z1"]
    second = walls(structure, "cameras").withColumns({"id": F.concat(F.lit("wall_"), F.col("wall_idx").cast("string")), "label": F.lit("wall")}).select(box)
    return all_objects(labels, structure).select(box).unionByName(second)


def bounds(structure: DataFrame) -> DataFrame:
    """(scene_id, x0 … z1, cx, cy, cz) of scenes with an occupancy: either name of a side, defaults, centre from the sides."""
    o = F.col("occupancy")
    low = F.coalesce(o["min"], o["lower"], F.array(*(F.lit(float(v)) for v in (-10, -10, 0))))
    high = F.coalesce(o["max"], o["upper"], F.array(*(F.lit(float(v)) for v in (10, 10, 3))))
    at = lambda c, i: F.get(c, F.lit(i))
    sides = structure.where(o.isNotNull()).select("scene_id", low.alias("low"), high.alias("high"), o["center"].alias("mid"))
    return sides.select("scene_id", *(at("low", i).alias(f"{a}0") for i, a in enumerate("xyz")), *(at("high", i).alias(f"{a}1") for i, a in enumerate("xyz")), *(F.coalesce(at("mid", i), (at("low", i) + at("high", i)) / 2).alias(f"c{a}") for i, a in enumerate("xyz")))
