"""What a camera sees: field of view, visible corners, occlusion, valid positions.

Inputs are tables of (camera, object) candidates with flat columns: the camera's px, py, pz and look target tx, ty, tz, and
the object's box x0 … z1. Occluders and collisions meet them on scene_id only; scenes are small, so the pairs per scene are
bounded by a scene's own boxes, and every test is a residual of that equi-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomweave.config import Cameras
from roomweave.functions import geometry as g



def box(table: str = "") -> tuple[g.Vec, g.Vec]:
    at = f"{table}." if table else ""
    return tuple(tuple(F.col(f"{at}{a}{n}") for a in "xyz") for n in (0, 1))


#: Helper columns of with_projection.
_HELP = (*g.VIEW, *(f"{m}{i}" for m in ("w", "u", "v") for i in range(9)))
CENTER = 8


def with_projection(candidates: DataFrame, cfg: Cameras | None = None) -> DataFrame:
    """With depth w and image place u, v of the box's corners 0 … 7 and its centre 8; u and v are null behind the camera.

    Every step is computed once: axes, products along each side, sums, divisions.
    """
    cfg = cfg or Cameras()
    fx, fy, cx, cy = g.intrinsics(cfg.image_width, cfg.image_height, cfg.fov_deg)
    df = g.with_view(candidates)
    side = {"0": lambda a: F.col(f"{a}0"), "1": lambda a: F.col(f"{a}1"), "c": lambda a: 0.5 * (F.col(f"{a}0") + F.col(f"{a}1"))}
    df = g.staged(df, {f"_{n}_{a}{k}": F.col(f"{n}_{a}") * (at(a) - F.col(f"p{a}")) for n in ("right", "up", "forward") for a in "xyz" for k, at in side.items()})
    corners = [(i, j, k) for i in "01" for j in "01" for k in "01"] + [("c", "c", "c")]
    along = lambda n, c: F.col(f"_{n}_x{c[0]}") + F.col(f"_{n}_y{c[1]}") + F.col(f"_{n}_z{c[2]}")
    df = g.staged(df, {f"w{i}": along("forward", c) for i, c in enumerate(corners)} | {f"_x{i}": -along("right", c) for i, c in enumerate(corners)} | {f"_y{i}": along("up", c) for i, c in enumerate(corners)})
    place = lambda f, o, n, i: F.when(F.col(f"w{i}") > 1e-6, f * F.try_divide(F.col(f"_{n}{i}"), F.col(f"w{i}")) + o)
    df = g.staged(df, {f"u{i}": place(fx, cx, "x", i) for i in range(9)} | {f"v{i}": place(fy, cy, "y", i) for i in range(9)})
    return df.select(*candidates.columns, *_HELP)


def _seen(i: int, cfg: Cameras, border: float) -> Column:
    return F.coalesce(F.col(f"u{i}").between(border, cfg.image_width - 1 - border) & F.col(f"v{i}").between(border, cfg.image_height - 1 - border), F.lit(False))


def fov_reason(cfg: Cameras | None = None, center: bool = True, border: int = 5) -> Column:
    """ok, or the first reason why a box isn't in the field of view; over rows with_projection."""
    cfg = cfg or Cameras()
    front = g.any_of([F.col(f"w{i}") > 1e-6 for i in range(8)])
    reason = F.when(~front, "all_corners_behind_camera").when(~g.any_of([_seen(i, cfg, border) for i in range(8)]), "no_corner_in_image")
    if center:
        reason = reason.when(~_seen(CENTER, cfg, border), "center_not_in_image")
    return reason.otherwise("ok")


def in_fov(candidates: DataFrame, cfg: Cameras | None = None, center: bool = True, border: int = 5) -> DataFrame:
    return with_projection(candidates, cfg).where(fov_reason(cfg, center, border) == "ok").drop(*_HELP)


def all_in_fov(candidates: DataFrame, keys: list[str], cfg: Cameras | None = None) -> DataFrame:
    """keys, whether all targets of a candidate are in the field of view, and the ids and reasons of those that aren't."""
    checked = with_projection(candidates, cfg).select(*keys, "id", fov_reason(cfg).alias("reason"))
    failed = F.array_sort(F.collect_list(F.when(F.col("reason") != "ok", F.struct("id", "reason"))))
    return checked.groupBy(*keys).agg(F.every(F.col("reason") == "ok").alias("all_visible"), failed.alias("failures"))


def corner_mask(cfg: Cameras | None = None, border: int = 2) -> Column:
    """Bits of a box's eight corners that are in front and in the image; over rows with_projection."""
    cfg = cfg or Cameras()
    return reduce(lambda a, b: a.bitwiseOR(b), (F.when(_seen(i, cfg, border), 1 << i).otherwise(0) for i in range(8)))


def visible_corners(candidates: DataFrame, cfg: Cameras | None = None, border: int = 2) -> DataFrame:
    """With `corners`, how many of a box's corners are in the image, whatever stands before them."""
    return with_projection(candidates, cfg).withColumn("corners", F.bit_count(corner_mask(cfg, border))).drop(*_HELP)


def _rays(candidates: DataFrame, points: list[g.Vec]) -> DataFrame:
    """A row a candidate and point, with `point`'s number and the ray from the camera."""
    rows = candidates.select("*", F.posexplode(F.array(*(F.struct(*(c.alias(f"q{a}") for a, c in zip("xyz", p, strict=True))) for p in points))).alias("point", "q"))
    return g.aimed_at(rows.select("*", "q.*").drop("q"), g.vec("p"), g.vec("q"))


def _other_boxes(occluders: DataFrame) -> DataFrame:
    wall = (F.col("label") == "wall") | F.col("id").startswith("wall")
    return occluders.select("scene_id", F.col("id").alias("occ_id"), wall.alias("is_wall"), *(F.col(f"{a}{n}").alias(f"o{a}{n}") for a in "xyz" for n in (0, 1)))


OTHER = tuple(tuple(f"o{a}{n}" for a in "xyz") for n in (0, 1))


def _hidden(candidates: DataFrame, points: list[g.Vec], others: DataFrame, keys: list[str], counts: Column) -> DataFrame:
    """keys and `hidden`, the bits of the points that some box hides: one aggregate with partial results per task.

    A box can only stand before a point if it reaches into the box around camera and target; all others leave before the
    rays are made.
    """
    low, high = (tuple(F.col(c) for c in cs) for cs in OTHER)
    reaches = reduce(lambda x, y: x & y, ((F.least(F.col(f"p{a}"), F.col(f"{a}0")) <= hi + 1e-6) & (F.greatest(F.col(f"p{a}"), F.col(f"{a}1")) >= lo - 1e-6) for a, lo, hi in zip("xyz", low, high, strict=True)))
    met = candidates.join(others, "scene_id").where(reaches & counts)
    return _rays(met, points).where(g.blocks(g.vec("p"), low, high)).groupBy(*keys).agg(F.bit_or(F.expr("shiftleft(1, point)")).alias("hidden"))


def unhidden_corners(candidates: DataFrame, occluders: DataFrame, keys: list[str], cfg: Cameras | None = None, border: int = 2) -> DataFrame:
    """keys and the number of corners in the image that no other box hides; keys name a candidate and hold scene_id and id."""
    shown = with_projection(candidates, cfg).withColumn("shown", corner_mask(cfg, border)).select(*keys, "shown")
    hidden = _hidden(candidates, g.box_corners(*box()), _other_boxes(occluders), keys, F.col("occ_id") != F.col("id"))
    return shown.join(hidden, keys, "left").select(*keys, F.bit_count(F.col("shown").bitwiseAND(F.bitwise_not(F.coalesce("hidden", F.lit(0))))).alias("corners"))


def occlusion(candidates: DataFrame, occluders: DataFrame, keys: list[str], walls_only: bool = False, threshold: float = 0.5, overlap: float = 0.3, near: float = 0.3) -> DataFrame:
    """keys, `hidden_points` of nine (centre and corners), `center_hidden` and `occluded` of every candidate.

    Boxes that overlap the target much, and other boxes than walls next to it, are no occluders.
    """
    others = _other_boxes(occluders)
    if walls_only:
        others = others.where("is_wall")
    low, high = box()
    o_low, o_high = (tuple(F.col(c) for c in cs) for cs in OTHER)
    counts = (F.col("occ_id") != F.col("id")) & (g.box_overlap(low, high, o_low, o_high) <= overlap)
    if not walls_only:
        counts &= F.col("is_wall") | (g.box_gap(low, high, o_low, o_high) >= near)
    points = [tuple((a + b) / 2 for a, b in zip(low, high, strict=True)), *g.box_corners(low, high)]
    hidden = _hidden(candidates, points, others, keys, counts)
    mask = F.coalesce("hidden", F.lit(0))
    flags = candidates.select(*keys).join(hidden, keys, "left").select(*keys, F.bit_count(mask).alias("hidden_points"), (mask.bitwiseAND(F.lit(1)) == 1).alias("center_hidden"))
    return flags.withColumn("occluded", F.col("center_hidden") | (F.col("hidden_points") / 9.0 >= threshold))


def valid_positions(candidates: DataFrame, keys: list[str], boxes: DataFrame, rooms: DataFrame, bounds: DataFrame, cfg: Cameras | None = None, margin: float = 0.1) -> DataFrame:
    """Candidates (scene_id, px, py, pz) at an allowed height, inside bounds and rooms where these are known, clear of all boxes."""
    cfg = cfg or Cameras()
    camera = g.vec("p")
    inside = candidates.where(F.col("pz").between(cfg.min_camera_height, cfg.max_camera_height))
    b = bounds.select("scene_id", *(F.col(f"{a}{n}").alias(f"b{a}{n}") for a in "xy" for n in (0, 1)))
    held = (F.col("px") >= F.col("bx0") + margin) & (F.col("px") <= F.col("bx1") - margin) & (F.col("py") >= F.col("by0") + margin) & (F.col("py") <= F.col("by1") - margin)
    inside = inside.join(b, "scene_id", "left").where(F.col("bx0").isNull() | held).drop(*(f"b{a}{n}" for a in "xy" for n in (0, 1)))
    inside = inside.join(rooms, "scene_id", "left").where((F.coalesce(F.size("polygons"), F.lit(0)) <= 0) | F.exists("polygons", lambda p: g.in_polygon(camera[0], camera[1], p))).drop("polygons")
    near = boxes.select("scene_id", *(F.col(f"{a}{n}").alias(f"o{a}{n}") for a in "xyz" for n in (0, 1)))
    clash = (inside["scene_id"] == near["scene_id"]) & g.in_box(camera, *(tuple(F.col(f"o{a}{n}") for a in "xyz") for n in (0, 1)), margin=margin)
    return inside.join(near, clash, "left_anti")


def visible_objects(poses: DataFrame, objects: DataFrame, cfg: Cameras | None = None, compat: bool = True, occluders: DataFrame | None = None) -> DataFrame:
    """(pose, object) rows that are in the field of view with centre and enough corners.

    With `compat` corners count whether hidden or not; otherwise hidden corners don't.
    """
    cfg = cfg or Cameras()
    both = in_fov(poses.join(objects, "scene_id"), cfg)
    if compat or occluders is None:
        return visible_corners(both, cfg).where(F.col("corners") >= cfg.min_visible_corners).drop("corners")
    keys = ["scene_id", "pose", "id"]
    seen = unhidden_corners(both, occluders, keys, cfg).where(F.col("corners") >= cfg.min_visible_corners)
    return both.join(seen.select(keys), keys, "left_semi")
