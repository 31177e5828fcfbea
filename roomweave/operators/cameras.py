"""Camera poses around focus objects, on spheres, along lines and in room centres.

Poses are found by rejection: numbered attempts per item are made from hashed random numbers, and the first accepted ones
stay. Random numbers hang on (seed, scene, pattern, item, attempt, channel) alone, so reruns and other partitionings give
the same poses. Only items that still lack poses get further attempts, up to the allowed number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomweave.config import MAX_ROTATION_POSES, Cameras
from roomweave.functions import geometry as g
from roomweave.operators import attempts
from roomweave.session import durable, spread

SEED = 42


def uniform(channel: str, *parts: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from 52 bits of md5 over the names."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(channel), *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def camera_height(top: Column, cfg: Cameras) -> Column:
    """A little above the highest object, within limits; the upper limit without objects."""
    return F.greatest(F.least(F.coalesce(top, F.lit(cfg.max_camera_height)) + F.when(top.isNull(), 0.0).otherwise(cfg.camera_height_offset), F.lit(cfg.max_camera_height)), F.lit(cfg.min_camera_height))


#: Items below are single objects, by rank; those from here up are pairs. No scene has so many objects.
PAIR_ITEMS = 1 << 40


def singles(poses: DataFrame) -> DataFrame:
    """The poses of single objects, `item` being their rank."""
    return poses.where(F.col("item") < PAIR_ITEMS)


def of_pairs(poses: DataFrame) -> DataFrame:
    """The poses of pairs, `item` being their pair_ord."""
    return poses.where(F.col("item") >= PAIR_ITEMS).withColumn("item", F.col("item") - PAIR_ITEMS)


def items_of(focus: DataFrame, pairs: DataFrame) -> DataFrame:
    """(scene_id, item, targets): single objects by rank, then pairs from PAIR_ITEMS up; a target is an object's id, label and box."""
    side = lambda p: F.struct(F.col(f"{p}id").alias("id"), F.col(f"{p}label").alias("label"), *(F.col(f"{p}{a}{n}").alias(f"{a}{n}") for a in "xyz" for n in (0, 1)))
    one = focus.select("scene_id", F.col("rank").cast("bigint").alias("item"), F.array(side("")).alias("targets"))
    two = pairs.select("scene_id", (F.lit(PAIR_ITEMS) + F.col("pair_ord")).alias("item"), F.array(side("a_"), side("b_")).alias("targets"))
    return one.unionByName(two)


def aimed(items: DataFrame, cfg: Cameras) -> DataFrame:
    """Items with the point that cameras aim at (ox, oy, oz) and the camera height."""
    mean = lambda a: F.aggregate("targets", F.lit(0.0), lambda acc, t: acc + (t[f"{a}0"] + t[f"{a}1"]) / 2) / F.size("targets")
    top = F.array_max(F.transform("targets", lambda t: t["z1"]))
    return items.withColumns({f"o{a}": mean(a) for a in "xyz"} | {"height": camera_height(top, cfg)})


def around(items: DataFrame, cfg: Cameras) -> DataFrame:
    """A horizontal circle: any side, any radius; yaw is the side that the camera stands on."""
    u = lambda c: uniform(c, F.lit("around"), F.col("scene_id"), F.col("item"), F.col("attempt"))
    d = g.staged(items, {"yaw": u("yaw") * 360.0, "radius": cfg.min_distance + u("radius") * (cfg.max_distance - cfg.min_distance)})
    d = g.staged(d, {"px": F.col("ox") + F.col("radius") * F.cos(F.radians("yaw")), "py": F.col("oy") + F.col("radius") * F.sin(F.radians("yaw")), "pz": F.col("height")})
    flat = F.sqrt((F.col("ox") - F.col("px")) * (F.col("ox") - F.col("px")) + (F.col("oy") - F.col("py")) * (F.col("oy") - F.col("py")))
    return d.withColumn("pitch", F.degrees(F.atan2(F.col("pz") - F.col("oz"), flat))).withColumns({"tx": F.col("ox"), "ty": F.col("oy"), "tz": F.col("oz"), "step": F.lit(0)})


def spherical(items: DataFrame, cfg: Cameras) -> DataFrame:
    """Uniform over spheres of any radius."""
    u = lambda c: uniform(c, F.lit("spherical"), F.col("scene_id"), F.col("item"), F.col("attempt"))
    d = g.staged(items, {"radius": cfg.min_distance + u("radius") * (cfg.max_distance - cfg.min_distance), "theta": u("theta") * (2 * 3.141592653589793), "cosphi": u("phi") * 2.0 - 1.0})
    flat = F.col("radius") * F.sqrt(1.0 - F.col("cosphi") * F.col("cosphi"))
    d = g.staged(d, {"px": F.col("ox") + flat * F.cos("theta"), "py": F.col("oy") + flat * F.sin("theta"), "pz": F.col("oz") + F.col("radius") * F.col("cosphi"), "yaw": F.degrees("theta")})
    ground = F.sqrt((F.col("ox") - F.col("px")) * (F.col("ox") - F.col("px")) + (F.col("oy") - F.col("py")) * (F.col("oy") - F.col("py")))
    return d.withColumn("pitch", F.degrees(F.atan2(F.col("pz") - F.col("oz"), ground + 1e-8))).withColumns({"tx": F.col("ox"), "ty": F.col("oy"), "tz": F.col("oz"), "step": F.lit(0)}).drop("theta", "cosphi")


def linear(items: DataFrame, cfg: Cameras) -> DataFrame:
    """A walk of linear_num_steps poses towards the target or past it, with a fixed look; yaw is the look direction."""
    n, move = cfg.linear_num_steps, cfg.linear_move_distance
    u = lambda c: uniform(c, F.lit("linear"), F.col("scene_id"), F.col("item"), F.col("attempt"))
    towards = cfg.linear_sub_pattern == "approach"
    low = cfg.min_distance + (move if towards else 0.0)
    d = g.staged(items, {"angle": u("angle") * (2 * 3.141592653589793), "start": low + u("radius") * (cfg.max_distance - low)})
    d = d.withColumns({"ux": F.cos("angle"), "uy": F.sin("angle"), "step": F.explode(F.sequence(F.lit(0), F.lit(n - 1)))})
    along = F.col("step") / F.lit(float(max(1, n - 1)))
    if towards:
        at = F.col("start") - along * move
        px, py, aim = F.col("ox") + at * F.col("ux"), F.col("oy") + at * F.col("uy"), F.col("start") - move / 2
    else:
        shift = (along - 0.5) * move
        px, py, aim = F.col("ox") + F.col("start") * F.col("ux") - shift * F.col("uy"), F.col("oy") + F.col("start") * F.col("uy") + shift * F.col("ux"), F.col("start")
    ahead = F.col("start") - 10.0
    d = g.staged(d, {"px": px, "py": py, "pz": F.col("height"), "tx": F.col("ox") + ahead * F.col("ux"), "ty": F.col("oy") + ahead * F.col("uy"), "tz": F.col("oz"), "yaw": F.degrees(F.atan2(-F.col("uy"), -F.col("ux"))), "pitch": F.degrees(F.atan2(F.col("height") - F.col("oz"), aim))})
    radius = F.sqrt((F.col("px") - F.col("ox")) * (F.col("px") - F.col("ox")) + (F.col("py") - F.col("oy")) * (F.col("py") - F.col("oy")))
    return d.withColumn("radius", radius).drop("angle", "start", "ux", "uy")


GENERATORS = {"around": around, "spherical": spherical, "linear": linear}
POSE = ["px", "py", "pz", "tx", "ty", "tz", "yaw", "pitch", "radius"]


def _by_scene(items: DataFrame, boxes: DataFrame, rooms: DataFrame, bounds: DataFrame, occluders: DataFrame) -> DataFrame:
    """One row a scene: its items and all that attempts are tested against; scenes are small."""
    sides = lambda at, axes="xyz": F.array(*(at(f"{a}{n}") for n in (0, 1) for a in axes))
    wall = (F.col("label") == "wall") | F.col("id").startswith("wall")
    target = lambda t: F.struct(t["id"].alias("id"), sides(lambda c: t[c]).alias("box"))
    each = F.struct("item", "ox", "oy", "oz", "height", F.transform("targets", target).alias("targets"))
    found = items.groupBy("scene_id").agg(F.collect_list(each).alias("items"))
    near = boxes.groupBy("scene_id").agg(F.collect_list(sides(F.col)).alias("boxes"))
    hiding = occluders.groupBy("scene_id").agg(F.collect_list(F.struct("id", wall.alias("is_wall"), sides(F.col).alias("box"))).alias("occluders"))
    held = bounds.select("scene_id", F.array("x0", "x1", "y0", "y1").alias("bounds"))
    for other in (near, hiding, held, rooms.select("scene_id", "polygons")):
        found = found.join(other, "scene_id", "left")
    return found


def sample_poses(pattern: str, items: DataFrame, count: int, boxes: DataFrame, rooms: DataFrame, bounds: DataFrame, occluders: DataFrame, cfg: Cameras) -> DataFrame:
    """The first `count` accepted poses of every item (for lines, the steps of the first accepted walk), with `seq` from 0.

    An item may use 10 x count calls, each of at most max_tries attempts that ends with its first acceptance; so what an
    item can use is bounded by tries x calls attempts (a line is one call). Attempts are made and tested by arrays, a scene
    in one place (see attempts); the poses of the accepted ones are made here.
    """
    if pattern not in GENERATORS:
        raise ValueError(f"no pattern {pattern!r}")
    wanted = 1 if pattern == "linear" else count
    limit = cfg.max_tries if pattern == "linear" else cfg.max_tries * 10 * count
    aims = durable(aimed(items, cfg).where(F.col("scene_id").isNotNull()))
    taken = durable(spread(_by_scene(aims, boxes, rooms, bounds, occluders), "scene_id").mapInArrow(attempts.of_batches(pattern, wanted, limit, SEED, cfg), attempts.SCHEMA))
    found = GENERATORS[pattern](aims.join(taken, ["scene_id", "item"]), cfg).select("scene_id", "item", "attempt", "step", "targets", *POSE)
    order = Window.partitionBy("scene_id", "item").orderBy("attempt", "step")
    return found.withColumn("seq", F.row_number().over(order) - 1)


def rotation_poses(centers: DataFrame, boxes: DataFrame, cfg: Cameras, margin: float = 0.1) -> DataFrame:
    """Room centres clear of all boxes, turned by the interval: (scene_id, room_idx, angle_idx, pose columns)."""
    c = centers.select("scene_id", "room_idx", F.col("x").alias("px"), F.col("y").alias("py"), F.lit(cfg.rotation_camera_height).alias("pz"))
    near = boxes.select("scene_id", *(F.col(f"{a}{n}").alias(f"o{a}{n}") for a in "xyz" for n in (0, 1)))
    clash = (c["scene_id"] == near["scene_id"]) & g.in_box(g.vec("p"), *(tuple(F.col(f"o{a}{n}") for a in "xyz") for n in (0, 1)), margin=margin)
    turns = int(360 / cfg.rotation_interval)
    p = c.join(near, clash, "left_anti").withColumn("angle_idx", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))).withColumn("yaw", F.col("angle_idx") * cfg.rotation_interval)
    return p.withColumns({"tx": F.col("px") + F.cos(F.radians("yaw")), "ty": F.col("py") + F.sin(F.radians("yaw")), "tz": F.col("pz"), "pitch": F.lit(0.0), "radius": F.lit(0.0)})


def strided(poses: DataFrame, most: int = MAX_ROTATION_POSES) -> DataFrame:
    """Every so many-th pose of a scene, `most` at the most, in order, with `pose` from 0."""
    scene = Window.partitionBy("scene_id")
    p = poses.withColumn("n", F.count(F.lit(1)).over(scene)).withColumn("at", F.row_number().over(scene.orderBy("room_idx", "angle_idx")) - 1)
    step = F.greatest(F.lit(1), F.floor(F.col("n") / most)).cast("int")
    return p.withColumn("step", F.when(F.col("n") > most, step).otherwise(1)).where((F.col("at") % F.col("step") == 0) & (F.col("at") / F.col("step") < most)).withColumn("pose", (F.col("at") / F.col("step")).cast("int")).drop("n", "at", "step")


def dense_index(rows: DataFrame, key: list[str], scope: list[str], order: list[str], name: str = "pose_idx") -> DataFrame:
    """Rows with a dense index of their key within the scope, by first appearance."""
    first = rows.groupBy(*scope, *key).agg(F.min(F.struct(*order)).alias("_first"))
    numbered = first.withColumn(name, (F.row_number().over(Window.partitionBy(*scope).orderBy("_first")) - 1).cast("int")).drop("_first")
    return rows.join(numbered, [*scope, *key])


def pose_struct(target_labels: Column) -> Column:
    return F.struct(F.array("px", "py", "pz").alias("position"), F.array("tx", "ty", "tz").alias("target"), F.col("yaw"), F.col("pitch"), F.col("radius"), target_labels.alias("target_objects"))


def read_pose(p: Column, legacy_position: Column | None = None, legacy_target: Column | None = None) -> dict[str, Column]:
    """Flat pose columns of a nested pose, older field names included."""
    position = F.coalesce(p["position"], legacy_position) if legacy_position is not None else p["position"]
    target = F.coalesce(p["target"], legacy_target) if legacy_target is not None else p["target"]
    return {f"p{a}": F.get(position, F.lit(i)) for i, a in enumerate("xyz")} | {f"t{a}": F.get(target, F.lit(i)) for i, a in enumerate("xyz")} | {"yaw": p["yaw"], "pitch": p["pitch"], "radius": p["radius"]}
