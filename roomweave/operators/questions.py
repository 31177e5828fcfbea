"""Question constructors: every type is one projection of objects, pairs or samples and a pose.

Each constructor takes a table with the flat columns of its objects (a_, b_, …) and, where it needs one, of the pose, and
returns rows of (question_type, dim, primary_object, question_id, value, answer, question, …). Random choices come from md5
over names, so they don't hang on partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomweave.config import Questions
from roomweave.functions import geometry as g
from roomweave.operators.cameras import uniform
from roomweave.operators.selection import measures

DIMENSIONS = ("length", "width", "height")

# The wording of questions and prompts.
BASE_NOTE = "Length and width are the two dimensions that define the 'base' of the object. Of these two base dimensions, let length be the longer and width be the shorter."
SIZE = "What is the estimated {dimension} of the {object} in this scene in meters? \n" + BASE_NOTE
SIZE_RATIO = "What is the ratio of the {dimension} of {object1} to the {dimension} of {object2}? \n" + BASE_NOTE
SIZE_ABSOLUTE = "If {object2} has a {dimension} of {obj2_dimension} meters, what is the {dimension} of {object1}? \n" + BASE_NOTE
PAIR_DISTANCE = "What is the absolute distance between {object1} and {object2} in meters?"
MULTI_ABSOLUTE = "If the distance between {objectX} and {objectY} is {distance} meter(s), what is the distance between {objectA} and {objectB} in meters?"
MULTI_RATIO = "What is the ratio of the distance between {objectA} and {objectB} to the distance between {objectX} and {objectY}?"
PAIR_DISTANCE_SIZED = "What is the absolute distance between {object1} and {object2} in meters, given that the {dimension} of {object1} is {obj1_dimension} meter(s)?"
CAMERA_DISTANCE = "What is the estimated distance of the {object} from the camera in meters?"
VECTOR = (
    "Using the agent's local coordinate system, provide the vector from the center of {objectA} to the center of {objectB} in meters.\n\n"
    "The coordinate system is defined as follows:\n* **Origin:** By definition, the agent is at the origin ([0,0,0]).\n"
    "* **X-axis:** Left-to-right (positive X is to the right of the agent).\n* **Y-axis:** Up-and-down (positive Y is up).\n"
    "* **Z-axis:** Forward-and-backward (positive Z is further away from the camera).\n\nThe answer should be in the format: [x, y, z]."
)
LARGER = "Is the {object1} larger than the {object2}?"
FARTHER_APART = "Is the distance between the {object1} and the {object2} larger than the distance between the {object1} and the {object3}?"
FARTHER = "Is the {object1} further from the camera than the {object2}?"
DISTANCE_POST = "Please assume the distance is measured from the approximated center of each object, and briefly explain the method used to determine the center."
NUMBER_POST = "The answer should be a single NUMBER given to two decimal places."
LETTER_POST = "The answer should be the single multiple-choice LETTER answer, formatted as a string."
VECTOR_POST = "The answer should be a 3-element vector [x, y, z] with each component given to two decimal places."
_HINTS = "[Hints]\nNote that the field-of-view of the camera is 60 degrees.\n\n[Output]\nYou have to end your response with the answer formatted in a dictionary: "
NUMBER_OUT = _HINTS + "{'answer': <number>}. For example, {'answer': 1.25}."
LETTER_OUT = _HINTS + "{'answer': '<letter>'}. For example, {'answer': 'A'}."
VECTOR_OUT = _HINTS + "{'answer': [x, y, z]}. For example, {'answer': [1.25, -0.50, 3.00]}."


def fill(template: str, **names: Column) -> Column:
    """A template with {name} parts replaced by columns."""
    parts, rest = [], template
    while rest:
        at = min((i for n in names if (i := rest.find("{" + n + "}")) >= 0), default=-1)
        if at < 0:
            parts.append(F.lit(rest))
            break
        name = rest[at + 1 : rest.index("}", at)]
        parts += [F.lit(rest[:at])] * (at > 0) + [names[name]]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def number(x: Column) -> Column:
    """A value as the answer's text, two decimals at most."""
    return g.round2(x).cast("string")


def _text(*parts: Column | str) -> Column:
    return F.concat_ws(" ", *(F.lit(p) if isinstance(p, str) else p for p in parts))


def _dims(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """A row a dimension, with its value of each object as <prefix>value."""
    exploded = df.withColumn("dim", F.explode(F.array(*(F.lit(d) for d in DIMENSIONS))))
    pick = lambda p: reduce(lambda acc, d: acc.when(F.col("dim") == d, measures(p)[d]), DIMENSIONS[1:], F.when(F.col("dim") == DIMENSIONS[0], measures(p)[DIMENSIONS[0]]))
    return exploded.withColumns({f"{p}value": pick(p) for p in prefixes})


def _center(p: str) -> g.Vec:
    return tuple(F.col(f"{p}c{a}") for a in "xyz")


def _made(df: DataFrame, kind: str, value: Column, id_parts: list[str], question: Column, answer: Column | None = None) -> DataFrame:
    ids = F.concat_ws("_", F.lit(kind), *(F.col(c) for c in id_parts))
    return df.withColumns({"question_type": F.lit(kind), "value": value, "question_id": ids, "question": question}).withColumn("answer", number(F.col("value")) if answer is None else answer)


# -- numbers -----------------------------------------------------------------------------------------------------------


def object_size(objects: DataFrame) -> DataFrame:
    d = _dims(objects, ["a_"])
    q = fill(SIZE, dimension=F.col("dim"), object=F.col("a_label"))
    return _made(d, "object_size", F.col("a_value"), ["a_id", "dim"], _text(q, NUMBER_POST, NUMBER_OUT)).withColumn("base", q)


def distance_to_camera(objects: DataFrame) -> DataFrame:
    q = fill(CAMERA_DISTANCE, object=F.col("a_label"))
    return _made(objects, "object_distance_to_camera", g.distance(_center("a_"), g.vec("p")), ["a_id"], _text(q, DISTANCE_POST, NUMBER_POST, NUMBER_OUT)).withColumn("base", q)


def size_ratio(pairs: DataFrame) -> DataFrame:
    d = _dims(pairs, ["a_", "b_"])
    q = fill(SIZE_RATIO, dimension=F.col("dim"), object1=F.col("a_label"), object2=F.col("b_label"))
    return _made(d, "object_size_comparison_relative", F.col("a_value") / (F.col("b_value") + 1e-9), ["a_id", "b_id", "dim"], _text(q, NUMBER_POST, NUMBER_OUT))


def size_absolute(pairs: DataFrame) -> DataFrame:
    d = _dims(pairs, ["a_", "b_"])
    q = fill(SIZE_ABSOLUTE, dimension=F.col("dim"), object1=F.col("a_label"), object2=F.col("b_label"), obj2_dimension=number(F.col("b_value")))
    return _made(d, "object_size_comparison_absolute", F.col("a_value"), ["a_id", "b_id", "dim"], _text(q, NUMBER_POST, NUMBER_OUT))


def pair_distance(pairs: DataFrame) -> DataFrame:
    q = fill(PAIR_DISTANCE, object1=F.col("a_label"), object2=F.col("b_label"))
    return _made(pairs, "object_pair_distance_center", g.distance(_center("a_"), _center("b_")), ["a_id", "b_id"], _text(q, DISTANCE_POST, NUMBER_POST, NUMBER_OUT)).withColumn("base", q)


def pair_distance_sized(pairs: DataFrame) -> DataFrame:
    d = _dims(pairs, ["a_"]).where(F.col("a_value") >= 0.01)
    q = fill(PAIR_DISTANCE_SIZED, object1=F.col("a_label"), object2=F.col("b_label"), dimension=F.col("dim"), obj1_dimension=number(F.col("a_value")))
    return _made(d, "object_pair_distance_center_w_size", g.distance(_center("a_"), _center("b_")), ["a_id", "b_id", "dim"], _text(q, DISTANCE_POST, NUMBER_POST, NUMBER_OUT))


def pair_vector(pairs: DataFrame) -> DataFrame:
    v = g.to_camera_space(g.sub(_center("b_"), _center("a_")), F.col("yaw"), F.col("pitch"))
    d = pairs.withColumns({f"v{a}": g.round2(x) for a, x in zip("xyz", v, strict=True)})
    q = fill(VECTOR, objectA=F.col("a_label"), objectB=F.col("b_label"))
    answer = F.concat(F.lit("["), F.concat_ws(", ", *(F.col(f"v{a}").cast("string") for a in "xyz")), F.lit("]"))
    return _made(d, "object_pair_distance_vector", F.lit(None).cast("double"), ["a_id", "b_id"], _text(q, DISTANCE_POST, VECTOR_POST, VECTOR_OUT), answer)


def _multi_ids(d: DataFrame, kind: str, value: Column, q: Column) -> DataFrame:
    return _made(d, kind, value, ["a_id", "b_id", "x_id", "y_id"], _text(q, DISTANCE_POST, NUMBER_POST, NUMBER_OUT))


def multi_absolute(four: DataFrame) -> DataFrame:
    xy = g.distance(_center("x_"), _center("y_"))
    q = fill(MULTI_ABSOLUTE, objectX=F.col("x_label"), objectY=F.col("y_label"), objectA=F.col("a_label"), objectB=F.col("b_label"), distance=number(xy))
    return _multi_ids(four, "object_comparison_absolute_distance", g.distance(_center("a_"), _center("b_")), q)


def multi_ratio(four: DataFrame) -> DataFrame:
    d = four.withColumn("d_xy", g.distance(_center("x_"), _center("y_"))).where(F.col("d_xy") >= 0.01)
    q = fill(MULTI_RATIO, objectX=F.col("x_label"), objectY=F.col("y_label"), objectA=F.col("a_label"), objectB=F.col("b_label"))
    return _multi_ids(d, "object_comparison_relative_distance", g.distance(_center("a_"), _center("b_")) / F.col("d_xy"), q)


# -- yes or no ---------------------------------------------------------------------------------------------------------


def _yes_no(d: DataFrame, kind: str, yes: Column, id_parts: list[str], q: Column, scope: list[str]) -> DataFrame:
    ids = F.concat_ws("_", F.lit(kind), *(F.col(c) for c in id_parts))
    d = d.withColumns({"question_type": F.lit(kind), "question_id": ids, "answer_text": F.when(yes, "Yes").otherwise("No")})
    first = F.when(uniform("yes_no", *(F.col(c) for c in scope), F.col("question_id")) < 0.5, "Yes").otherwise("No")
    d = d.withColumn("choices", F.map_from_arrays(F.array(F.lit("A"), F.lit("B")), F.array(first, F.when(first == "Yes", "No").otherwise("Yes"))))
    listed = F.concat(F.lit("\n\n(A) "), F.col("choices")["A"], F.lit("\n(B) "), F.col("choices")["B"])
    return d.withColumn("answer", F.when(F.col("choices")["A"] == F.col("answer_text"), "A").otherwise("B")).withColumn("question", _text(F.concat(q, listed), LETTER_POST, LETTER_OUT))


def relative_size(pairs: DataFrame, scope: list[str]) -> DataFrame:
    yes = measures("a_")["volume"] > measures("b_")["volume"]
    return _yes_no(pairs, "relative_size", yes, ["a_id", "b_id"], fill(LARGER, object1=F.col("a_label"), object2=F.col("b_label")), scope)


def relative_distance(three: DataFrame, scope: list[str]) -> DataFrame:
    yes = g.distance(_center("a_"), _center("b_")) > g.distance(_center("a_"), _center("x_"))
    return _yes_no(three, "relative_distance", yes, ["a_id", "b_id", "x_id"], fill(FARTHER_APART, object1=F.col("a_label"), object2=F.col("b_label"), object3=F.col("x_label")), scope)


def relative_distance_to_camera(pairs: DataFrame, scope: list[str]) -> DataFrame:
    yes = g.distance(_center("a_"), g.vec("p")) > g.distance(_center("b_"), g.vec("p"))
    return _yes_no(pairs, "relative_distance_to_camera", yes, ["a_id", "b_id"], fill(FARTHER, object1=F.col("a_label"), object2=F.col("b_label")), scope)


# -- four choices ------------------------------------------------------------------------------------------------------


def multiple_choice(made: DataFrame, scope: list[str], tries: int = 50) -> DataFrame:
    """Numerical questions (with `base` and `value`) as choices of four: three other values, all in hashed order.

    Other values are the right one times 0.3 to 0.7 or 1.3 to 2.5 (0.1 to 2 where that isn't positive), two decimals, none
    twice; should 50 tries not give three, values next to the right one fill up.
    """
    names = [F.col(c) for c in scope]
    u = lambda channel, i: uniform(channel, *names, F.col("question_id"), i)
    right = g.round2(F.col("value"))

    def one(i: Column) -> Column:
        return g.round2(F.col("right") * F.when(u("side", i) < 0.5, 0.3 + u("times", i) * 0.4).otherwise(1.3 + u("times", i) * 1.2))

    def usable(v: Column, i: Column) -> Column:
        return F.when(v > 0, v).otherwise(g.round2(0.1 + u("small", i) * 1.9))

    def drawn(values: Column) -> Column:
        return F.filter(F.array_distinct(F.transform(values, usable)), lambda v: v != F.col("right"))

    d = made.withColumns({"mc_source_type": F.col("question_type"), "right": right, "question_id": F.concat(F.lit("mc_"), F.col("question_id")), "question_type": F.lit("mc")})
    few = min(tries, 5)  # three of them differ nearly always; only other questions draw on
    d = g.staged(d, {"_few": F.array(*(one(F.lit(i)) for i in range(few)))})
    d = g.staged(d, {"_drawn": drawn(F.col("_few"))})
    spare = F.array(*(g.round2(F.col("right") + 0.51 * k) for k in range(1, 8)))
    every = F.array_distinct(F.concat(drawn(F.transform(F.sequence(F.lit(0), F.lit(tries - 1)), one)), spare))
    d = g.staged(d, {"others": F.when(F.size("_drawn") >= 3, F.slice("_drawn", 1, 3)).otherwise(F.slice(every, 1, 3))})
    placed = F.transform(F.concat(F.array("right"), F.col("others")), lambda v: F.struct(uniform("place", *names, F.col("question_id"), v).alias("k"), v.alias("v")))
    shuffled = F.transform(F.sort_array(placed), lambda s: s["v"])
    letters = F.array(*(F.lit(x) for x in "ABCD"))
    d = g.staged(d, {"values": shuffled}).withColumn("choices", F.map_from_arrays(letters, F.transform("values", lambda v: v.cast("string"))))
    listed = F.concat_ws("\n", *(F.concat(F.lit(f"({x}) "), F.col("values")[i].cast("string")) for i, x in enumerate("ABCD")))
    d = d.withColumn("answer", F.element_at(letters, F.array_position("values", F.col("right")).cast("int")))
    return d.withColumn("answer_value", F.col("right")).withColumn("question", _text(F.concat(F.col("base"), F.lit("\n\n"), listed), LETTER_POST, LETTER_OUT)).drop("right", "others", "values", "_few", "_drawn")


#: Constructors by question type; mc wraps the three types that have a `base`.
CONSTRUCTORS = {
    "object_size": object_size, "object_distance_to_camera": distance_to_camera, "object_size_comparison_relative": size_ratio, "object_size_comparison_absolute": size_absolute,
    "object_pair_distance_center": pair_distance, "object_pair_distance_center_w_size": pair_distance_sized, "object_pair_distance_vector": pair_vector,
    "object_comparison_absolute_distance": multi_absolute, "object_comparison_relative_distance": multi_ratio,
    "relative_size": relative_size, "relative_distance": relative_distance, "relative_distance_to_camera": relative_distance_to_camera, "mc": multiple_choice,
}

# -- samples -----------------------------------------------------------------------------------------------------------

KEEP = ["id", "label", "cx", "cy", "cz", "dx", "dy", "dz", "rank"]


def together(objects: DataFrame, scope: list[str]) -> DataFrame:
    """A row a scope with `seen`, its objects by rank; a scope holds what one pose shows, or a scene's focus objects."""
    return objects.groupBy(*scope).agg(F.sort_array(F.collect_list(F.struct("rank", *KEEP[:-1]))).alias("seen"))


def _ordered(objects: Column, u: Callable[[Column], Column], most: int) -> Column:
    """The first so many objects by their hashed number, then rank."""
    return F.transform(F.slice(F.sort_array(F.transform(objects, lambda o: F.struct(u(o).alias("u"), o["rank"].alias("rank"), o.alias("o")))), 1, most), lambda x: x["o"])


def _roles(d: DataFrame, keep: list[str], picks: dict[str, Column]) -> DataFrame:
    return d.select(*keep, *(o[c].alias(f"{r}_{c}") for r, o in picks.items() for c in KEEP))


def drawn(scopes: DataFrame, scope: list[str], channel: str, count: int, keep: list[str], most: int | None = None, apart: float | None = None) -> DataFrame:
    """draws of scopes with `seen`; with `apart`, the first `most` draws whose x and y are so far apart."""
    names = [F.col(c) for c in scope]
    three = F.size("seen") == 3
    fourth = lambda s, i: F.when(three, s[F.lit((0, 1, 0, 2)[i])]).otherwise(s[F.lit(i)])
    pick = lambda n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(k.alias("draw"), _ordered(F.col("seen"), lambda o: uniform(channel, *names, k, o["id"]), 4).alias("s")))
    d = scopes.where(F.size("seen") >= 3)
    if apart is None:
        chosen = pick(count)
    else:
        center = lambda o: tuple(o[f"c{a}"] for a in "xyz")
        far = lambda x: g.distance(center(fourth(x["s"], 2)), center(fourth(x["s"], 3))) >= apart
        d = g.staged(d, {"_first": F.filter(pick(most), far)})
        chosen = F.when(F.size("_first") >= most, F.col("_first")).otherwise(F.slice(F.filter(pick(count), far), 1, most))
    d = d.select(*keep, "seen", F.explode(chosen).alias("_d")).withColumn("draw", F.col("_d.draw"))
    return _roles(d, [*keep, "draw"], {r: fourth(F.col("_d.s"), i) for i, r in enumerate("abxy")})


def draws(focus: DataFrame, scope: list[str], channel: str, count: int) -> DataFrame:
    """`count` samples of distinct objects a scope: the four first in an order hashed anew for each draw, as a_, b_, x_, y_.

    With three objects a is shared: x is a, y the third. A scope holds at most the focus objects of a scene.
    """
    return drawn(together(focus, scope), scope, channel, count, scope)


def pivoted(scopes: DataFrame, scope: list[str], keep: list[str], most: int | None = None, channel: str = "pivot") -> DataFrame:
    """pivots of scopes with `seen`; the first `most` of a scope, by rank."""
    names = [F.col(c) for c in scope]
    others = lambda a: _ordered(F.filter("seen", lambda o: o["id"] != a["id"]), lambda o: uniform(channel, *names, a["id"], o["id"]), 2)
    chosen = F.filter(F.transform("seen", lambda a: F.struct(a.alias("a"), others(a).alias("o"))), lambda x: F.size(x["o"]) == 2)
    d = scopes.select(*keep, F.explode(F.slice(chosen, 1, most) if most else chosen).alias("_p"))
    return _roles(d, keep, {"a": F.col("_p.a"), "b": F.col("_p.o")[0], "x": F.col("_p.o")[1]})


def pivots(focus: DataFrame, scope: list[str], channel: str = "pivot") -> DataFrame:
    """For each object of a scope two others, first in hashed order, as a_, b_, x_."""
    return pivoted(together(focus, scope), scope, scope, None, channel)


def first_of_type(rows: DataFrame, scope: list[str], order: list[str], most: int) -> DataFrame:
    """At most so many questions of a type in a scope, in order."""
    w = Window.partitionBy(*scope, "question_type").orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).drop("_k")


# -- all questions of a pose -------------------------------------------------------------------------------------------

OUT = ["scene_id", "pattern_name", "pose", "stage", "item", "q_ord", "question_type", "question_id", "primary_object", "question", "answer", "answer_type", "answer_text", "answer_value", "mc_source_type", "choices", "object_ranks"]


def _shape(d: DataFrame, stage: int, q_ord: Column | int, objects: list[str], kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    missing = {c: F.lit(None).cast(t) for c, t in (("answer_text", "string"), ("answer_value", "double"), ("mc_source_type", "string"), ("choices", "map<string,string>")) if c not in d.columns}
    return d.withColumns(missing).withColumns({"stage": F.lit(stage), "q_ord": F.lit(q_ord) if isinstance(q_ord, int) else q_ord, "answer_type": F.lit(kind), "primary_object": F.col("a_id"), "object_ranks": F.array(*(F.col(f"{r}_rank") for r in objects))}).select(*OUT, *keep)


SCOPE = ["scene_id", "pattern_name", "pose"]


def for_poses(focus: DataFrame, pairs: DataFrame, single_poses: DataFrame, pair_poses: DataFrame, multi_poses: DataFrame, cfg: Questions | None = None, seen: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """All questions: singles and pairs on their poses, samples on the scene's; poses are (scene_id, pattern_name, pose, item, …).

    `seen` has the objects that each pose's samples are drawn from, all of the scene's unless it is given. `keep` names
    columns of the poses (and of `seen`), the same for all rows of a pose, that go along.
    """
    pose = ["pattern_name", "pose", "px", "py", "pz", "yaw", "pitch", *keep]
    a = focus.select("scene_id", F.col("rank").alias("item"), *(F.col(c).alias(f"a_{c}") for c in KEEP))
    s = a.join(single_poses.select("scene_id", "item", *pose), ["scene_id", "item"])
    p = pairs.withColumn("item", F.col("pair_ord")).join(pair_poses.select("scene_id", "item", *pose), ["scene_id", "item"])
    if seen is None:
        scopes = multi_poses.dropDuplicates(SCOPE).select(*SCOPE, *keep).join(together(focus, ["scene_id"]), "scene_id")
    else:
        scopes = together(seen, [*SCOPE, *keep])
    return of_rows(s, p, scopes, cfg, keep)


def of_rows(s: DataFrame, p: DataFrame, scopes: DataFrame, cfg: Questions | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """All questions on single objects (a_ and a pose), pairs (a_, b_ and a pose) and poses with `seen`.

    Types that are not enabled leave the plan on the driver.
    """
    cfg = cfg or Questions()
    on, scope = set(cfg.enabled_question_types), SCOPE
    dim = F.array_position(F.array(*(F.lit(x) for x in DIMENSIONS)), F.col("dim")).cast("int")
    shape = lambda *x: _shape(*x, keep)
    parts = []
    if "object_size" in on:
        parts.append(shape(object_size(s), 0, dim, ["a"], "numerical"))
    if "object_distance_to_camera" in on:
        parts.append(shape(distance_to_camera(s), 0, 10, ["a"], "numerical"))
    if "mc" in on:
        parts += [shape(multiple_choice(object_size(s), scope), 0, dim + 20, ["a"], "mc"), shape(multiple_choice(distance_to_camera(s), scope), 0, 30, ["a"], "mc")]
    for k, (name, f) in enumerate((("object_size_comparison_relative", size_ratio), ("object_size_comparison_absolute", size_absolute), ("object_pair_distance_center", pair_distance), ("object_pair_distance_center_w_size", pair_distance_sized), ("object_pair_distance_vector", pair_vector))):
        if name in on:
            made = f(p)
            parts.append(shape(made, 1, dim + 10 * k if "dim" in made.columns else 10 * k, ["a", "b"], "numerical"))
    if "relative_size" in on:
        parts.append(shape(relative_size(p, scope), 1, 50, ["a", "b"], "mc"))
    if "relative_distance_to_camera" in on:
        parts.append(shape(relative_distance_to_camera(p, scope), 1, 60, ["a", "b"], "mc"))
    if "mc" in on:
        parts.append(shape(multiple_choice(pair_distance(p), scope), 1, 70, ["a", "b"], "mc"))
    k = cfg.max_questions_per_type
    own = [*scope, *keep]
    if "object_comparison_absolute_distance" in on:
        made = multi_absolute(drawn(scopes, scope, "object_comparison_absolute_distance", k, own)).withColumn("item", F.col("draw"))
        parts.append(shape(made, 2, F.col("draw"), ["a", "b", "x", "y"], "numerical"))
    if "object_comparison_relative_distance" in on:
        made = multi_ratio(drawn(scopes, scope, "object_comparison_relative_distance", 2 * k, own, k, 0.01)).withColumn("item", F.col("draw"))
        parts.append(shape(made, 2, F.lit(100) + F.col("draw"), ["a", "b", "x", "y"], "numerical"))
    if "relative_distance" in on:
        made = relative_distance(pivoted(scopes, scope, own, k), scope).withColumn("item", F.col("a_rank"))
        parts.append(shape(made, 2, F.lit(200) + F.col("a_rank"), ["a", "b", "x"], "mc"))
    if not parts:
        raise ValueError("no question type is enabled")
    return reduce(DataFrame.unionByName, parts)


def capped(rows: DataFrame, most: int) -> DataFrame:
    """The first so many questions of each scene and pattern in order of emission."""
    w = Window.partitionBy("scene_id", "pattern_name").orderBy("stage", "item", "pose", "q_ord", "question_id")
    return rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).drop("_k")


def enough_views(rows: DataFrame, least: int) -> DataFrame:
    """Questions that at least so many poses of their scene show; all of them for 0."""
    if least <= 0:
        return rows
    seen = rows.groupBy("scene_id", "question_id").agg(F.countDistinct("camera_pose_idx").alias("views")).where(F.col("views") >= least)
    return rows.join(seen.select("scene_id", "question_id"), ["scene_id", "question_id"], "left_semi")


