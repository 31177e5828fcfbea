"""Scene geometry as Column expressions: vectors are tuples of three scalar columns, so all of it stays in generated code."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]
INF = 1e300


def vec(prefix: str, table: str = "") -> Vec:
    """Columns prefix+x, +y, +z."""
    at = f"{table}." if table else ""
    return F.col(f"{at}{prefix}x"), F.col(f"{at}{prefix}y"), F.col(f"{at}{prefix}z")


def of_array(a: Column) -> Vec:
    return a[0], a[1], a[2]


def pack(v: Vec) -> Column:
    return F.array(*v)


def sub(a: Vec, b: Vec) -> Vec:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def add(a: Vec, b: Vec) -> Vec:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def scale(a: Vec, k: Column) -> Vec:
    return a[0] * k, a[1] * k, a[2] * k


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: Vec, b: Vec) -> Column:
    return norm(sub(a, b))


def either(test: Column, a: Vec, b: Vec) -> Vec:
    return tuple(F.when(test, x).otherwise(y) for x, y in zip(a, b, strict=True))


def lits(x: float, y: float, z: float) -> Vec:
    return F.lit(float(x)), F.lit(float(y)), F.lit(float(z))


def staged(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Columns that are computed here once: a one-row generator keeps filters above from copying their expressions."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def round2(x: Column) -> Column:
    """Two decimals, halves of the scaled value to even."""
    return F.rint(x * 100.0) / 100.0


# -- boxes -------------------------------------------------------------------------------------------------------------


def box_gap(a0: Vec, a1: Vec, b0: Vec, b1: Vec) -> Column:
    gaps = tuple(F.greatest(F.lit(0.0), p - s, r - q) for p, q, r, s in zip(a0, a1, b0, b1, strict=True))
    return norm(gaps)


def box_overlap(a0: Vec, a1: Vec, b0: Vec, b1: Vec) -> Column:
    """Shared volume over the smaller volume; 0 for boxes that don't meet or have no volume."""
    sides = [F.least(q, s) - F.greatest(p, r) for p, q, r, s in zip(a0, a1, b0, b1, strict=True)]
    volume = lambda lo, hi: reduce(lambda x, y: x * y, (h - l for l, h in zip(lo, hi, strict=True)))  # noqa: E731, E741
    shared = sides[0] * sides[1] * sides[2]
    apart = (sides[0] <= 0) | (sides[1] <= 0) | (sides[2] <= 0)
    return F.when(apart, 0.0).otherwise(F.coalesce(F.try_divide(shared, F.least(volume(a0, a1), volume(b0, b1))), F.lit(0.0)))


def box_corners(b0: Vec, b1: Vec) -> list[Vec]:
    """The eight corners, x slowest, z fastest."""
    return [(x, y, z) for x in (b0[0], b1[0]) for y in (b0[1], b1[1]) for z in (b0[2], b1[2])]


def in_box(p: Vec, b0: Vec, b1: Vec, margin: float = 0.0) -> Column:
    return reduce(lambda x, y: x & y, ((v >= lo - margin) & (v <= hi + margin) for v, lo, hi in zip(p, b0, b1, strict=True)))


def in_box_2d(p: Vec, b0: Vec, b1: Vec, shrink: float = 0.0) -> Column:
    return reduce(lambda x, y: x & y, ((v >= lo + shrink) & (v <= hi - shrink) for v, lo, hi in list(zip(p, b0, b1, strict=True))[:2]))


def ray_box(o: Vec, d: Vec, b0: Vec, b1: Vec) -> tuple[Column, Column, Column]:
    """(enter, leave, hit) by slabs; a ray along a slab misses if it starts outside of it."""
    enter, leave, outside = [], [], []
    for oi, di, lo, hi in zip(o, d, b0, b1, strict=True):
        flat = F.abs(di) < 1e-12
        inverse = F.try_divide(F.lit(1.0), di)
        t1, t2 = (lo - oi) * inverse, (hi - oi) * inverse
        enter.append(F.when(flat, -INF).otherwise(F.least(t1, t2)))
        leave.append(F.when(flat, INF).otherwise(F.greatest(t1, t2)))
        outside.append(flat & ((oi < lo) | (oi > hi)))
    first, last = F.greatest(*enter), F.least(*leave)
    hit = ~(outside[0] | outside[1] | outside[2]) & (last >= F.greatest(first, F.lit(0.0)))
    return first, last, hit


def aimed_at(df: DataFrame, camera: Vec, point: Vec) -> DataFrame:
    """With the distance `far` and the unit direction ux, uy, uz from the camera to a point."""
    df = staged(df, {"far": distance(point, camera)})
    return staged(df, {f"u{a}": F.try_divide(x, F.col("far")) for a, x in zip("xyz", sub(point, camera), strict=True)})


def blocks(camera: Vec, b0: Vec, b1: Vec, eps: float = 1e-3) -> Column:
    """Whether a box lies between camera and the point aimed at: the ray enters it at or after the camera and before the point."""
    first, _, hit = ray_box(camera, vec("u"), b0, b1)
    far = F.col("far")
    return F.coalesce((far >= 1e-6) & hit & (first >= 0) & (first <= far - eps), F.lit(False))


# -- plane -------------------------------------------------------------------------------------------------------------


def in_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """Even-odd rule over an array of [x, y]; false for fewer than three points."""

    def crossed(i: Column) -> Column:
        a, b = polygon[i], polygon[F.when(i == 0, F.size(polygon) - 1).otherwise(i - 1)]
        return ((F.get(a, F.lit(1)) > y) != (F.get(b, F.lit(1)) > y)) & (x < (F.get(b, F.lit(0)) - F.get(a, F.lit(0))) * (y - F.get(a, F.lit(1))) / (F.get(b, F.lit(1)) - F.get(a, F.lit(1)) + 1e-12) + F.get(a, F.lit(0)))

    odd = F.aggregate(F.sequence(F.lit(0), F.size(polygon) - 1), F.lit(False), lambda acc, i: acc != F.coalesce(crossed(i), F.lit(False)))
    return F.when(F.coalesce(F.size(polygon), F.lit(0)) >= 3, odd).otherwise(False)


def polygon_area(polygon: Column) -> Column:
    """Shoelace area; 0 for fewer than three points."""

    def term(i: Column) -> Column:
        a, b = polygon[i], polygon[F.when(i == F.size(polygon) - 1, 0).otherwise(i + 1)]
        return F.get(a, F.lit(0)) * F.get(b, F.lit(1)) - F.get(b, F.lit(0)) * F.get(a, F.lit(1))

    total = F.aggregate(F.sequence(F.lit(0), F.size(polygon) - 1), F.lit(0.0), lambda acc, i: acc + term(i))
    return F.when(F.coalesce(F.size(polygon), F.lit(0)) >= 3, F.abs(total) / 2).otherwise(0.0)


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    t = F.when(length2 < 1e-12, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide((px - ax) * dx + (py - ay) * dy, length2))))
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def boundary_distance(x: Column, y: Column, polygon: Column) -> Column:
    """Least distance to an edge; infinite for fewer than three points."""

    def one(i: Column) -> Column:
        a, b = polygon[i], polygon[F.when(i == F.size(polygon) - 1, 0).otherwise(i + 1)]
        return segment_distance(x, y, *(F.get(p, F.lit(k)) for p in (a, b) for k in (0, 1)))

    return F.when(F.coalesce(F.size(polygon), F.lit(0)) >= 3, F.array_min(F.transform(F.sequence(F.lit(0), F.size(polygon) - 1), one))).otherwise(float("inf"))


def vertex_mean(polygon: Column, axis: int) -> Column:
    return F.aggregate(polygon, F.lit(0.0), lambda acc, p: acc + F.get(p, F.lit(axis))) / F.size(polygon)


# -- cameras -----------------------------------------------------------------------------------------------------------


def intrinsics(width: int, height: int, fov_deg: float) -> tuple[float, float, float, float]:
    """(fx, fy, cx, cy) of a pinhole whose horizontal field of view is given."""
    f = width / (2 * math.tan(math.radians(fov_deg) / 2))
    return f, f, width / 2, height / 2


def with_view(df: DataFrame) -> DataFrame:
    """With the axes of the camera px, py, pz that looks at tx, ty, tz, as columns right_x … forward_z."""
    camera, target = vec("p"), vec("t")
    far = distance(target, camera)
    forward = either(far < 1e-8, lits(0, 1, 0), tuple(F.try_divide(x, far) for x in sub(target, camera)))
    df = staged(df, {f"forward_{a}": x for a, x in zip("xyz", forward, strict=True)})
    f = vec("forward_")
    side = cross(f, lits(0, 0, 1))
    wide = norm(side)
    right = either(wide < 1e-6, lits(1, 0, 0), tuple(F.try_divide(x, wide) for x in side))
    df = staged(df, {f"right_{a}": x for a, x in zip("xyz", right, strict=True)})
    return staged(df, {f"up_{a}": x for a, x in zip("xyz", cross(vec("right_"), f), strict=True)})


VIEW = tuple(f"{n}_{a}" for n in ("right", "up", "forward") for a in "xyz")


def axes_of_view() -> tuple[Vec, Vec, Vec]:
    return vec("right_"), vec("up_"), vec("forward_")


def to_view(point: Vec, camera: Vec, axes: tuple[Vec, Vec, Vec]) -> Vec:
    """Coordinates of a point along (-right, up, forward) from the camera."""
    right, up, forward = axes
    rel = sub(point, camera)
    return -dot(right, rel), dot(up, rel), dot(forward, rel)


def render_axes(camera: Vec, target: Vec) -> tuple[Vec, Vec, Vec]:
    """(right, down, forward) as renderers use them; other fallbacks than with_view."""
    look = sub(target, camera)
    far = norm(look)
    forward = either(far < 1e-8, lits(0, 0, 1), tuple(F.try_divide(x, far) for x in look))
    side = cross(forward, lits(0, 0, 1))
    flat = norm(side) < 1e-6
    other = cross(forward, lits(0, 1, 0))
    chosen = either(flat, other, side)
    wide = norm(chosen)
    right = either(wide < 1e-12, lits(1, 0, 0), tuple(F.try_divide(x, wide) for x in chosen))
    return right, cross(forward, right), forward


def with_render_axes(df: DataFrame) -> DataFrame:
    """render_axes of the camera p and its look target t as columns right_x … forward_z, each step computed once."""
    camera, target = vec("p"), vec("t")
    look, far = sub(target, camera), distance(target, camera)
    df = staged(df, {f"forward_{a}": c for a, c in zip("xyz", either(far < 1e-8, lits(0, 0, 1), tuple(F.try_divide(x, far) for x in look)), strict=True)})
    forward = vec("forward_")
    side = cross(forward, lits(0, 0, 1))
    df = staged(df, {f"_side_{a}": c for a, c in zip("xyz", either(norm(side) < 1e-6, cross(forward, lits(0, 1, 0)), side), strict=True)})
    wide = norm(vec("_side_"))
    df = staged(df, {f"right_{a}": c for a, c in zip("xyz", either(wide < 1e-12, lits(1, 0, 0), tuple(F.try_divide(x, wide) for x in vec("_side_"))), strict=True)})
    return staged(df, {f"down_{a}": c for a, c in zip("xyz", cross(forward, vec("right_")), strict=True)}).drop(*(f"_side_{a}" for a in "xyz"))


def project(point: Vec, k: tuple[float, float, float, float]) -> tuple[Column, Column, Column]:
    """(u, v, depth); u and v are null behind the camera."""
    fx, fy, cx, cy = k
    front = point[2] > 1e-6
    return F.when(front, fx * F.try_divide(point[0], point[2]) + cx), F.when(front, fy * F.try_divide(point[1], point[2]) + cy), point[2]


def in_image(point: Vec, k: tuple[float, float, float, float], width: int, height: int, border: float) -> Column:
    u, v, _ = project(point, k)
    return F.coalesce(u.between(border, width - 1 - border) & v.between(border, height - 1 - border), F.lit(False))


def to_camera_space(v: Vec, yaw: Column, pitch: Column) -> Vec:
    """A world vector turned by yaw and pitch in degrees, as the vector questions give it."""
    w, p = F.radians(yaw), F.radians(pitch)
    y = v[1] * F.cos(p) - v[2] * F.sin(p)
    z = v[1] * F.sin(p) + v[2] * F.cos(p)
    return v[0] * F.cos(w) - z * F.sin(w), y, v[0] * F.sin(w) + z * F.cos(w)


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def count_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, (t.cast("int") for t in tests))


def over(points: list[Vec], test: Callable[[Vec], Column]) -> list[Column]:
    return [test(p) for p in points]


def camera_matrix(camera: Vec, target: Vec) -> tuple[Vec, Vec, Vec]:
    """(right, down, forward) with the fallbacks of the sampler: forward along y, right along x."""
    look = sub(target, camera)
    far = norm(look)
    forward = either(far < 1e-8, lits(0, 1, 0), tuple(F.try_divide(x, far) for x in look))
    side = cross(forward, lits(0, 0, 1))
    wide = norm(side)
    right = either(wide < 1e-6, lits(1, 0, 0), tuple(F.try_divide(x, wide) for x in side))
    return right, cross(forward, right), forward


def pose_matrix(camera: Vec, target: Vec) -> Column:
    """The 4x4 camera-to-world matrix of a renderer, as rows."""
    right, down, forward = render_axes(camera, target)
    row = lambda i: F.array(right[i], down[i], forward[i], camera[i])
    return F.array(row(0), row(1), row(2), F.array(*(F.lit(float(x)) for x in (0, 0, 0, 1))))


def rotation_struct(yaw: Column, pitch: Column) -> Column:
    return F.struct(pitch.alias("x"), yaw.alias("y"), F.lit(0.0).alias("z"))


def position_struct(position: Vec) -> Column:
    return F.struct(*(c.alias(a) for a, c in zip("xyz", position, strict=True)))
