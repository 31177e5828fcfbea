"""How much of the image boxes cover, and how much of a box nearer boxes cover.

Outlines are the convex hulls of the projected corners that lie in front of the camera, clamped to the image. Hulls and
masks have no built-in, so these two run on Arrow batches; a task holds one batch, or one candidate's own scene.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomweave.config import Cameras
from roomweave.operators.visibility import with_projection


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull in order round it."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def half(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for r in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (r[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (r[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(r)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def hull_area(points: np.ndarray) -> float:
    h = hull(points)
    if len(h) < 3:
        return 0.0
    x, y = h[:, 0], h[:, 1]
    return float(abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2)


def _places(cfg: Cameras) -> Column:
    """[u, v] of the corners in front, clamped to the image, in one array."""
    clamp = lambda c, n: F.least(F.greatest(c, F.lit(0.0)), F.lit(float(n - 1)))
    return F.filter(F.array(*(F.when(F.col(f"w{i}") > 1e-6, F.array(clamp(F.col(f"u{i}"), cfg.image_width), clamp(F.col(f"v{i}"), cfg.image_height))) for i in range(8))), lambda p: p.isNotNull())


@F.pandas_udf(T.DoubleType())
def _area(places: pd.Series) -> pd.Series:
    return places.map(lambda p: hull_area(np.array([list(q) for q in p])) if p is not None and len(p) >= 3 else 0.0).astype(float)


def projected_area(candidates: DataFrame, cfg: Cameras | None = None) -> DataFrame:
    """With `area` in pixels and `area_ratio` of the image; 0 for fewer than three corners in front."""
    cfg = cfg or Cameras()
    seen = with_projection(candidates, cfg).withColumn("area", _area(_places(cfg))).select(*candidates.columns, "area")
    return seen.withColumn("area_ratio", F.col("area") / float(cfg.image_width * cfg.image_height))


def mask(points: np.ndarray, width: int, height: int) -> np.ndarray:
    """Pixels in or on the hull of whole-numbered points."""
    h = hull(np.trunc(points))
    ys, xs = np.mgrid[0:height, 0:width]
    if len(h) < 3:
        out = np.zeros((height, width), bool)
        for x, y in h.astype(int):
            out[y, x] = True
        return out
    inside = np.ones((height, width), bool)
    for a, b in zip(h, np.roll(h, -1, axis=0), strict=True):
        inside &= (b[0] - a[0]) * (ys - a[1]) - (b[1] - a[1]) * (xs - a[0]) >= 0
    return inside


Rows = tuple[int, np.ndarray, np.ndarray]


def spans(points: np.ndarray) -> list[Rows]:
    """The pixels of `mask` as pieces of consecutive rows: first row, first and last column of each (empty where last < first)."""
    h = hull(np.trunc(points)).astype(np.int64)
    if len(h) < 3:
        return [(int(y), np.array([x]), np.array([x])) for x, y in h]
    ys = np.arange(h[:, 1].min(), h[:, 1].max() + 1)
    dx, dy = (np.roll(h, -1, axis=0) - h).T[:, :, None]
    across = dx * (ys - h[:, 1:])
    left, right = dy[:, 0] < 0, dy[:, 0] > 0
    first = (h[left, :1] - (-across[left]) // dy[left]).max(axis=0)
    last = (h[right, :1] + across[right] // dy[right]).min(axis=0)
    return [(int(ys[0]), first, last)]


def pixels(pieces: list[Rows]) -> int:
    return int(sum(np.maximum(last - first + 1, 0).sum() for _, first, last in pieces))


def pixels_under(pieces: list[Rows], over: list[Rows]) -> int:
    """How many of the pieces' pixels lie in any of the pieces over them, each counted once."""
    hidden = 0
    for y, first, last in pieces:
        meets = [o for o in over if o[0] < y + len(first) and y < o[0] + len(o[1])]
        if not meets:
            continue
        a, b = np.ones((len(meets), len(first)), np.int64), np.zeros((len(meets), len(first)), np.int64)
        for k, (oy, ofirst, olast) in enumerate(meets):
            start, end = max(y, oy), min(y + len(first), oy + len(ofirst))
            a[k, start - y:end - y], b[k, start - y:end - y] = ofirst[start - oy:end - oy], olast[start - oy:end - oy]
        a, b = np.maximum(a, first), np.minimum(b, last)
        order = np.argsort(a, axis=0)
        a, b = np.take_along_axis(a, order, 0), np.take_along_axis(b, order, 0)
        done = np.vstack([np.full((1, len(first)), -1), np.maximum.accumulate(b, axis=0)[:-1]])
        hidden += int(np.maximum(b - np.maximum(a, done + 1) + 1, 0).sum())
    return hidden


def covered_area(candidates: DataFrame, occluders: DataFrame, keys: list[str], cfg: Cameras | None = None, depth: str = "min") -> DataFrame:
    """keys, target and covered pixels and their ratios: pixels of a box's outline under outlines of boxes nearer to the camera.

    The outlines that meet in a task are those of one scene and one view.
    """
    cfg = cfg or Cameras()
    front = F.filter(F.array(*(F.col(f"w{i}") for i in range(8))), lambda w: w > 1e-6)
    far = F.array_min(front) if depth == "min" else F.aggregate(front, F.lit(0.0), lambda a, w: a + w) / F.size(front)
    outline = lambda d: with_projection(d, cfg).withColumn("places", _places(cfg)).withColumn("far", far)
    target = outline(candidates).select("scene_id", *(k for k in keys if k != "scene_id"), F.col("id").alias("_id"), "places", "far", "px", "py", "pz", "tx", "ty", "tz")
    box = ["id", *(f"{a}{n}" for a in "xyz" for n in (0, 1))]
    views = candidates.select("scene_id", "px", "py", "pz", "tx", "ty", "tz").distinct()
    others = outline(views.join(occluders.select("scene_id", *box), "scene_id")).where(F.size("places") >= 3)
    view = ["scene_id", "px", "py", "pz", "tx", "ty", "tz"]
    nearer = target.join(others.select(*view, F.col("id").alias("_other"), F.col("places").alias("_places"), F.col("far").alias("_far")), view, "left")
    counts = (F.col("_other") != F.col("_id")) & (F.col("_far") < F.col("far") - 1e-3)
    gathered = nearer.groupBy(*keys).agg(F.first("places").alias("places"), F.collect_list(F.when(counts, F.col("_places"))).alias("over"))
    kept = [gathered.schema[k] for k in keys]
    schema = T.StructType([*kept, *(T.StructField(n, T.DoubleType()) for n in ("target_px", "covered_px", "visible_px", "ratio_of_target", "ratio_of_image"))])

    def measure(batches):
        for pdf in batches:
            rows = []
            for places, over in zip(pdf["places"], pdf["over"], strict=True):
                if places is None or len(places) < 3:
                    rows.append((0.0,) * 5)
                    continue
                own = spans(np.array([list(p) for p in places]))
                top = [piece for o in over for piece in spans(np.array([list(p) for p in o]))]
                n, hidden = float(pixels(own)), float(pixels_under(own, top))
                rows.append((n, hidden, n - hidden, hidden / n if n else 0.0, hidden / (cfg.image_width * cfg.image_height)))
            yield pd.concat([pdf[keys].reset_index(drop=True), pd.DataFrame(rows, columns=schema.names[len(keys):])], axis=1)

    return gathered.mapInPandas(measure, schema)
