"""Where attempts on spheres can't be accepted, by cells of radius, height angle and side.

A cell is left out only where a test of `attempts` refuses each of its places, with room for rounding: no allowed height, a
target's centre out of the image, outside bounds or rooms, within one box, or a target's centre behind one wall. Whatever lies
in the other cells is for the tests themselves, so that the same attempts are accepted with cells and without.
"""

from __future__ import annotations

import math

import numpy as np

from roomweave.config import Cameras

#: Cells of an item by radius, cosine and side; those left at one level are cut in eight.
LEVELS = ((4, 8, 16), (8, 16, 32), (16, 32, 64))
#: Items with more cells left at a level are not looked at more closely; cells looked at together.
FEW, CELLS = (math.inf, 60), 16384
EPS = 1e-6


def live(of, which: np.ndarray, cfg: Cameras, border: float) -> tuple[np.ndarray, np.ndarray]:
    """(1 + place in which, radius, cosine, side): the cells at the last level where attempts can be accepted; 0 has them all.

    Before them, the same for any side.
    """
    out = np.zeros((1 + len(which), *LEVELS[-1]), bool)
    out[0] = True
    who, *at = (x.ravel() for x in np.indices((len(which), *LEVELS[0])))
    around = _Around(of, cfg)
    for level, shape in enumerate(LEVELS):
        if level:
            who = np.repeat(who, 8)
            at = [(2 * x[:, None] + [k >> a & 1 for k in range(8)]).ravel() for a, x in enumerate(at)]
        with np.errstate(all="ignore"):
            parts = [slice(k, k + CELLS) for k in range(0, len(who), CELLS)]
            left = np.concatenate([who[:0], *(c.start + _possible(around, which[who[c]], [(x[c] / n, (x[c] + 1) / n) for x, n in zip(at, shape, strict=True)], cfg, border) for c in parts)])
        who, at = who[left], [x[left] for x in at]
        many = np.bincount(who, minlength=len(which)) > (FEW[level] if level < len(FEW) else -1)
        done, f = many[who], LEVELS[-1][0] // shape[0]
        r, q, t = (x[done] for x in at)
        out.reshape(1 + len(which), shape[0], f, shape[1], f, shape[2], f)[1 + who[done], r, :, q, :, t, :] = True
        who, at = who[~done], [x[~done] for x in at]
    return out.any(axis=3), out


def _possible(around: _Around, item: np.ndarray, share: list[tuple], cfg: Cameras, border: float) -> np.ndarray:
    """Cells (indices) that no test leaves out; share is where they begin and end on the ways of radius, cosine and side."""
    of, span = around.of, cfg.max_distance - cfg.min_distance
    r0, r1 = (cfg.min_distance + x * span for x in share[0])
    q0, q1 = (x * 2.0 - 1.0 for x in share[1])
    t0, t1 = (x * (2 * math.pi) for x in share[2])
    oz = of.aim[item, 2]
    z0, z1 = oz + np.minimum(r0 * q0, r1 * q0) - EPS, oz + np.maximum(r0 * q1, r1 * q1) + EPS
    left = np.flatnonzero(~((z1 < cfg.min_camera_height) | (z0 > cfg.max_camera_height)))
    left = left[~_unseen(of, item[left], r0[left], r1[left], q0[left], q1[left], t0[left], t1[left], cfg, border)]

    r0, r1, q0, q1, t0, t1, z0, z1, aim = (x[left] for x in (r0, r1, q0, q1, t0, t1, z0, z1, of.aim[item]))
    s0, s1 = np.sqrt(1.0 - q0 * q0), np.sqrt(1.0 - q1 * q1)
    near, far = r0 * np.minimum(s0, s1), r1 * np.where((q0 < 0) & (q1 > 0), 1.0, np.maximum(s0, s1))
    low, high = np.empty((len(left), 3)), np.empty((len(left), 3))
    for k, f in enumerate((np.cos, np.sin)):  # sides are cut at quarter turns, so the ends are the extremes
        a, b = f(t0), f(t1)
        a, b = np.minimum(a, b), np.maximum(a, b)
        low[:, k], high[:, k] = aim[:, k] + np.minimum(near * a, far * a) - EPS, aim[:, k] + np.maximum(near * b, far * b) + EPS
    low[:, 2], high[:, 2] = np.maximum(z0, cfg.min_camera_height), np.minimum(z1, cfg.max_camera_height)

    for gone in (around.outside, around.within, around.no_room, around.hidden):
        keep = ~gone(item[left], low, high)
        left, low, high = left[keep], low[keep], high[keep]
    return left


def _unseen(of, item: np.ndarray, r0: np.ndarray, r1: np.ndarray, q0: np.ndarray, q1: np.ndarray, t0: np.ndarray, t1: np.ndarray, cfg: Cameras, border: float) -> np.ndarray:
    """A target's centre, d from the aim, is in the image from radius F + max(|side|, |up|) / K on; here is a lower bound of it.

    With C and S as the parts of d along and across the camera's side: F = sin C + cos dz, up = sin dz - cos C, of the height angle.
    """
    focal = cfg.image_width / (2 * math.tan(math.radians(cfg.fov_deg) / 2))
    wide, tall = (cfg.image_width / 2 - border) / focal, (cfg.image_height / 2 - border) / focal
    side, turn = (t0 + t1) / 2, (t1 - t0) / 2
    high, low = np.arccos(q0), np.arccos(q1)
    angle, tilt = (high + low) / 2, (high - low) / 2
    sin, cos, ct, st, cx, sx = np.sin(angle), np.cos(angle), np.cos(turn), np.sin(turn), np.cos(tilt), np.sin(tilt)
    pole, gone = (q0 < EPS - 1) | (q1 > 1 - EPS), np.zeros(len(item), bool)
    for k in range(of.target.shape[1]):
        box = of.target[item, k]
        d = (box[:, :3] + box[:, 3:]) * 0.5 - of.aim[item, :3]
        along, across = d[:, 0] * np.cos(side) + d[:, 1] * np.sin(side), d[:, 0] * np.sin(side) - d[:, 1] * np.cos(side)
        least_across = np.maximum(np.abs(across) * ct - np.abs(along) * st, 0.0)
        c0, c1 = (f(along, along * ct) + s * np.abs(across) * st for f, s in ((np.minimum, -1), (np.maximum, 1)))
        (f0, g0), (f1, g1) = ((sin * c + cos * d[:, 2], cos * c - sin * d[:, 2]) for c in (c0, c1))
        least, most = np.minimum(f0, f0 * cx) - np.abs(g0) * sx, np.maximum(f1, f1 * cx) + np.abs(g1) * sx
        up0 = np.minimum(np.minimum(g0, g0 * cx) - np.abs(f0) * sx, np.minimum(g1, g1 * cx) - np.abs(f1) * sx)
        up1 = np.maximum(np.maximum(g0, g0 * cx) + np.abs(f0) * sx, np.maximum(g1, g1 * cx) + np.abs(f1) * sx)
        need = np.maximum(least_across / wide, np.maximum(np.maximum(up0, -up1), 0.0) / tall)
        # straight above or below, the camera may be turned any way: only the distance from its axis counts
        off = (d * d).sum(axis=1) - np.maximum(least * least, most * most)
        need = np.where(pole, np.sqrt(np.maximum(off, 0.0)) / math.hypot(wide, tall), need)
        gone |= (r1 < least + need - 10 * EPS) & (r0 > EPS)
    return gone


class _Around:
    """What stands around items; low and high are the corners of boxes that hold cells.

    Where a wall hides a point from is convex, so corners speak for a cell. Only walls within which no camera stands hide
    something here: so a cell which a wall runs through is looked at as what lies up to the wall's far side and what lies from
    its near side on.
    """

    def __init__(self, of, cfg: Cameras, margin: float = 0.1) -> None:
        self.of, scenes = of, of.scenes
        self.bounds = np.array([(-math.inf, math.inf) * 2 if s.bounds is None else s.bounds for s in scenes]) + np.array([margin, -margin] * 2)
        self.boxes = padded([np.hstack([s.boxes[:, :3] - margin + EPS, s.boxes[:, 3:] + margin - EPS]) for s in scenes], 1)
        self.edges = padded([padded(s.polygons, 1) if s.polygons else np.empty((0, 1, 4)) for s in scenes], 2)
        odd = lambda e: not np.isfinite(e).all() or ((e[:, 1] != e[:, 3]) & (np.abs(e[:, 1] - e[:, 3]) < 1e-3)).any()
        self.rooms = np.array([s.has_rooms and not any(map(odd, s.polygons)) for s in scenes])

        self.walls, self.centre = of.others, (of.target[..., :3] + of.target[..., 3:]) / 2
        inside = (self.walls[:, :, None, :3] >= self.boxes[:, None, :, :3]) & (self.walls[:, :, None, 3:] <= self.boxes[:, None, :, 3:])
        thick = (self.walls[..., 3:] - self.walls[..., :3] > 4 * EPS).all(axis=-1)
        use = inside.all(axis=-1).any(axis=-1) & thick & (cfg.check_wall_occlusion and not of.full)
        self.flat = (self.walls[..., 3] - self.walls[..., 0] > self.walls[..., 4] - self.walls[..., 1]).astype(int)
        self.near, self.far = (np.take_along_axis(self.walls, (self.flat + k)[..., None], axis=-1)[..., 0] for k in (0, 3))
        wall, point = self.walls[of.home][:, None], self.centre[:, :, None]
        apart = np.maximum(wall[..., :3] - point, point - wall[..., 3:]).max(axis=-1) > 5e-3
        across = np.where(self.flat[of.home][:, None] == 1, point[..., 1], point[..., 0])
        counts = of.counts & use[of.home][:, None] & apart
        self.counts = (counts & (across > self.near[of.home][:, None]), counts & (across < self.far[of.home][:, None]))

    def outside(self, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x0, x1, y0, y1 = self.bounds[self.of.home[item]].T
        return (high[:, 0] < x0) | (low[:, 0] > x1) | (high[:, 1] < y0) | (low[:, 1] > y1)

    def within(self, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        home = self.of.home[item]
        inside = np.ones((len(item), self.boxes.shape[1]), bool)
        for k in range(3):
            inside &= (low[:, k, None] >= self.boxes[home, :, k]) & (high[:, k, None] <= self.boxes[home, :, k + 3])
        return inside.any(axis=1)

    def no_room(self, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """No outline runs through the cell, and its middle is outside of all; odd outlines rule nothing out."""
        home = self.of.home[item]
        ax, ay, bx, by = np.moveaxis(self.edges[home], -1, 0)
        x0, y0, x1, y1 = (c[:, None, None] for c in (low[:, 0], low[:, 1], high[:, 0], high[:, 1]))
        near = (np.maximum(ax, bx) >= x0) & (np.minimum(ax, bx) <= x1) & (np.maximum(ay, by) >= y0) & (np.minimum(ay, by) <= y1)
        turns = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x in (x0, x1) for y in (y0, y1)]
        cut = near & (np.minimum.reduce(turns) <= 0) & (np.maximum.reduce(turns) >= 0)
        x, y = (x0 + x1) / 2, (y0 + y1) / 2
        odd = np.count_nonzero(((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay + 1e-12) + ax), axis=2) % 2 == 1
        return self.rooms[home] & ~(cut.any(axis=2) | odd).any(axis=1)

    def hidden(self, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        home = self.of.home[item]
        near, far, axis = self.near[home], self.far[home], self.flat[home]
        start, end = (np.where(axis == 1, x[:, 1, None], x[:, 0, None]) for x in (low, high))
        gone = np.ones(near.shape, bool)
        for upper in (False, True):
            a, b = (np.maximum(start, near + EPS), end) if upper else (start, np.minimum(end, far - EPS))
            hidden = a > b
            for k in range(self.centre.shape[1]):
                c, w = np.nonzero(self.counts[upper][item, k] & ~hidden & gone)
                one, two, to, wall = low[c], high[c], self.centre[item[c], k], self.walls[home[c], w]
                every = np.arange(len(c))
                one[every, axis[c, w]], two[every, axis[c, w]] = a[c, w], b[c, w]
                for q in [None, *range(8)]:
                    met = _met((one + two) / 2 if q is None else np.where([q >> m & 1 == 1 for m in range(3)], two, one), to, wall)
                    c, w, one, two, to, wall = (x[met] for x in (c, w, one, two, to, wall))
                hidden[c, w] = True
            gone &= hidden
        return gone.any(axis=1)


def _met(p: np.ndarray, to: np.ndarray, wall: np.ndarray) -> np.ndarray:
    """Whether the way from p to a point meets the wall, less a thin skin."""
    way = to - p
    one, two = (wall[:, :3] + EPS - p) / way, (wall[:, 3:] - EPS - p) / way
    first, last = np.minimum(one, two), np.maximum(one, two)
    first, last = np.maximum(np.maximum(first[:, 0], first[:, 1]), first[:, 2]), np.minimum(np.minimum(last[:, 0], last[:, 1]), last[:, 2])
    return (first <= last) & (last >= 0) & (first <= 1)


def padded(parts: list[np.ndarray], depth: int, fill: float | bool = np.nan) -> np.ndarray:
    """Arrays one below the other, filled up to one size in their first `depth` directions."""
    most = [max(1, *(x.shape[k] for x in parts)) for k in range(depth)]
    out = np.full((len(parts), *most, *parts[0].shape[depth:]), fill)
    for row, x in zip(out, parts, strict=True):
        row[tuple(slice(n) for n in x.shape[:depth])] = x
    return out
