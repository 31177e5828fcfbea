"""Which numbered attempts at a camera pose are accepted, by arrays of attempts a scene.

The random numbers, tests and limits are those of `cameras` and `visibility`, in the same order of operations; every
attempt that can be used is made until an item has its poses. What comes back are numbers of attempts: `cameras` makes the
poses from them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from roomweave.config import Cameras
from roomweave.operators import reach

SCHEMA = "scene_id string, item bigint, attempt int"
ARROW = pa.schema([("scene_id", pa.string()), ("item", pa.int64()), ("attempt", pa.int32())])
#: Scenes looked at together, and attempts whose digests are made and cameras that are tested for walls together: within a core's cache.
SCENES, DIGESTS, PLACES = 32, 16384, 8192
#: Attempts of an item in one round at most.
ROUND = 2000
#: Attempts of an item before it is asked which ones can be accepted at all; pixels at the image's edge where no centre counts.
LOOK, BORDER = 100, 5
INF = 1e300

_SHIFTS = ([7, 12, 17, 22] * 4, [5, 9, 14, 20] * 4, [4, 11, 16, 23] * 4, [6, 10, 15, 21] * 4)
_ROUNDS = [
    (i // 16, (i, (5 * i + 1) % 16, (3 * i + 5) % 16, 7 * i % 16)[i // 16], np.uint32(int(abs(math.sin(i + 1)) * 2**32)), np.uint32(s), np.uint32(32 - s))
    for i, s in enumerate(s for row in _SHIFTS for s in row)
]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _digest(words: list) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the md5 of many messages; words has an array, or one number for all, a word of padded message."""
    n = max(np.size(w) for w in words)
    state = [np.full(n, s, np.uint32) for s in _START]
    for k in range(0, len(words), 16):
        a, b, c, d = (s.copy() for s in state)
        f, t = np.empty_like(a), np.empty_like(a)
        for kind, g, sine, left, right in _ROUNDS:
            if kind == 0:
                np.bitwise_xor(c, d, out=f)
                f &= b
                f ^= d
            elif kind == 1:
                np.bitwise_xor(b, c, out=f)
                f &= d
                f ^= c
            elif kind == 2:
                np.bitwise_xor(b, c, out=f)
                f ^= d
            else:
                np.invert(d, out=f)
                f |= b
                f ^= c
            f += a
            f += words[k + g]
            f += sine
            np.left_shift(f, left, out=t)
            np.right_shift(f, right, out=f)
            f |= t
            f += b
            a, b, c, d, f = d, f, b, c, a
        for s, x in zip(state, (a, b, c, d), strict=True):
            s += x
    return state[0], state[1]


def uniform(prefixes: tuple[np.ndarray, np.ndarray], who: np.ndarray, attempt: np.ndarray) -> np.ndarray:
    """The numbers of cameras.uniform: prefix `who` (its bytes in a row, and their number) and the attempt make a name."""
    out = np.empty(len(who))
    texts, lengths = prefixes
    sizes = lengths[who] * 32 + np.searchsorted(10 ** np.arange(1, 18), attempt, side="right") + 1
    for kind in np.flatnonzero(np.bincount(sizes)):
        of = np.flatnonzero(sizes == kind)
        start, digits = divmod(int(kind), 32)
        blocks = (start + digits + 9 + 63) // 64
        mine = lengths == start
        base = np.zeros((np.count_nonzero(mine), 64 * blocks), np.uint8)
        base[:, :start] = texts[mine, :start]
        base[:, start + digits] = 0x80
        base[:, -8:] = np.frombuffer((8 * (start + digits)).to_bytes(8, "little"), np.uint8)
        base = np.ascontiguousarray(base.view("<u4").T)
        same = [(column == column[0]).all() for column in base]
        row_of = np.cumsum(mine) - 1
        for k in range(0, len(of), DIGESTS):
            part = of[k : k + DIGESTS]
            w, at = row_of[who[part]], attempt[part].astype(np.uint32)
            words = [column[0] if one else column[w] for column, one in zip(base, same, strict=True)]
            for j in reversed(range(digits)):
                at, digit = np.divmod(at, np.uint32(10))
                place = start + j
                words[place // 4] = words[place // 4] + ((digit + np.uint32(48)) << np.uint32(8 * (place % 4)))
            first, second = _digest(words)
            out[part] = ((first.byteswap().astype(np.uint64) << np.uint64(20)) | (second.byteswap().astype(np.uint64) >> np.uint64(12))).astype(float) / float(1 << 52)
    return out


def _texts(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Names as bytes, a row each, and their lengths."""
    rows = np.array(names)
    return rows.view(np.uint8).reshape(len(names), -1), np.array([len(n) for n in names])


class Scene:
    """A scene's items (target boxes as arrays) and what stands in the way."""

    def __init__(self, row: dict) -> None:
        self.scene_id = row["scene_id"]
        self.items = [i["item"] for i in row["items"]]
        self.aim = np.array([[i["ox"], i["oy"], i["oz"], i["height"]] for i in row["items"]], float)
        self.targets = np.array([len(i["targets"]) for i in row["items"]])
        most = max(self.targets)
        self.target = np.full((len(self.items), most, 6), np.nan)
        for k, i in enumerate(row["items"]):
            for t, o in enumerate(i["targets"]):
                self.target[k, t] = np.array(o["box"], float)
        self.boxes = np.array(row["boxes"] or [], float).reshape(-1, 6)
        self.bounds = np.array(row["bounds"], float) if row["bounds"] and row["bounds"][0] is not None else None
        self.polygons = [self._edges(p) for p in row["polygons"] or [] if p is not None and len(p) >= 3]
        self.has_rooms = bool(row["polygons"])
        others = row["occluders"] or []
        self.others = np.array([o["box"] for o in others], float).reshape(-1, 6)
        self.is_wall = np.array([bool(o["is_wall"]) for o in others], bool)
        ids = [o["id"] for o in others]
        self.foreign = np.array([[[t < len(i["targets"]) and x is not None and x != i["targets"][t]["id"] for x in ids] for t in range(most)] for i in row["items"]], bool).reshape(len(self.items), most, len(ids))

    def walls(self) -> tuple[np.ndarray, np.ndarray]:
        """Walls, and which of them count for (item, target): those that overlap the target much don't."""
        walls = self.others[self.is_wall]
        return walls, self.foreign[..., self.is_wall] & (_overlap(self.target, walls) <= 0.3)

    @staticmethod
    def _edges(polygon: list) -> np.ndarray:
        at = lambda p, i: p[i] if p is not None and len(p) > i and p[i] is not None else np.nan
        p = np.array([[at(x, 0), at(x, 1)] for x in polygon], float)
        return np.hstack([p, np.roll(p, 1, axis=0)])

    def valid(self, p: np.ndarray, cfg: Cameras, margin: float = 0.1) -> np.ndarray:
        """Which of the places (x, y, z) visibility.valid_positions keeps, as indices."""
        x, y, z = p.T
        ok = (z >= cfg.min_camera_height) & (z <= cfg.max_camera_height)
        if self.bounds is not None:
            x0, x1, y0, y1 = self.bounds
            ok &= (x >= x0 + margin) & (x <= x1 - margin) & (y >= y0 + margin) & (y <= y1 - margin)
        left = np.flatnonzero(ok)
        if self.has_rooms:
            x, y = x[left, None], y[left, None]
            inside = np.zeros(len(left), bool)
            with np.errstate(all="ignore"):
                for e in self.polygons:
                    ax, ay, bx, by = e.T
                    inside |= np.count_nonzero(((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay + 1e-12) + ax) & ~np.isnan(ay + by), axis=1) % 2 == 1
            left = left[inside]
        if len(self.boxes):
            q = p[left]
            clash = np.ones((len(left), len(self.boxes)), bool)
            for k in range(3):
                clash &= (q[:, k, None] >= self.boxes[:, k] - margin) & (q[:, k, None] <= self.boxes[:, k + 3] + margin)
            left = left[~clash.any(axis=1)]
        return left


class Together:
    """Items of several scenes, and the boxes that may hide their targets, in arrays of one size a scene."""

    def __init__(self, scenes: list[Scene], line: bool, cfg: Cameras) -> None:
        self.scenes = scenes
        self.home = np.repeat(np.arange(len(scenes)), [len(s.items) for s in scenes])
        self.place = np.concatenate([np.arange(len(s.items)) for s in scenes])
        self.aim = np.concatenate([s.aim for s in scenes])
        self.targets = np.concatenate([s.targets for s in scenes])
        self.target = reach.padded([s.target for s in scenes], 2)[self.home, self.place]
        self.full = not line and not cfg.skip_occlusion_check
        walls = [(s.others, s.foreign) if self.full else s.walls() for s in scenes]
        self.others = reach.padded([w for w, _ in walls], 1)
        self.counts = reach.padded([c for _, c in walls], 3, False)[self.home, self.place]


def _view(p: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(right, up, forward) of cameras at p that look at t, as geometry.with_view has them."""
    rel = t - p
    far = np.sqrt(rel[:, 0] * rel[:, 0] + rel[:, 1] * rel[:, 1] + rel[:, 2] * rel[:, 2])
    f = rel / far[:, None]
    f[far < 1e-8] = (0, 1, 0)
    side = np.stack([f[:, 1], -f[:, 0], np.zeros(len(f))], axis=1)
    wide = np.sqrt(side[:, 0] * side[:, 0] + side[:, 1] * side[:, 1])
    right = side / wide[:, None]
    right[wide < 1e-6] = (1, 0, 0)
    up = np.stack([right[:, 1] * f[:, 2] - right[:, 2] * f[:, 1], right[:, 2] * f[:, 0] - right[:, 0] * f[:, 2], right[:, 0] * f[:, 1] - right[:, 1] * f[:, 0]], axis=1)
    return right, up, f


def _corner(box: np.ndarray, q: int) -> np.ndarray:
    """One of the eight corners, x slowest, z fastest."""
    return box[:, [3 * (q >> 2 & 1), 3 * (q >> 1 & 1) + 1, 3 * (q & 1) + 2]]


def _placed(point: np.ndarray, p: np.ndarray, view: tuple, cfg: Cameras) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    f = cfg.image_width / (2 * math.tan(math.radians(cfg.fov_deg) / 2))
    rel = point - p
    along = lambda a: a[:, 0] * rel[:, 0] + a[:, 1] * rel[:, 1] + a[:, 2] * rel[:, 2]
    w = along(view[2])
    front = w > 1e-6
    u = np.where(front, f * (-along(view[0]) / w) + cfg.image_width / 2, np.nan)
    v = np.where(front, f * (along(view[1]) / w) + cfg.image_height / 2, np.nan)
    return u, v, front


def _in_image(u: np.ndarray, v: np.ndarray, cfg: Cameras, border: float) -> np.ndarray:
    return (u >= border) & (u <= cfg.image_width - 1 - border) & (v >= border) & (v <= cfg.image_height - 1 - border)


def _blocked(p: np.ndarray, point: np.ndarray, others: np.ndarray, counts: np.ndarray, eps: float = 1e-3) -> np.ndarray:
    """Whether one of the boxes (place, box, side) that count stands between p and point, as geometry.blocks has it."""
    rel = point - p
    far = np.sqrt(rel[:, 0] * rel[:, 0] + rel[:, 1] * rel[:, 1] + rel[:, 2] * rel[:, 2])
    d = rel / far[:, None]
    first = np.full(counts.shape, -np.inf)
    last, out = -first, ~counts
    for k in range(3):
        flat, o = np.abs(d[:, k]) < 1e-12, p[:, k, None]
        t1, t2 = (others[..., k] - o) * (1.0 / d[:, k])[:, None], (others[..., k + 3] - o) * (1.0 / d[:, k])[:, None]
        low, high = np.minimum(t1, t2), np.maximum(t1, t2)
        if flat.any():
            low[flat], high[flat] = -INF, INF
            out = out | (flat[:, None] & ((o < others[..., k]) | (o > others[..., k + 3])))
        np.maximum(first, low, out=first)
        np.minimum(last, high, out=last)
    far = far[:, None]
    return (~out & (last >= np.maximum(first, 0.0)) & (far >= 1e-6) & (first >= 0) & (first <= far - eps)).any(axis=1)


def _overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """geometry.box_overlap of each box of a with each of b."""
    a, b = a[..., None, :], b
    sides = np.minimum(a[..., 3:], b[:, 3:]) - np.maximum(a[..., :3], b[:, :3])
    volume = lambda x: (x[..., 3] - x[..., 0]) * (x[..., 4] - x[..., 1]) * (x[..., 5] - x[..., 2])
    least = np.minimum(volume(a), volume(b))
    ratio = np.where(least == 0, 0.0, sides[..., 0] * sides[..., 1] * sides[..., 2] / least)
    return np.where((sides <= 0).any(axis=-1), 0.0, ratio)


def _shows(of: Together, who: np.ndarray, p: np.ndarray, t: np.ndarray, line: bool, cfg: Cameras) -> np.ndarray:
    """Which cameras (indices) show all targets of their items."""
    left, border = np.arange(len(who)), 0 if line else BORDER
    right, up, forward = _view(p, t)
    for k in range(of.target.shape[1]):
        has = of.targets[who[left]] > k
        some, rest = left[has], left[~has]
        if not line:
            box = of.target[who[some], k]
            u, v, _ = _placed((box[:, :3] + box[:, 3:]) * 0.5, p[some], (right[some], up[some], forward[some]), cfg)
            some = some[_in_image(u, v, cfg, border)]
        for q in range(8):
            u, v, _ = _placed(_corner(of.target[who[some], k], q), p[some], (right[some], up[some], forward[some]), cfg)
            seen = _in_image(u, v, cfg, border)
            some, rest = some[~seen], np.concatenate([rest, some[seen]])
        left = np.sort(rest)
    if not (of.full or cfg.check_wall_occlusion):
        return left
    return np.concatenate([left[:0], *(_unhidden(of, left[k : k + PLACES], who, p, (right, up, forward), line, cfg) for k in range(0, len(left), PLACES))])


def _unhidden(of: Together, left: np.ndarray, who: np.ndarray, p: np.ndarray, view: tuple, line: bool, cfg: Cameras) -> np.ndarray:
    for k in range(of.target.shape[1]):
        has = of.targets[who[left]] > k
        some, rest = left[has], left[~has]
        if of.full:
            box, others, counts = of.target[who[some], k], of.others[of.home[who[some]]], of.counts[who[some], k]
            free = np.zeros(len(some), int)
            for q in range(8):
                u, v, _ = _placed(_corner(box, q), p[some], tuple(a[some] for a in view), cfg)
                free += _in_image(u, v, cfg, 2) & ~_blocked(p[some], _corner(box, q), others, counts)
            some = some[free >= cfg.min_visible_corners]
        else:
            box = of.target[who[some], k]
            some = some[~_blocked(p[some], (box[:, :3] + box[:, 3:]) / 2, of.others[of.home[who[some]]], of.counts[who[some], k])]
            box, others, counts = of.target[who[some], k], of.others[of.home[who[some]]], of.counts[who[some], k]
            hidden = np.zeros(len(some), int)
            for q in range(8):
                hidden += _blocked(p[some], _corner(box, q), others, counts)
            some = some[hidden / 9.0 < (0.7 if line else 0.5)]
        left = np.sort(np.concatenate([some, rest]))
    return left


def _tried(pattern: str, aim: np.ndarray, u: Callable[[str, np.ndarray], np.ndarray], cfg: Cameras, cells: tuple[tuple[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Attempts at an allowed height (indices), their places and what they look at, (attempt, step, axis) each.

    cells has the cells where attempts can be accepted (see reach), and which of them an attempt has; others are left out, as
    soon as the numbers made so far tell.
    """
    every, span = np.arange(len(aim)), cfg.max_distance - cfg.min_distance
    if pattern == "around":
        every = np.flatnonzero((aim[:, 3] >= cfg.min_camera_height) & (aim[:, 3] <= cfg.max_camera_height))
        yaw, radius, aim = np.radians(u("yaw", every) * 360.0), cfg.min_distance + u("radius", every) * span, aim[every]
        p = np.stack([aim[:, 0] + radius * np.cos(yaw), aim[:, 1] + radius * np.sin(yaw), aim[:, 3]], axis=1)
    elif pattern == "spherical":
        phi = u("phi", every)
        if cells:
            (any_side, live), slot = cells
            every = np.flatnonzero(any_side.any(axis=1)[slot, _bin(phi, live.shape[2])])
        radius = u("radius", every)
        if cells:
            some = any_side[slot[every], _bin(radius, live.shape[1]), _bin(phi[every], live.shape[2])]
            every, radius = every[some], radius[some]
        r, cosphi = cfg.min_distance + radius * span, phi[every] * 2.0 - 1.0
        z = aim[every, 2] + r * cosphi
        high = np.flatnonzero((z >= cfg.min_camera_height) & (z <= cfg.max_camera_height))
        every, radius = every[high], radius[high]
        theta = u("theta", every)
        if cells:
            some = np.flatnonzero(live[slot[every], _bin(radius, live.shape[1]), _bin(phi[every], live.shape[2]), _bin(theta, live.shape[3])])
            every, theta, high = every[some], theta[some], high[some]
        radius, cosphi, z, aim, theta = r[high], cosphi[high], z[high], aim[every], theta * (2 * 3.141592653589793)
        flat = radius * np.sqrt(1.0 - cosphi * cosphi)
        p = np.stack([aim[:, 0] + flat * np.cos(theta), aim[:, 1] + flat * np.sin(theta), z], axis=1)
    else:
        n, move, towards = cfg.linear_num_steps, cfg.linear_move_distance, cfg.linear_sub_pattern == "approach"
        low = cfg.min_distance + (move if towards else 0.0)
        angle, start = u("angle", every) * (2 * 3.141592653589793), (low + u("radius", every) * (cfg.max_distance - low))[:, None]
        ux, uy, along = np.cos(angle)[:, None], np.sin(angle)[:, None], np.arange(n) / float(max(1, n - 1))
        ox, oy, oz, height = (aim[:, k, None] for k in range(4))
        if towards:
            at = start - along * move
            px, py = ox + at * ux, oy + at * uy
        else:
            shift = (along - 0.5) * move
            px, py = ox + start * ux - shift * uy, oy + start * uy + shift * ux
        ahead = start - 10.0
        wide = lambda *c: np.stack([np.broadcast_to(x, px.shape) for x in c], axis=2)
        return every, wide(px, py, height), wide(ox + ahead * ux, oy + ahead * uy, oz)
    return every, p[:, None, :], aim[:, None, :3]


def _bin(u: np.ndarray, n: int) -> np.ndarray:
    return (u * n).astype(np.int64)


def _rounds(limit: int) -> Iterator[tuple[int, int]]:
    """Few attempts first, as most items need few; names of one round are mostly of one length."""
    first, last, next_ = 0, 10, 30
    while first < limit:
        yield first, min(last, limit)
        first, last, next_ = last, min(next_, last + ROUND), last * 10


def accepted(scenes: list[Scene], pattern: str, wanted: int, limit: int, seed: int, cfg: Cameras) -> list[tuple[str, int, int]]:
    """(scene_id, item, attempt): the first `wanted` accepted attempts of every item."""
    of = Together(scenes, pattern == "linear", cfg)
    names = {c: _texts([f"{seed}:{c}:{pattern}:{s.scene_id}:{i}:".encode() for s in scenes for i in s.items]) for c in ("yaw", "radius", "theta", "phi", "angle")}
    found: list[list[int]] = [[] for _ in of.home]
    still, cells, slot = np.arange(len(of.home)), None, np.zeros(len(of.home), int)
    for first, last in _rounds(limit):
        if pattern == "spherical" and cells is None and first >= LOOK:
            none = still[[not found[i] for i in still]]
            slot[none] = np.arange(1, len(none) + 1)
            cells = reach.live(of, none, cfg, BORDER)
            still = still[cells[0].any(axis=(1, 2))[slot[still]]]
            if not len(still):
                break
        who, attempt = np.repeat(still, last - first), np.tile(np.arange(first, last), len(still))
        kept, p, t = _tried(pattern, of.aim[who], lambda c, rows: uniform(names[c], who[rows], attempt[rows]), cfg, None if cells is None else (cells, slot[who]))  # noqa: B023
        home, steps = of.home[who[kept]], p.shape[1]
        ok = np.zeros((len(kept), steps), bool)
        for k in np.unique(home):
            mine = np.flatnonzero(home == k)
            good = np.zeros(len(mine) * steps, bool)
            good[scenes[k].valid(p[mine].reshape(-1, 3), cfg)] = True
            ok[mine] = good.reshape(-1, steps)
        ok = ok.all(axis=1)
        who, attempt, p, t = who[kept[ok]], attempt[kept[ok]], p[ok].reshape(-1, 3), t[ok].reshape(-1, 3)
        shown = np.zeros(len(p), bool)
        with np.errstate(all="ignore"):
            shown[_shows(of, np.repeat(who, steps), p, t, pattern == "linear", cfg)] = True
        for i in np.flatnonzero(shown.reshape(-1, steps).all(axis=1)):
            if len(found[who[i]]) < wanted:
                found[who[i]].append(int(attempt[i]))
        still = still[[len(found[i]) < wanted for i in still]]
        if not len(still):
            break
    return [(scenes[of.home[i]].scene_id, scenes[of.home[i]].items[of.place[i]], a) for i in range(len(of.home)) for a in found[i]]


def of_batches(pattern: str, wanted: int, limit: int, seed: int, cfg: Cameras) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over one row a scene."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, SCENES):
                rows = accepted([Scene(r) for r in batch.slice(k, SCENES).to_pylist()], pattern, wanted, limit, seed, cfg)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(ARROW)], schema=ARROW)

    return run
