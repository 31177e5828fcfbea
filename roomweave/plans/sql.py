"""SQL twins of the queries, for DuckDB over the same tables. Where SQL can't express an operator there is none."""

from __future__ import annotations

import math

from roomweave.config import BLACKLIST
from roomweave.operators import questions as qs

ORACLE: dict[str, str] = {}


def _list(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _in_polygon(x: str, y: str, p: str) -> str:
    a, b = f"{p}[i]", f"{p}[CASE WHEN i = 1 THEN len({p}) ELSE i - 1 END]"
    crossed = f"(({a}[2] > {y}) <> ({b}[2] > {y})) AND {x} < ({b}[1] - {a}[1]) * ({y} - {a}[2]) / ({b}[2] - {a}[2] + CAST(1e-12 AS DOUBLE)) + {a}[1]"
    return f"(COALESCE(list_sum([CASE WHEN {crossed} THEN 1 ELSE 0 END FOR i IN range(1, len({p}) + 1)]), 0) % 2 = 1)"


_SIDES = ", ".join(f"list_{f}([p.{a} FOR p IN bounding_box]) AS {a}{n}" for n, f in ((0, "min"), (1, "max")) for a in "xyz")
OUTLINE = "COALESCE(r.profile, r.polygon, r.floor, r.boundary)"
POLYS = f"polys AS (SELECT scene_id, COALESCE([{OUTLINE} FOR r IN rooms IF len({OUTLINE}) >= 3], []) AS polygons FROM scene_structure)"
BOXES = f"""boxes AS (SELECT scene_id, label_ord AS ord, COALESCE(CASE WHEN ins_id NOT IN ('', '0') THEN ins_id END, CASE WHEN id NOT IN ('', '0') THEN id END) AS id,
  lower(trim(COALESCE(label, ''))) AS label, {_SIDES} FROM scene_labels WHERE len(bounding_box) >= 8)"""
PARSED = BOXES + ", parsed AS (SELECT *, " + ", ".join(f"({a}0 + {a}1) / 2 AS c{a}, {a}1 - {a}0 AS d{a}" for a in "xyz") + " FROM boxes WHERE id IS NOT NULL)"
OBJ = f"""{PARSED}, {POLYS}, obj AS (SELECT p.*, CAST(NULLIF(COALESCE(list_position([{_in_polygon('p.cx', 'p.cy', 'poly')} FOR poly IN r.polygons], true), 0), 0) - 1 AS INTEGER) AS room_index
  FROM parsed p LEFT JOIN polys r USING (scene_id))"""
MAX_DIM = lambda p="": f"greatest({p}dx, {p}dy, {p}dz)"
SINGLE = f"single AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY scene_id, room_index, label) AS n_alone FROM obj WHERE label NOT IN ({_list(BLACKLIST)})) WHERE n_alone = 1)"
FOCUS = f"""{OBJ}, {SINGLE}, ranked AS (SELECT *, dx * dy * dz AS volume, count(*) OVER (PARTITION BY scene_id) AS n,
  row_number() OVER (PARTITION BY scene_id, label ORDER BY dx * dy * dz DESC, ord) AS k, min(ord) OVER (PARTITION BY scene_id, label) AS first_ord FROM single),
 top AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY CASE WHEN n > 5 THEN -volume END NULLS FIRST, CASE WHEN n > 5 THEN first_ord END NULLS FIRST, ord) - 1 AS rank FROM ranked WHERE n <= 5 OR k = 1),
 focus5 AS (SELECT * FROM top WHERE rank < 5),
 focus AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY scene_id) AS n_focus FROM focus5) WHERE n_focus >= 3)"""


def _sqrt3(x: str, y: str, z: str) -> str:
    return f"sqrt(({x}) * ({x}) + ({y}) * ({y}) + ({z}) * ({z}))"


def _dist(a: str, b: str, axes: str = "c{}") -> str:
    return _sqrt3(*(f"{a}.{axes.format(v)} - {b}.{axes.format(v)}" for v in "xyz"))


def _gap(a: str = "a", b: str = "b") -> str:
    return _sqrt3(*(f"greatest(CAST(0 AS DOUBLE), {a}.{v}0 - {b}.{v}1, {b}.{v}0 - {a}.{v}1)" for v in "xyz"))


def _overlap(a: str, b: str) -> str:
    side = {v: f"(least({a}.{v}1, {b}.{v}1) - greatest({a}.{v}0, {b}.{v}0))" for v in "xyz"}
    vol = lambda t: " * ".join(f"({t}.{v}1 - {t}.{v}0)" for v in "xyz")
    apart = " OR ".join(f"{s} <= 0" for s in side.values())
    return f"CASE WHEN {apart} THEN CAST(0 AS DOUBLE) ELSE COALESCE({' * '.join(side.values())} / NULLIF(least({vol(a)}, {vol(b)}), 0), 0) END"


_AVG = f"({MAX_DIM('a.')} + {MAX_DIM('b.')}) / 2"
_D = lambda v: f"CAST({v} AS DOUBLE)"
REASON = f"""CASE WHEN a.label IN ({_list(BLACKLIST)}) THEN 'blacklist_obj_a' WHEN b.label IN ({_list(BLACKLIST)}) THEN 'blacklist_obj_b' WHEN a.room_index <> b.room_index THEN 'different_rooms'
 WHEN {_gap()} < greatest({_D(0.3)}, {_D(0.2)} * ({_AVG})) THEN 'too_close' WHEN {_gap()} > least({_D(5)}, {_D(2)} * ({_AVG})) THEN 'too_far'
 WHEN greatest({MAX_DIM('a.')}, {MAX_DIM('b.')}) / (least({MAX_DIM('a.')}, {MAX_DIM('b.')}) + {_D('1e-9')}) > 3 THEN 'size_ratio' WHEN abs({MAX_DIM('a.')} - {MAX_DIM('b.')}) > 2.5 THEN 'size_diff' ELSE 'ok' END"""
JOINED = "FROM obj a JOIN obj b ON a.scene_id = b.scene_id AND a.ord < b.ord"
VALID = f"valid AS (SELECT a.scene_id, a.ord AS a_ord, b.ord AS b_ord, row_number() OVER (PARTITION BY a.scene_id ORDER BY a.ord, b.ord) AS pair_ord {JOINED} WHERE {REASON} = 'ok')"
FULL = "len([v FOR v IN camera_pose.{} IF v IS NOT NULL]) = 3"
POSES = "poses AS (SELECT scene_id, pose_row, " + ", ".join(f"camera_pose.{f}[{i + 1}] AS {n}{a}" for f, n in (("position", "p"), ("target", "t")) for i, a in enumerate("xyz")) + f", camera_pose.yaw AS yaw, camera_pose.pitch AS pitch FROM camera_poses WHERE {FULL.format('position')} AND {FULL.format('target')})"


def _walls(camera: bool) -> str:
    thick = "COALESCE(NULLIF(w.thickness, 0), 0.2)" if camera else "COALESCE(w.thickness, 0.1)"
    high = "COALESCE(NULLIF(w.height, 0), 2.8)" if camera else "COALESCE(w.height, 2.8)"
    size = "= 2" if camera else ">= 2"
    px, py = "-((by_ - ay) / NULLIF(length, 0)) * half", "((bx - ax) / NULLIF(length, 0)) * half"
    px, py = (f"CASE WHEN length < 1e-6 THEN half ELSE {v} END" for v in (px, py))
    keep = "" if camera else " AND length >= 1e-6"
    corners = lambda a, b, p: f"{a} + {p}, {a} - {p}, {b} + {p}, {b} - {p}"
    return f"""(SELECT scene_id, wall_idx, least({corners('ax', 'bx', 'px')}) AS x0, least({corners('ay', 'by_', 'py')}) AS y0, CAST(0 AS DOUBLE) AS z0,
 greatest({corners('ax', 'bx', 'px')}) AS x1, greatest({corners('ay', 'by_', 'py')}) AS y1, high AS z1 FROM (SELECT *, {px} AS px, {py} AS py FROM (
 SELECT *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS length FROM (SELECT scene_id, wall_idx, w.location[1][1] AS ax, w.location[1][2] AS ay, w.location[2][1] AS bx, w.location[2][2] AS by_,
 CAST({thick} AS DOUBLE) / 2 AS half, CAST({high} AS DOUBLE) AS high FROM (SELECT scene_id, unnest(range(0, len(walls))) AS wall_idx, unnest(walls) AS w FROM scene_structure) WHERE len(w.location) {size})) WHERE length IS NOT NULL{keep}))"""


ALL = f"""wobj AS (SELECT scene_id, 1000000 + wall_idx AS ord, 'wall_' || wall_idx AS id, 'wall' AS label, x0, y0, z0, x1, y1, z1 FROM {_walls(False)}),
 everything AS (SELECT scene_id, ord, id, label, x0, y0, z0, x1, y1, z1 FROM obj UNION ALL SELECT * FROM wobj)"""
HIDING = f"hiding AS (SELECT * EXCLUDE ord FROM everything UNION ALL SELECT scene_id, 'wall_' || wall_idx, 'wall', x0, y0, z0, x1, y1, z1 FROM {_walls(True)})"
CENTERS = "centers AS (SELECT scene_id, room_idx, list_sum([q[1] FOR q IN p]) / len(p) AS x, list_sum([q[2] FOR q IN p]) / len(p) AS y FROM (SELECT scene_id, unnest(range(0, len(polygons))) AS room_idx, unnest(polygons) AS p FROM polys))"
BOUNDS = """bounds AS (SELECT scene_id, low[1] AS x0, low[2] AS y0, low[3] AS z0, high[1] AS x1, high[2] AS y1, high[3] AS z1, COALESCE(mid[1], (low[1] + high[1]) / 2) AS cx, COALESCE(mid[2], (low[2] + high[2]) / 2) AS cy,
 COALESCE(mid[3], (low[3] + high[3]) / 2) AS cz FROM (SELECT scene_id, COALESCE(occupancy.min, occupancy.lower, [-10.0::DOUBLE, -10.0::DOUBLE, 0.0::DOUBLE]) AS low, COALESCE(occupancy.max, occupancy.upper, [10.0::DOUBLE, 10.0::DOUBLE, 3.0::DOUBLE]) AS high,
 occupancy.center AS mid FROM scene_structure WHERE occupancy IS NOT NULL))"""
IN_MARGIN = lambda p, b: " AND ".join(f"{p}.p{v} >= {b}.{v}0 - 0.1::DOUBLE AND {p}.p{v} <= {b}.{v}1 + 0.1::DOUBLE" for v in "xyz")

# -- scenes and selection ----------------------------------------------------------------------------------------------

ORACLE["scan_objects"] = f"WITH {PARSED} SELECT scene_id, ord, id, label, x0, y0, z0, x1, y1, z1, cx, cy, cz, dx, dy, dz FROM parsed"
ORACLE["obb_dims"] = f"WITH {PARSED} SELECT scene_id, ord, greatest(dx, dy) AS length, least(dx, dy) AS width, dz AS height, {MAX_DIM()} AS max_dim, least(dx, dy, dz) AS min_dim, dx * dy * dz AS volume, z1 AS top_z, z0 AS bottom_z FROM parsed"
ORACLE["point_in_polygon_room"] = f"WITH {OBJ} SELECT scene_id, ord, room_index FROM obj"
ORACLE["room_centers"] = f"WITH {POLYS}, {CENTERS} SELECT CAST(room_idx AS INTEGER) AS room_idx, scene_id, x, y FROM centers"
ORACLE["room_areas"] = f"""WITH {POLYS}, r AS (SELECT scene_id, unnest(range(0, len(polygons))) AS room_idx, unnest(polygons) AS p FROM polys)
 SELECT scene_id, CAST(room_idx AS INTEGER) AS room_idx, abs(list_sum([p[i][1] * p[CASE WHEN i = len(p) THEN 1 ELSE i + 1 END][2] - p[CASE WHEN i = len(p) THEN 1 ELSE i + 1 END][1] * p[i][2] FOR i IN range(1, len(p) + 1)])) / 2 AS area FROM r"""
_BX, _BY = ("poly[CASE WHEN i = len(poly) THEN 1 ELSE i + 1 END][%d]" % k for k in (1, 2))
_EX, _EY = f"({_BX} - poly[i][1])", f"({_BY} - poly[i][2])"
_T = f"CASE WHEN {_EX} * {_EX} + {_EY} * {_EY} < 1e-12 THEN 0::DOUBLE ELSE least(1::DOUBLE, greatest(0::DOUBLE, ((cx - poly[i][1]) * {_EX} + (cy - poly[i][2]) * {_EY}) / ({_EX} * {_EX} + {_EY} * {_EY}))) END"
_GX, _GY = f"(cx - (poly[i][1] + ({_T}) * {_EX}))", f"(cy - (poly[i][2] + ({_T}) * {_EY}))"
ORACLE["object_room_boundary"] = f"""WITH {OBJ}, x AS (SELECT o.scene_id, o.ord, o.room_index, o.cx, o.cy, p.polygons[o.room_index + 1] AS poly FROM obj o JOIN polys p USING (scene_id) WHERE o.room_index IS NOT NULL)
 SELECT scene_id, ord, room_index, list_min([sqrt({_GX} * {_GX} + {_GY} * {_GY}) FOR i IN range(1, len(poly) + 1)]) AS dist FROM x"""
ORACLE["walls_to_aabb"] = f"SELECT scene_id, CAST(wall_idx AS INTEGER) AS wall_idx, x0, y0, z0, x1, y1, z1 FROM {_walls(False)}"
ORACLE["walls_to_aabb_camera"] = f"SELECT scene_id, CAST(wall_idx AS INTEGER) AS wall_idx, x0, y0, z0, x1, y1, z1 FROM {_walls(True)}"
ORACLE["objects_and_walls"] = f"WITH {OBJ}, {ALL} SELECT scene_id, count(*) AS n, count(*) FILTER (WHERE label = 'wall') AS walls, max(z1) AS top FROM everything GROUP BY scene_id"
ORACLE["scene_bounds"] = f"WITH {BOUNDS} SELECT * FROM bounds"
ORACLE["filter_blacklist"] = f"WITH {PARSED} SELECT scene_id, ord, id, label FROM parsed WHERE label NOT IN ({_list(BLACKLIST)})"
ORACLE["filter_geometric_reason"] = f"""WITH {PARSED} SELECT scene_id, ord, CASE WHEN label IN ({_list(BLACKLIST)}) THEN 'blacklist' WHEN least(dx, dy, dz) < 0.1 THEN 'dim_too_small' WHEN {MAX_DIM()} > 3 THEN 'dim_too_large'
 WHEN dx * dy * dz < 0.01 THEN 'volume_too_small' WHEN least(dx, dy, dz) / ({MAX_DIM()} + {_D('1e-9')}) < 0.05 THEN 'too_flat' ELSE 'ok' END AS reason FROM parsed"""
ORACLE["label_unique_room"] = f"WITH {OBJ}, {SINGLE} SELECT scene_id, ord, id, label, room_index FROM single"
ORACLE["focus_top5"] = f"WITH {FOCUS} SELECT scene_id, CAST(rank AS INTEGER) AS rank, id, label, volume FROM focus5"
ORACLE["focus_min_gate"] = f"WITH {FOCUS} SELECT scene_id, CAST(rank AS INTEGER) AS rank, id FROM focus"
ORACLE["scene_gate"] = f"WITH {FOCUS}, g AS (SELECT scene_id, count(*) AS n FROM focus5 GROUP BY 1) SELECT scene_id, count(*) AS objects, COALESCE(any_value(g.n), 0) AS focus, COALESCE(any_value(g.n), 0) < 3 AS skipped FROM obj LEFT JOIN g USING (scene_id) GROUP BY scene_id"
ORACLE["pairs_valid_capped"] = f"WITH {OBJ}, {VALID} SELECT scene_id, CAST(pair_ord AS INTEGER) AS pair_ord, a_ord, b_ord FROM valid WHERE pair_ord <= 100"
ORACLE["pair_reject_reasons"] = f"WITH {OBJ} SELECT a.scene_id AS scene_id, {REASON} AS reason, count(*) AS n {JOINED} GROUP BY 1, 2"
ORACLE["triples_valid_capped"] = f"""WITH {OBJ}, {VALID} SELECT scene_id, a_ord, b_ord, c_ord, CAST(triple_ord AS INTEGER) AS triple_ord FROM (SELECT x.scene_id AS scene_id, x.a_ord AS a_ord, x.b_ord AS b_ord, y.b_ord AS c_ord,
 row_number() OVER (PARTITION BY x.scene_id ORDER BY x.a_ord, x.b_ord, y.b_ord) AS triple_ord FROM valid x JOIN valid y ON x.scene_id = y.scene_id AND x.b_ord = y.a_ord JOIN valid z ON x.scene_id = z.scene_id AND x.a_ord = z.a_ord AND y.b_ord = z.b_ord) WHERE triple_ord <= 50"""
ORACLE["focus_pairs_oriented"] = f"""WITH {FOCUS}, p AS (SELECT a.scene_id AS scene_id, a.id AS x_id, b.id AS y_id, CAST(row_number() OVER (PARTITION BY a.scene_id ORDER BY a.rank, b.rank) - 1 AS INTEGER) AS pair_ord,
 substr(md5('pair:' || a.scene_id || ':' || a.id || ':' || b.id), 1, 1) IN ('8', '9', 'a', 'b', 'c', 'd', 'e', 'f') AS turned FROM focus a JOIN focus b ON a.scene_id = b.scene_id AND a.rank < b.rank)
 SELECT scene_id, pair_ord, turned, CASE WHEN turned THEN y_id ELSE x_id END AS a_id, CASE WHEN turned THEN x_id ELSE y_id END AS b_id FROM p"""
ORACLE["aabb_gap"] = f"WITH {OBJ} SELECT a.scene_id AS scene_id, a.ord AS a_ord, b.ord AS b_ord, {_gap()} AS gap {JOINED}"
ORACLE["aabb_overlap"] = f"WITH {OBJ} SELECT a.scene_id AS scene_id, a.ord AS a_ord, b.ord AS b_ord, {_overlap('a', 'b')} AS ratio {JOINED}"
ORACLE["center_distances"] = f"WITH {OBJ} SELECT a.scene_id AS scene_id, a.ord AS a_ord, b.ord AS b_ord, {_dist('a', 'b')} AS dist {JOINED}"
ORACLE["scene_statistics"] = f"""WITH {OBJ}, {VALID} SELECT o.scene_id AS scene_id, count(*) AS total_objects, count(*) FILTER (WHERE label NOT IN ({_list(BLACKLIST)})) AS valid_objects, count(DISTINCT label) AS labels,
 COALESCE((SELECT count(*) FROM valid v WHERE v.scene_id = o.scene_id AND v.pair_ord <= 100), 0) AS valid_pairs, COALESCE((SELECT max(len(polygons)) FROM polys p WHERE p.scene_id = o.scene_id), 0)::INTEGER AS rooms FROM obj o GROUP BY o.scene_id"""
ORACLE["label_histogram"] = f"WITH {PARSED} SELECT scene_id, label, count(*) AS n, count(*) FILTER (WHERE label NOT IN ({_list(BLACKLIST)})) AS valid FROM parsed GROUP BY 1, 2"

# -- cameras -----------------------------------------------------------------------------------------------------------

ORACLE["camera_height"] = f"WITH {FOCUS} SELECT scene_id, greatest(least(max(z1) + {_D(0.2)}, {_D(1.8)}), {_D(0.8)}) AS height FROM focus GROUP BY scene_id"
_TURNS = ", ".join(f"({k}, {math.cos(math.radians(30 * k))!r}::DOUBLE, {math.sin(math.radians(30 * k))!r}::DOUBLE)" for k in range(12))
ROTATION = f"""free AS (SELECT scene_id, room_idx, x AS px, y AS py, {_D(1.5)} AS pz FROM centers), turns(angle_idx, co, si) AS (VALUES {_TURNS}),
 rot AS (SELECT c.*, t.* FROM free c, turns t WHERE NOT EXISTS (SELECT 1 FROM everything e WHERE e.scene_id = c.scene_id AND {IN_MARGIN('c', 'e')}))"""
ORACLE["rotation_poses"] = f"WITH {OBJ}, {ALL}, {CENTERS}, {ROTATION} SELECT scene_id, CAST(room_idx AS INTEGER) AS room_idx, angle_idx, px, py, pz, angle_idx * {_D(30)} AS yaw, round_even((px + co) * 1e6::DOUBLE, 0) AS tx, round_even((py + si) * 1e6::DOUBLE, 0) AS ty FROM rot"
ORACLE["rotation_stride6"] = f"""WITH {OBJ}, {ALL}, {CENTERS}, {ROTATION}, k AS (SELECT *, count(*) OVER (PARTITION BY scene_id) AS n, row_number() OVER (PARTITION BY scene_id ORDER BY room_idx, angle_idx) - 1 AS place FROM rot),
 st AS (SELECT *, CASE WHEN n > 6 THEN greatest(1, n // 6) ELSE 1 END AS step FROM k) SELECT scene_id, CAST(place // step AS INTEGER) AS pose, CAST(room_idx AS INTEGER) AS room_idx, angle_idx FROM st WHERE place % step = 0 AND place // step < 6"""
ORACLE["position_valid_anti"] = f"""WITH {OBJ}, {ALL}, {POSES}, {BOUNDS} SELECT p.scene_id AS scene_id, p.pose_row AS pose_row FROM poses p LEFT JOIN bounds b USING (scene_id) LEFT JOIN polys r USING (scene_id)
 WHERE p.pz BETWEEN 0.8::DOUBLE AND 1.8::DOUBLE AND (b.x0 IS NULL OR (p.px >= b.x0 + 0.1::DOUBLE AND p.px <= b.x1 - 0.1::DOUBLE AND p.py >= b.y0 + 0.1::DOUBLE AND p.py <= b.y1 - 0.1::DOUBLE))
 AND (COALESCE(len(r.polygons), 0) = 0 OR list_contains([{_in_polygon('p.px', 'p.py', 'poly')} FOR poly IN r.polygons], true))
 AND NOT EXISTS (SELECT 1 FROM everything e WHERE e.scene_id = p.scene_id AND {IN_MARGIN('p', 'e')})"""


def _slabs(o: str, d: str, b: str) -> tuple[str, str, str]:
    t = lambda v, n: f"({b}.{v}{n} - {o}{v}) * (1::DOUBLE / NULLIF({d}{v}, 0))"
    flat = lambda v: f"abs({d}{v}) < 1e-12"
    enter = "greatest(" + ", ".join(f"CASE WHEN {flat(v)} THEN -1e300::DOUBLE ELSE least({t(v, 0)}, {t(v, 1)}) END" for v in "xyz") + ")"
    leave = "least(" + ", ".join(f"CASE WHEN {flat(v)} THEN 1e300::DOUBLE ELSE greatest({t(v, 0)}, {t(v, 1)}) END" for v in "xyz") + ")"
    out = " OR ".join(f"({flat(v)} AND ({o}{v} < {b}.{v}0 OR {o}{v} > {b}.{v}1))" for v in "xyz")
    return enter, leave, f"NOT ({out})"


_E, _L, _IN = _slabs("p.p", "p.v", "o")
ORACLE["ray_box_hits"] = f"""WITH {OBJ}, {POSES}, rays AS (SELECT *, tx - px AS vx, ty - py AS vy, tz - pz AS vz FROM poses), h AS (SELECT p.pose_row AS pose_row, o.ord AS ord, {_E} AS enter, {_L} AS leave
 FROM rays p JOIN obj o USING (scene_id) WHERE {_IN}) SELECT * FROM h WHERE leave >= greatest(enter, 0::DOUBLE)"""
SEEN = "seen AS (SELECT p.*, f.id, f.label, f.rank, f.x0, f.y0, f.z0, f.x1, f.y1, f.z1 FROM poses p JOIN focus f USING (scene_id))"
_CORNERS = [f"[{x}, {y}, {z}]" for x in ("x0", "x1") for y in ("y0", "y1") for z in ("z0", "z1")]
_POINTS = f"[[(x0 + x1) / 2, (y0 + y1) / 2, (z0 + z1) / 2], {', '.join(_CORNERS)}]"
_FAR = _sqrt3("q[1] - px", "q[2] - py", "q[3] - pz")
RAYS = f"""pts AS (SELECT *, unnest(range(0, 9)) AS point, unnest({_POINTS}) AS q FROM seen), far_ AS (SELECT *, {_FAR} AS far FROM pts),
 rays AS (SELECT *, (q[1] - px) / NULLIF(far, 0) AS ux, (q[2] - py) / NULLIF(far, 0) AS uy, (q[3] - pz) / NULLIF(far, 0) AS uz FROM far_)"""
_E2, _L2, _IN2 = _slabs("r.p", "r.u", "o")
_WALL = "(o.label = 'wall' OR o.id LIKE 'wall%')"


def _blocked(counts: str) -> str:
    return f"""blocked AS (SELECT DISTINCT pose_row, scene_id, id, point FROM (SELECT r.pose_row, r.scene_id, r.id, r.point, r.far, {_E2} AS enter, {_L2} AS leave FROM rays r JOIN hiding o ON o.scene_id = r.scene_id AND o.id <> r.id WHERE r.far >= 1e-6 AND {_IN2} AND {counts})
 WHERE leave >= greatest(enter, 0::DOUBLE) AND enter >= 0 AND enter <= far - 0.001::DOUBLE)"""


def _occlusion(counts: str) -> str:
    return f"""WITH {FOCUS}, {ALL}, {HIDING}, {POSES}, {SEEN}, {RAYS}, {_blocked(counts)}, sums AS (SELECT scene_id, pose_row, id, count(*) AS k, max(CASE WHEN point = 0 THEN 1 ELSE 0 END) AS c FROM blocked GROUP BY 1, 2, 3)
 SELECT s.scene_id AS scene_id, s.pose_row AS pose_row, s.id AS id, CAST(COALESCE(k, 0) AS INTEGER) AS hidden_points, COALESCE(c, 0) = 1 AS center_hidden, COALESCE(c, 0) = 1 OR COALESCE(k, 0) / 9.0::DOUBLE >= 0.5 AS occluded FROM seen s LEFT JOIN sums USING (scene_id, pose_row, id)"""


ORACLE["wall_occlusion_ratio"] = _occlusion(f"{_WALL} AND ({_overlap('r', 'o')}) <= 0.3")
ORACLE["object_occlusion_ratio"] = _occlusion(f"({_overlap('r', 'o')}) <= 0.3 AND ({_WALL} OR {_gap('r', 'o')} >= 0.3)")

_LOOK = _sqrt3("tx - px", "ty - py", "tz - pz")
VIEW = f"""v1 AS (SELECT *, {_LOOK} AS far_look FROM seen), v2 AS (SELECT *, {', '.join(f"CASE WHEN far_look < 1e-8 THEN {_D(1 if a == 'y' else 0)} ELSE (t{a} - p{a}) / NULLIF(far_look, 0) END AS f{a}" for a in 'xyz')} FROM v1),
 v3 AS (SELECT *, fy * 1::DOUBLE - fz * 0::DOUBLE AS sx, fz * 0::DOUBLE - fx * 1::DOUBLE AS sy, fx * 0::DOUBLE - fy * 0::DOUBLE AS sz FROM v2), v4 AS (SELECT *, {_sqrt3('sx', 'sy', 'sz')} AS wide FROM v3),
 v5 AS (SELECT *, {', '.join(f"CASE WHEN wide < 1e-6 THEN {_D(1 if a == 'x' else 0)} ELSE s{a} / NULLIF(wide, 0) END AS r{a}" for a in 'xyz')} FROM v4),
 v6 AS (SELECT *, ry * fz - rz * fy AS upx, rz * fx - rx * fz AS upy, rx * fy - ry * fx AS upz FROM v5)"""
_REL = "(q[1] - px)", "(q[2] - py)", "(q[3] - pz)"
_DOT = lambda n: " + ".join(f"{n}{a} * {r}" for a, r in zip("xyz", _REL, strict=True))
_F = 512 / (2 * math.tan(math.radians(60.0) / 2))
CAST_POINTS = f"""w1 AS (SELECT *, unnest(range(0, 9)) AS point, unnest({_POINTS.replace('(x0 + x1) / 2', '0.5::DOUBLE * (x0 + x1)').replace('(y0 + y1) / 2', '0.5::DOUBLE * (y0 + y1)').replace('(z0 + z1) / 2', '0.5::DOUBLE * (z0 + z1)')}) AS q FROM v6),
 w2 AS (SELECT scene_id, pose_row, id, rank, point, -({_DOT('r')}) AS wx, {_DOT('up')} AS wy, {_DOT('f')} AS wz FROM w1),
 w3 AS (SELECT *, wz > 1e-6 AS front, {_F!r}::DOUBLE * (wx / NULLIF(wz, 0)) + 256::DOUBLE AS u, {_F!r}::DOUBLE * (wy / NULLIF(wz, 0)) + 256::DOUBLE AS v FROM w2)"""
_INSIDE = lambda b: f"(front AND u BETWEEN {b} AND {511 - b} AND v BETWEEN {b} AND {511 - b})"
CAM = f"{FOCUS}, {POSES}, {SEEN}, {VIEW}, {CAST_POINTS}"
FOV = f"""fov AS (SELECT pose_row, id, any_value(scene_id) AS scene_id, any_value(rank) AS rank, CASE WHEN NOT bool_or(front AND point > 0) THEN 'all_corners_behind_camera' WHEN NOT bool_or({_INSIDE(5)} AND point > 0) THEN 'no_corner_in_image'
 WHEN NOT bool_or({_INSIDE(5)} AND point = 0) THEN 'center_not_in_image' ELSE 'ok' END AS reason, count(*) FILTER (WHERE {_INSIDE(2)} AND point > 0) AS corners FROM w3 GROUP BY pose_row, id)"""
ORACLE["fov_center_visible"] = f"WITH {CAM}, {FOV} SELECT pose_row, id, reason FROM fov"
ORACLE["visible_corner_count"] = f"WITH {CAM}, {FOV} SELECT pose_row, id, CAST(corners AS INTEGER) AS corners FROM fov"
ORACLE["unhidden_corner_count"] = f"""WITH {CAM}, {ALL}, {HIDING}, {RAYS}, {_blocked('true')} SELECT w.scene_id AS scene_id, w.pose_row AS pose_row, w.id AS id, CAST(count(*) FILTER (WHERE {_INSIDE(2)} AND b.point IS NULL) AS INTEGER) AS corners
 FROM w3 w LEFT JOIN blocked b ON b.pose_row = w.pose_row AND b.id = w.id AND b.scene_id = w.scene_id AND b.point = w.point WHERE w.point > 0 GROUP BY 1, 2, 3"""
_VISIBLE = f"WITH {CAM}, {FOV}, vis AS (SELECT * FROM fov WHERE reason = 'ok' AND corners >= 2)"
ORACLE["visible_objects"] = f"{_VISIBLE} SELECT pose_row, id FROM vis"
ORACLE["visible_pairs"] = f"{_VISIBLE} SELECT a.pose_row AS pose_row, a.id AS a_id, b.id AS b_id FROM vis a JOIN vis b ON a.pose_row = b.pose_row AND a.rank < b.rank"

_M6 = lambda v, n: f"round_even(({v}) * 1e6::DOUBLE, 0) AS {n}"
_CROSS = lambda a, b: {v: f"{a}{p} * {b}{q} - {a}{q} * {b}{p}" for v, (p, q) in zip("xyz", ("yz", "zx", "xy"), strict=True)}
_SIDE2 = lambda k: {v: e.replace("kx", k[0]).replace("ky", k[1]).replace("kz", k[2]) for v, e in _CROSS("f", "k").items()}
_UPZ, _UPY = _SIDE2(("0::DOUBLE", "0::DOUBLE", "1::DOUBLE")), _SIDE2(("0::DOUBLE", "1::DOUBLE", "0::DOUBLE"))
ORACLE["render_matrices"] = f"""WITH {POSES}, a AS (SELECT *, {_LOOK} AS far_look FROM poses), b AS (SELECT *, {', '.join(f"CASE WHEN far_look < 1e-8 THEN {_D(1 if v == 'z' else 0)} ELSE (t{v} - p{v}) / NULLIF(far_look, 0) END AS f{v}" for v in 'xyz')} FROM a),
 c AS (SELECT *, {', '.join(f"{_UPZ[v]} AS s{v}, {_UPY[v]} AS o{v}" for v in 'xyz')} FROM b), e AS (SELECT *, {', '.join(f"CASE WHEN {_sqrt3('sx', 'sy', 'sz')} < 1e-6 THEN o{v} ELSE s{v} END AS h{v}" for v in 'xyz')} FROM c),
 w AS (SELECT *, {_sqrt3('hx', 'hy', 'hz')} AS wide FROM e), r AS (SELECT *, {', '.join(f"CASE WHEN wide < 1e-12 THEN {_D(1 if v == 'x' else 0)} ELSE h{v} / NULLIF(wide, 0) END AS r{v}" for v in 'xyz')} FROM w)
 SELECT pose_row, {', '.join(_M6(f'r{v}', f'right_{v}') for v in 'xyz')}, {', '.join(_M6(e, f'down_{v}') for v, e in _CROSS('f', 'r').items())}, {', '.join(_M6(f'f{v}', f'forward_{v}') for v in 'xyz')} FROM r"""
ORACLE["all_targets_in_fov"] = f"WITH {CAM}, {FOV} SELECT pose_row, bool_and(reason = 'ok') AS all_visible, CAST(count(*) FILTER (WHERE reason <> 'ok') AS INTEGER) AS failed FROM fov GROUP BY 1"
ORACLE["projected_centers"] = f"WITH {CAM} SELECT pose_row, id, round_even(CASE WHEN front THEN u END * 1000::DOUBLE, 0) AS u, round_even(CASE WHEN front THEN v END * 1000::DOUBLE, 0) AS v, round_even(wz * 1000::DOUBLE, 0) AS z FROM w3 WHERE point = 0"

# -- questions ---------------------------------------------------------------------------------------------------------


def _fill(template: str, **names: str) -> str:
    parts, rest = [], template
    while rest:
        at = min((i for n in names if (i := rest.find("{" + n + "}")) >= 0), default=-1)
        if at < 0:
            parts.append("'" + rest.replace("'", "''") + "'")
            break
        name = rest[at + 1 : rest.index("}", at)]
        if at:
            parts.append("'" + rest[:at].replace("'", "''") + "'")
        parts.append(names[name])
        rest = rest[at + len(name) + 2 :]
    return "(" + " || ".join(parts) + ")"


def _text(template: str, *posts: str, **names: str) -> str:
    return _fill(" ".join([template, *posts]), **names)


def _r2(x: str) -> str:
    return f"round_even(({x}) * 100::DOUBLE, 0) / 100::DOUBLE"


def _num(x: str) -> str:
    return f"CAST({_r2(x)} AS VARCHAR)"


DIMS = "dims(dim) AS (VALUES ('length'), ('width'), ('height'))"
_DIM = lambda t: f"CASE dim WHEN 'length' THEN greatest({t}.dx, {t}.dy) WHEN 'width' THEN least({t}.dx, {t}.dy) ELSE {t}.dz END"
FPAIR = "focus a JOIN focus b ON a.scene_id = b.scene_id AND a.rank < b.rank"
NUMBERS = (qs.NUMBER_POST, qs.NUMBER_OUT)


def _out(value: str, kind: str, ids: str, text: str, source: str, key: str = "a.scene_id AS scene_id") -> str:
    return f"SELECT {key}, '{kind}_' || {ids} AS question_id, {value} AS value, {_num(value)} AS answer, {text} AS question FROM {source}"


ORACLE["q_object_size"] = f"WITH {FOCUS}, {DIMS} " + _out(_DIM("a"), "object_size", "a.id || '_' || dim", _text(qs.SIZE, *NUMBERS, dimension="dim", object="a.label"), "focus a, dims")
ORACLE["q_distance_to_camera"] = f"""WITH {FOCUS}, {POSES}, x AS (SELECT p.pose_row, 'object_distance_to_camera_' || a.id AS question_id, {_sqrt3('a.cx - p.px', 'a.cy - p.py', 'a.cz - p.pz')} AS value FROM focus a JOIN poses p USING (scene_id))
 SELECT *, {_num('value')} AS answer FROM x"""
ORACLE["q_size_ratio"] = f"WITH {FOCUS}, {DIMS} " + _out(f"({_DIM('a')}) / (({_DIM('b')}) + {_D('1e-9')})", "object_size_comparison_relative", "a.id || '_' || b.id || '_' || dim", _text(qs.SIZE_RATIO, *NUMBERS, dimension="dim", object1="a.label", object2="b.label"), f"{FPAIR}, dims")
ORACLE["q_size_absolute"] = f"WITH {FOCUS}, {DIMS} " + _out(_DIM("a"), "object_size_comparison_absolute", "a.id || '_' || b.id || '_' || dim", _text(qs.SIZE_ABSOLUTE, *NUMBERS, dimension="dim", object1="a.label", object2="b.label", obj2_dimension=_num(_DIM("b"))), f"{FPAIR}, dims")
ORACLE["q_pair_distance"] = f"WITH {FOCUS} " + _out(_dist("a", "b"), "object_pair_distance_center", "a.id || '_' || b.id", _text(qs.PAIR_DISTANCE, qs.DISTANCE_POST, *NUMBERS, object1="a.label", object2="b.label"), FPAIR)
ORACLE["q_pair_distance_w_size"] = f"WITH {FOCUS}, {DIMS} " + _out(_dist("a", "b"), "object_pair_distance_center_w_size", "a.id || '_' || b.id || '_' || dim", _text(qs.PAIR_DISTANCE_SIZED, qs.DISTANCE_POST, *NUMBERS, dimension="dim", object1="a.label", object2="b.label", obj1_dimension=_num(_DIM("a"))), f"{FPAIR}, dims WHERE ({_DIM('a')}) >= 0.01")
_VEC = {"x": "(x * cos(w) - z2 * sin(w))", "y": "y2", "z": "(x * sin(w) + z2 * cos(w))"}
ORACLE["q_pair_vector"] = f"""WITH {FOCUS}, {POSES}, d AS (SELECT p.pose_row, a.id AS a_id, b.id AS b_id, b.cx - a.cx AS x, b.cy - a.cy AS y, b.cz - a.cz AS z, radians(p.yaw) AS w, radians(p.pitch) AS t FROM {FPAIR} JOIN poses p ON p.scene_id = a.scene_id),
 e AS (SELECT *, y * cos(t) - z * sin(t) AS y2, y * sin(t) + z * cos(t) AS z2 FROM d) SELECT pose_row, a_id, b_id, {', '.join(f'round_even({v} * 1e3::DOUBLE + 1e-7::DOUBLE, 0) AS v{a}' for a, v in _VEC.items())} FROM e"""
FOUR = "four AS (SELECT a.scene_id AS scene_id, " + ", ".join(f"{r}.{c} AS {r}_{c}" for r in "abxy" for c in ("id", "label", "cx", "cy", "cz")) + " FROM focus a " + " ".join(f"JOIN focus {r} ON {r}.scene_id = a.scene_id AND {r}.rank = {k}" for k, r in enumerate("bxy", 1)) + " WHERE a.rank = 0)"
_D4 = lambda a, b: _sqrt3(*(f"{a}_c{v} - {b}_c{v}" for v in "xyz"))
_N4 = {"objectX": "x_label", "objectY": "y_label", "objectA": "a_label", "objectB": "b_label"}
_ID4 = "a_id || '_' || b_id || '_' || x_id || '_' || y_id"
ORACLE["q_multi_abs"] = f"WITH {FOCUS}, {FOUR} " + _out(_D4("a", "b"), "object_comparison_absolute_distance", _ID4, _text(qs.MULTI_ABSOLUTE, qs.DISTANCE_POST, *NUMBERS, distance=_num(_D4("x", "y")), **_N4), "four", "scene_id")
ORACLE["q_multi_ratio"] = f"WITH {FOCUS}, {FOUR} " + _out(f"({_D4('a', 'b')}) / ({_D4('x', 'y')})", "object_comparison_relative_distance", _ID4, _text(qs.MULTI_RATIO, qs.DISTANCE_POST, *NUMBERS, **_N4), f"four WHERE ({_D4('x', 'y')}) >= 0.01", "scene_id")


def _uniform(channel: str, *parts: str) -> str:
    return f"(CAST('0x' || substr(md5('42:{channel}:' || {' || \':\' || '.join(parts)}), 1, 13) AS BIGINT) / 4503599627370496::DOUBLE)"


def _yes_no(inner: str, key: str, scope: list[str], template: str, names: str, text: bool = True) -> str:
    listed = template + "\n\n(A) {first}\n(B) {second}"
    q = f", {_text(listed, qs.LETTER_POST, qs.LETTER_OUT, first='first', second='second', **dict(n.split('=') for n in names.split()))} AS question" if text else ""
    return f"""{inner}, y AS (SELECT *, CASE WHEN yes THEN 'Yes' ELSE 'No' END AS answer_text, CASE WHEN {_uniform('yes_no', *scope, 'question_id')} < 0.5 THEN 'Yes' ELSE 'No' END AS first FROM x),
 z AS (SELECT *, CASE WHEN first = 'Yes' THEN 'No' ELSE 'Yes' END AS second FROM y) SELECT {key}, question_id, answer_text, CASE WHEN first = answer_text THEN 'A' ELSE 'B' END AS answer{q} FROM z"""


ORACLE["q_relative_size"] = _yes_no(f"WITH {FOCUS}, x AS (SELECT a.scene_id AS scene_id, 'relative_size_' || a.id || '_' || b.id AS question_id, a.label AS a_label, b.label AS b_label, a.dx * a.dy * a.dz > b.dx * b.dy * b.dz AS yes FROM {FPAIR})", "scene_id", ["scene_id"], qs.LARGER, "object1=a_label object2=b_label")
ORACLE["q_relative_distance"] = _yes_no(f"WITH {FOCUS}, {FOUR}, x AS (SELECT *, 'relative_distance_' || a_id || '_' || b_id || '_' || x_id AS question_id, {_D4('a', 'b')} > {_D4('a', 'x')} AS yes FROM four)", "scene_id", ["scene_id"], qs.FARTHER_APART, "object1=a_label object2=b_label object3=x_label")
ORACLE["q_relative_distance_camera"] = _yes_no(
    f"WITH {FOCUS}, {POSES}, x AS (SELECT p.pose_row, a.scene_id AS scene_id, 'relative_distance_to_camera_' || a.id || '_' || b.id AS question_id, {_sqrt3('a.cx - p.px', 'a.cy - p.py', 'a.cz - p.pz')} > {_sqrt3('b.cx - p.px', 'b.cy - p.py', 'b.cz - p.pz')} AS yes FROM {FPAIR} JOIN poses p ON p.scene_id = a.scene_id)",
    "pose_row", ["scene_id", "CAST(pose_row AS VARCHAR)"], qs.FARTHER, "", text=False,
)
ORACLE["multi_object_draws"] = f"""WITH {FOCUS}, u AS (SELECT scene_id, id, rank, draw, {_uniform('draw', 'scene_id', 'CAST(draw AS VARCHAR)', 'id')} AS r FROM focus, (SELECT unnest(range(0, 5)) AS draw)),
 k AS (SELECT *, row_number() OVER (PARTITION BY scene_id, draw ORDER BY r, rank) AS k, count(*) OVER (PARTITION BY scene_id, draw) AS n FROM u),
 g AS (SELECT scene_id, draw, max(n) AS n, {', '.join(f"max(CASE WHEN k = {i} THEN id END) AS s{i}" for i in range(1, 5))} FROM k WHERE n >= 3 GROUP BY 1, 2)
 SELECT scene_id, CAST(draw AS INTEGER) AS draw, s1 AS a_id, s2 AS b_id, CASE WHEN n = 3 THEN s1 ELSE s3 END AS x_id, CASE WHEN n = 3 THEN s3 ELSE s4 END AS y_id FROM g"""
ORACLE["pivot_triples"] = f"""WITH {FOCUS}, u AS (SELECT a.scene_id AS scene_id, a.id AS a_id, a.rank AS a_rank, o.id AS o_id, o.rank AS o_rank, {_uniform('pivot', 'a.scene_id', 'a.id', 'o.id')} AS r FROM focus a JOIN focus o ON a.scene_id = o.scene_id AND a.id <> o.id),
 k AS (SELECT *, row_number() OVER (PARTITION BY scene_id, a_id, a_rank ORDER BY r, o_rank) AS k FROM u) SELECT scene_id, a_id, max(CASE WHEN k = 1 THEN o_id END) AS b_id, max(CASE WHEN k = 2 THEN o_id END) AS x_id FROM k WHERE k <= 2 GROUP BY scene_id, a_id, a_rank HAVING count(*) = 2"""

_SPARE = ", ".join(_r2(f"answer_value + 0.51::DOUBLE * {k}") for k in range(1, 8))


def _choices(head: str, scope: str, named: str) -> str:
    """Four choices for the questions of CTE m (scope, question_id, answer_value); `named` is the scope as texts."""
    u = lambda ch: _uniform(ch, *named.split(", "), "question_id", "CAST(i AS VARCHAR)")
    times = f"CASE WHEN {u('side')} < 0.5 THEN 0.3::DOUBLE + {u('times')} * 0.4::DOUBLE ELSE 1.3::DOUBLE + {u('times')} * 1.2::DOUBLE END"
    tried = _r2(f"answer_value * ({times})")
    return f"""WITH {head},
 t AS (SELECT *, [CASE WHEN {tried} > 0 THEN {tried} ELSE {_r2(f"0.1::DOUBLE + {u('small')} * 1.9::DOUBLE")} END FOR i IN range(0, 50)] || [{_SPARE}] AS c FROM m),
 o AS (SELECT *, [c[j] FOR j IN range(1, len(c) + 1) IF list_position(c, c[j]) = j AND c[j] <> answer_value][1:3] AS others FROM t),
 p AS (SELECT *, [s.v FOR s IN list_sort([{{'k': {_uniform('place', *named.split(", "), 'question_id', 'CAST(v AS VARCHAR)')}, 'v': v}} FOR v IN [answer_value] || others])] AS vals FROM o)
 SELECT {scope}, question_id, answer_value, substr('ABCD', CAST(list_position(vals, answer_value) AS INTEGER), 1) AS answer, {', '.join(f"CAST(vals[{i + 1}] AS VARCHAR) AS choice_{x}" for i, x in enumerate('abcd'))} FROM p"""


ORACLE["mc_choices"] = _choices(f"{FOCUS}, m AS (SELECT a.scene_id AS scene_id, 'mc_object_pair_distance_center_' || a.id || '_' || b.id AS question_id, {_r2(_dist('a', 'b'))} AS answer_value FROM {FPAIR})", "scene_id", "scene_id")
ORACLE["mc_size_choices"] = _choices(f"{FOCUS}, {DIMS}, m AS (SELECT a.scene_id AS scene_id, 'mc_object_size_' || a.id || '_' || dim AS question_id, {_r2(_DIM('a'))} AS answer_value FROM focus a, dims)", "scene_id", "scene_id")
ORACLE["mc_camera_choices"] = _choices(
    f"{FOCUS}, {POSES}, m AS (SELECT p.pose_row AS pose_row, 'mc_object_distance_to_camera_' || a.id AS question_id, {_r2(_sqrt3('a.cx - p.px', 'a.cy - p.py', 'a.cz - p.pz'))} AS answer_value FROM focus a JOIN poses p ON a.scene_id = p.scene_id)", "pose_row", "CAST(pose_row AS VARCHAR)"
)

# -- statistics --------------------------------------------------------------------------------------------------------

_NUMERIC = "('object_size', 'object_distance_to_camera', 'object_pair_distance_center')"
_VALUES = f"vals AS (SELECT question_type, try_cast(answer AS DOUBLE) AS v FROM questions WHERE question_type IN {_NUMERIC} AND try_cast(answer AS DOUBLE) IS NOT NULL)"
_R4 = lambda x: f"round_even(({x}) * 10000::DOUBLE, 0) / 10000::DOUBLE"
ORACLE["type_stats"] = "SELECT COALESCE(question_type, 'unknown') AS question_type, count(*) AS n FROM questions GROUP BY 1"
ORACLE["cross_tab_counters"] = """WITH b AS (SELECT COALESCE(pattern_name, '?') AS pattern_name, COALESCE(question_type, 'unknown') AS question_type, COALESCE(scene_id, '?') AS scene_id FROM questions)
 SELECT pattern_name, question_type, scene_id, count(*) AS n, CAST(grouping(pattern_name, question_type, scene_id) AS INTEGER) AS level FROM b
 GROUP BY GROUPING SETS ((pattern_name), (question_type), (scene_id), (pattern_name, question_type), (scene_id, pattern_name), (scene_id, question_type))"""
ORACLE["label_top100"] = "SELECT label, count(*) AS n FROM (SELECT unnest([o.label FOR o IN objects]) AS label FROM questions) WHERE label IS NOT NULL AND label <> '' GROUP BY 1 ORDER BY n DESC, label LIMIT 100"
ORACLE["yes_no_balance"] = "SELECT question_type, COALESCE(NULLIF(answer_text, ''), answer) AS answer_text, count(*) AS n FROM questions WHERE question_type IN ('relative_size', 'relative_distance', 'relative_distance_to_camera') GROUP BY 1, 2"
ORACLE["choice_answers"] = "SELECT answer, COALESCE(mc_source_type, 'unknown') AS mc_source_type, count(*) AS n FROM questions WHERE question_type = 'mc' GROUP BY 1, 2"
ORACLE["numeric_summary"] = f"WITH {_VALUES} SELECT question_type, count(*) AS n, {_R4('min(v)')} AS least, {_R4('max(v)')} AS most, {_R4('avg(v)')} AS mean, {_R4('median(v)')} AS median FROM vals GROUP BY 1"
ORACLE["histogram20"] = f"""WITH {_VALUES}, s0 AS (SELECT question_type, min(v) AS a, max(v) AS b FROM vals GROUP BY 1), s AS (SELECT question_type, CASE WHEN a = b THEN a - 0.5 ELSE a END AS a, CASE WHEN a = b THEN b + 0.5 ELSE b END AS b FROM s0),
 c AS (SELECT question_type, CAST(least(floor((v - a) / (b - a) * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM vals JOIN s USING (question_type) GROUP BY 1, 2),
 e AS (SELECT question_type, CAST(unnest(range(0, 20)) AS INTEGER) AS bin, a, (b - a) / 20 AS w FROM s)
 SELECT question_type, bin, {_R4('a + w * bin')} AS low, {_R4('a + w * (bin + 1)')} AS high, COALESCE(n, 0) AS n FROM e LEFT JOIN c USING (question_type, bin)"""
ORACLE["pose_refs_distinct"] = "SELECT scene_id, count(DISTINCT CASE WHEN camera_pose_idx IS NOT NULL THEN COALESCE(pattern_name, '') || '|' || camera_pose_idx END) AS pose_refs FROM questions GROUP BY 1"
ORACLE["heatmap_scene_pattern"] = "SELECT scene_id, " + ", ".join(f"count(*) FILTER (WHERE pattern_name = '{p}') AS {p}" for p in ("around", "linear", "rotation", "spherical")) + " FROM questions WHERE scene_id IS NOT NULL GROUP BY 1"
ORACLE["heatmap_pattern_type"] = "SELECT pattern_name, " + ", ".join(f"count(*) FILTER (WHERE question_type = '{t}') AS {t}" for t in sorted(("object_size", "object_distance_to_camera", *qs.Questions().enabled_question_types[2:]))) + " FROM questions GROUP BY 1"
ORACLE["focus_labels"] = "SELECT scene_id, array_to_string(list_sort(list(DISTINCT label)), '|') AS labels, CAST(count(DISTINCT label) AS INTEGER) AS num_objects FROM (SELECT scene_id, unnest(focus_objects) AS label FROM run_metadata) WHERE label IS NOT NULL GROUP BY 1"
ORACLE["scene_overview"] = """WITH q AS (SELECT scene_id, COALESCE(pattern_name, 'unknown') AS p, COALESCE(question_type, 'unknown') AS t, pattern_name, camera_pose_idx FROM questions WHERE scene_id IS NOT NULL),
 a AS (SELECT scene_id, count(*) AS total_questions, count(DISTINCT CASE WHEN camera_pose_idx IS NOT NULL THEN p || '|' || camera_pose_idx END) AS camera_pose_refs FROM q GROUP BY 1),
 b AS (SELECT scene_id, string_agg(p || '=' || n, '|' ORDER BY p) AS by_pattern FROM (SELECT scene_id, p, count(*) AS n FROM q GROUP BY 1, 2) GROUP BY 1),
 c AS (SELECT scene_id, string_agg(t || '=' || n, '|' ORDER BY t) AS by_type FROM (SELECT scene_id, t, count(*) AS n FROM q GROUP BY 1, 2) GROUP BY 1),
 f AS (SELECT scene_id, CAST(count(DISTINCT label) AS INTEGER) AS num_objects FROM (SELECT scene_id, unnest(focus_objects) AS label FROM run_metadata) WHERE label IS NOT NULL GROUP BY 1)
 SELECT scene_id, total_questions, camera_pose_refs, by_pattern, by_type, COALESCE(num_objects, 0) AS num_objects FROM a JOIN b USING (scene_id) JOIN c USING (scene_id) LEFT JOIN f USING (scene_id)"""
ORACLE["category_split_counts"] = """SELECT CASE WHEN answer_type = 'mc' THEN 'mc' ELSE 'numerical' END AS category, CASE WHEN COALESCE(question_type, 'unknown') = 'mc' THEN 'mc_' || COALESCE(mc_source_type, 'unknown') ELSE COALESCE(question_type, 'unknown') END AS sub, count(*) AS n FROM questions GROUP BY 1, 2"""
_CHUNK = "pattern_name || '__' || scene_id || '.json' AS chunk_file"
ORACLE["question_index"] = f"SELECT scene_id, pattern_name, question_id, question_type, answer_type, question, answer, answer_text, primary_object, camera_pose_idx, mc_source_type, image, image_path, array_to_string([COALESCE(o.label, '?') FOR o IN objects], '|') AS object_labels, {_CHUNK} FROM questions WHERE scene_id IS NOT NULL"
ORACLE["chunk_manifest"] = f"SELECT q.scene_id AS scene_id, q.pattern_name AS pattern_name, question_count, num_cameras, num_questions, num_focus_objects, num_focus_pairs, concat_ws('__', q.pattern_name, q.scene_id || '.json') AS chunk_file FROM (SELECT scene_id, pattern_name, count(*) AS question_count FROM questions GROUP BY 1, 2) q LEFT JOIN run_metadata m ON m.scene_id = q.scene_id AND m.pattern_name = q.pattern_name"
ORACLE["run_metadata"] = "SELECT scene_id, pattern_name, count(*) AS num_questions, COALESCE(string_agg(DISTINCT question_type, '|' ORDER BY question_type), '') AS question_types FROM questions GROUP BY 1, 2"
ORACLE["run_summary"] = "SELECT count(*) AS total_questions, count(DISTINCT scene_id) AS total_scenes, count(DISTINCT CASE WHEN scene_id IS NOT NULL AND pattern_name IS NOT NULL THEN scene_id || '|' || pattern_name END) AS runs FROM questions"
ORACLE["min_views_semijoin"] = "SELECT q_row, scene_id, question_id FROM questions WHERE (scene_id, question_id) IN (SELECT (scene_id, question_id) FROM questions WHERE scene_id IS NOT NULL AND question_id IS NOT NULL GROUP BY scene_id, question_id HAVING count(DISTINCT camera_pose_idx) >= 2)"
ORACLE["scene_cap_prefix"] = "SELECT * FROM (SELECT q_row, scene_id, CAST(row_number() OVER (PARTITION BY scene_id ORDER BY q_row) AS INTEGER) AS k FROM questions WHERE scene_id IS NOT NULL) WHERE k <= 100"
ORACLE["type_cap_prefix"] = "SELECT q_row, scene_id, question_type FROM (SELECT q_row, scene_id, question_type, row_number() OVER (PARTITION BY scene_id, pattern_name, camera_pose_idx, question_type ORDER BY q_row) AS k FROM questions WHERE scene_id IS NOT NULL AND camera_pose_idx IS NOT NULL) WHERE k <= 5"
ORACLE["pose_index_dense"] = """WITH f AS (SELECT q_row, scene_id, pattern_name, array_to_string(camera_pose.position, ',') AS pos, array_to_string(camera_pose.target, ',') AS tgt FROM questions WHERE scene_id IS NOT NULL AND camera_pose.position IS NOT NULL AND camera_pose.target IS NOT NULL),
 m AS (SELECT scene_id, pattern_name, pos, tgt, min(q_row) AS first FROM f GROUP BY ALL), k AS (SELECT *, CAST(row_number() OVER (PARTITION BY scene_id, pattern_name ORDER BY first) - 1 AS INTEGER) AS pose_idx FROM m)
 SELECT q_row, scene_id, pattern_name, pose_idx FROM f JOIN k USING (scene_id, pattern_name, pos, tgt)"""
ORACLE["first_pose_per_idx"] = "SELECT scene_id, pattern_name, camera_pose_idx, min(q_row) AS first_row, (first(camera_pose ORDER BY q_row)).yaw AS yaw FROM questions WHERE scene_id IS NOT NULL AND camera_pose_idx IS NOT NULL GROUP BY 1, 2, 3"
_SANE = lambda c: f"COALESCE(NULLIF(regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\-]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown')"
ORACLE["view_counter"] = f"""WITH k AS (SELECT pose_row, scene_id, pattern_name, pose_idx, COALESCE(array_to_string(list_sort([{_SANE('t')} FOR t IN camera_pose.target_objects IF t IS NOT NULL]), '_'), '') AS object_key FROM camera_poses)
 SELECT pose_row, object_key, CAST(row_number() OVER (PARTITION BY scene_id, pattern_name, object_key ORDER BY pose_idx, pose_row) - 1 AS INTEGER) AS view FROM k"""
_PATH = "format('{}/{}/images/pose_{:04d}.png', pattern_name, scene_id, camera_pose_idx)"
ORACLE["missing_images_anti"] = f"SELECT * FROM (SELECT DISTINCT scene_id, pattern_name, camera_pose_idx, {_PATH} AS image_path FROM questions WHERE camera_pose_idx >= 0 AND scene_id IS NOT NULL) WHERE image_path NOT IN (SELECT image_path FROM rendered_images WHERE image_path IS NOT NULL)"
ORACLE["image_path_update"] = f"SELECT q_row, CASE WHEN camera_pose_idx >= 0 AND {_PATH} IN (SELECT image_path FROM rendered_images WHERE image_path IS NOT NULL) THEN {_PATH} ELSE image_path END AS image_path FROM questions"
_FILE = "format('pose_{:04d}.png', camera_pose_idx)"
ORACLE["question_images"] = f"SELECT q_row, CASE WHEN camera_pose_idx >= 0 AND {_PATH} IN (SELECT image_path FROM rendered_images WHERE image_path IS NOT NULL) THEN 'images/' || {_FILE} ELSE image END AS image FROM questions"
ORACLE["sanitize_names"] = f"SELECT scene_id, label_ord, {_SANE('label')} AS name FROM scene_labels WHERE label IS NOT NULL"
ORACLE["json_props_extract"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"

# -- records (p1, p3) --------------------------------------------------------------------------------------------------

_WS = "[\\s\\x{00a0}\\x{1680}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"


def squeeze(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def scene_key(c: str) -> str:
    pair = "(\\d+)\\D+(\\d{6})(?:\\D|$)"
    return f"""CASE WHEN {c} IS NULL OR regexp_full_match({c}, '\\d{{4}}_\\d{{6}}') THEN {c} WHEN regexp_extract({c}, '{pair}', 2) <> '' THEN lpad(regexp_extract({c}, '{pair}', 1), 4, '0') || '_' || regexp_extract({c}, '{pair}', 2) ELSE {squeeze(c)} END"""


def id_key(c: str) -> str:
    return f"trim(regexp_replace(lower(regexp_replace({c}, '[\\x{{00ad}}\\x{{200b}}-\\x{{200f}}\\x{{2060}}\\x{{feff}}]', '', 'g')), '[^\\p{{L}}\\p{{N}}]+', '_', 'g'), '_')"


def record_key(row: str = "") -> str:
    return f"({scene_key(row + 'scene_id')} || '|' || {id_key(row + 'pattern_name')} || '|' || {row}camera_pose_idx || '|' || {id_key(row + 'question_id')})"


def path_key(c: str) -> str:
    """Resolved by rewriting: decoded, slashes turned and squeezed, dots and parents removed."""
    text = squeeze(f"replace(url_decode({c}), '\\', '/')")
    for pattern, to in (("/+", "/"), ("^/", ""), ("/(\\./)+", "/"), ("^(\\./)+", ""), ("[^/]+/\\.\\./", ""), ("[^/]+/\\.\\./", "")):
        text = f"regexp_replace({text}, '{pattern}', '{to}', 'g')"
    return f"NULLIF({text}, '')"


_HAS = " OR ".join(f"o.{c} IS NOT NULL" for c in ("id", "label", "center", "dims", "aabb_min", "aabb_max", "room_index", "volume"))
ORACLE["p1_found"] = f"""WITH q AS (SELECT q_row, objects, camera_pose.target_objects AS targets, [trim(o.id) FOR o IN objects] AS ids, [lower(trim(o.label)) FOR o IN objects] AS labels FROM questions),
 o AS (SELECT q_row, ids, unnest(range(0, len(objects))) AS pos, unnest(objects) AS o FROM q), t AS (SELECT q_row, labels, unnest(range(0, len(targets))) AS pos, unnest(targets) AS t FROM q)
 SELECT q_row, 'object' AS child_kind, CAST(pos AS INTEGER) AS child_pos, CAST(CASE WHEN o.id IS NULL THEN pos ELSE list_position(ids, trim(o.id)) - 1 END AS INTEGER) AS link_pos FROM o WHERE {_HAS}
 UNION ALL SELECT q_row, 'target', CAST(pos AS INTEGER), CAST(COALESCE(NULLIF(list_position(labels, lower(trim(t))), 0), 0) - 1 AS INTEGER) FROM t WHERE t IS NOT NULL AND trim(t) <> ''"""
_XYZ = lambda c, n: ", ".join(f"{c}[{i + 1}] AS {n}_{a}" for i, a in enumerate("xyz"))
_PLAIN = "question, answer, answer_type, question_type, question_id, primary_object, scene_id, pattern_name, camera_pose_idx, answer_text, answer_value, mc_source_type, room, camera_yaw, image, image_path, batch_no"
ORACLE["p1_records"] = f"SELECT q_row, {_PLAIN}, epoch_us(created_at) AS created_us, epoch_us(ingested_at) AS ingested_us FROM questions"
ORACLE["p1_poses"] = f"SELECT q_row, camera_pose.yaw AS camera_pose_yaw, camera_pose.pitch AS camera_pose_pitch, camera_pose.radius AS camera_pose_radius, {_XYZ('camera_pose.position', 'position')}, {_XYZ('camera_pose.target', 'target')} FROM questions"
ORACLE["p1_objects"] = f"""WITH o AS (SELECT q_row, unnest(range(0, len(objects))) AS pos, unnest(objects) AS o FROM questions)
 SELECT q_row, CAST(pos AS INTEGER) AS objects_pos, ({_HAS}) AS present, o.id AS id, o.label AS label, o.room_index AS room_index, o.volume AS volume, {', '.join(_XYZ(f'o.{v}', v) for v in ('center', 'dims', 'aabb_min', 'aabb_max'))} FROM o"""
ORACLE["p1_target_links"] = f"SELECT q_row, child_pos AS camera_pose_target_objects_pos, link_pos AS objects_pos FROM ({ORACLE['p1_found']}) WHERE child_kind = 'target'"
ORACLE["p1_choices"] = """WITH c AS (SELECT q_row, unnest(range(0, len(map_entries(choices)))) AS pos, unnest(map_entries(choices)) AS e FROM questions)
 SELECT q_row, CAST(pos AS INTEGER) AS choices_pos, e.key IS NOT NULL OR e.value IS NOT NULL AS present, e.key AS key, e.value AS value FROM c"""
ORACLE["p1_pose_targets"] = """WITH t AS (SELECT q_row, unnest(range(0, len(camera_pose.target_objects))) AS pos, unnest(camera_pose.target_objects) AS v FROM questions)
 SELECT q_row, CAST(pos AS INTEGER) AS camera_pose_target_objects_pos, v IS NOT NULL AS present, v AS value FROM t"""
_REFS = f"""refs AS (SELECT q_row, 'image_path' AS ref_field, {path_key('image_path')} AS k, ingested_at AS t FROM questions UNION ALL
 SELECT q_row, 'camera_pose_idx', {scene_key('scene_id')} || '|' || pattern_name || '|' || camera_pose_idx, ingested_at FROM questions),
 parents AS (SELECT 'image_path' AS ref_field, {path_key('image_path')} AS k, arrived_at, removed_at FROM rendered_images UNION ALL SELECT 'camera_pose_idx', {scene_key('scene_id')} || '|' || pattern_name || '|' || pose_idx, arrived_at, removed_at FROM camera_poses),
 state AS (SELECT r.q_row, r.ref_field, r.t, count(p.k) AS n, COALESCE(bool_or(p.arrived_at <= r.t AND (p.removed_at IS NULL OR p.removed_at > r.t)), false) AS there, COALESCE(bool_or(p.arrived_at <= r.t), false) AS come
 FROM refs r LEFT JOIN parents p ON p.ref_field = r.ref_field AND p.k = r.k WHERE r.k IS NOT NULL GROUP BY 1, 2, 3),
 orphans AS (SELECT q_row, ref_field, t, CASE WHEN n = 0 THEN 'missing' WHEN come THEN 'deleted' ELSE 'late' END AS reason FROM state WHERE NOT there)"""
ORACLE["p3_found"] = f"WITH {_REFS} SELECT q_row, ref_field, reason FROM orphans"
ORACLE["p3_orphans_by_month"] = f"WITH {_REFS} SELECT ref_field, strftime(t, '%Y-%m') AS month, reason, count(*) AS orphans FROM orphans GROUP BY 1, 2, 3"
ORACLE["p6_broken"] = r"""WITH l AS (SELECT file_id, unnest(string_split(ltrim(body, chr(65279)), chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS line_no FROM small_files),
 t AS (SELECT file_id, line_no, rtrim(line, chr(13)) AS line FROM l WHERE regexp_matches(line, '\S')) SELECT file_id, CAST(line_no AS INTEGER) AS line_no FROM t WHERE NOT COALESCE(json_type(CASE WHEN json_valid(line) THEN line END) = 'OBJECT', FALSE)"""
