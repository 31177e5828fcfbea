"""SQL twins of the queries for training data that SQL can express."""

from __future__ import annotations

from roomweave.plans.sql import record_key, scene_key, squeeze

ORACLE: dict[str, str] = {}

_EDGES = f"""clean AS (SELECT {scene_key('scene_id')} AS s, CASE WHEN upper(scan_ref) LIKE '%SC%' AND length(regexp_replace(scan_ref, '\\D', '', 'g')) = 7 THEN 'SC' || regexp_replace(scan_ref, '\\D', '', 'g') END AS scan, {scene_key('made_from')} AS m FROM scene_sources),
 half AS (SELECT s AS a, scan AS b FROM clean WHERE scan IS NOT NULL AND s IS NOT NULL UNION SELECT s, m FROM clean WHERE m IS NOT NULL AND s IS NOT NULL), edges AS (SELECT a, b FROM half UNION SELECT b, a FROM half),
 reach(node, seen) AS (SELECT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a), roots AS (SELECT node, min(seen) AS root FROM reach GROUP BY 1)"""
_SCENES = f"q AS (SELECT q_row, scene_id, {scene_key('scene_id')} AS scene FROM questions)"
ORACLE["p2_found"] = f"WITH RECURSIVE {_EDGES}, {_SCENES} SELECT q_row, COALESCE(root, scene) AS group_scene FROM q LEFT JOIN roots ON node = scene WHERE scene_id IS NOT NULL AND scene_id <> COALESCE(root, scene)"


def category_key(c: str) -> str:
    plain = f"regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}.]+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g')"
    return f"CASE WHEN regexp_full_match({squeeze(c)}, '[-+]?[0-9]+([.][0-9]+)?') THEN {squeeze(c)} ELSE NULLIF({plain}, '') END"


_FIELDS = ("question_type", "answer_type", "answer")
_RECORDS = f"recs AS (SELECT COALESCE({record_key()}, '#' || q_row) AS record, min(q_row) AS q_row, {', '.join(f'min({category_key(f)}) AS {f}' for f in _FIELDS)} FROM questions GROUP BY 1)"
_LONG = "long AS (" + " UNION ALL ".join(f"SELECT record, q_row, '{f}' AS field_name, {f} AS key FROM recs WHERE {f} IS NOT NULL" for f in _FIELDS) + ")"
_QUOTAS = f"""counts AS (SELECT field_name, key, count(*) AS n FROM long GROUP BY 1, 2),
 asked AS (SELECT p.plan_id, p.field_name, p.category, {category_key('p.category')} AS key, COALESCE(p.min_rows, 0) AS low, p.target_share, p.sample_size, COALESCE(n, 0) AS available, CAST(round(p.target_share * 1000000000) AS HUGEINT) AS nano FROM sample_plans p LEFT JOIN counts c ON c.field_name = p.field_name AND c.key = {category_key('p.category')}),
 rates AS (SELECT plan_id, sample_size / 1e9 AS rate, '' AS scarce, sample_size AS times, 1000000000 AS of_ FROM asked UNION SELECT plan_id, available / nano, category, available, nano FROM asked WHERE available > 0 AND nano > 0),
 scale AS (SELECT plan_id, times, of_ FROM rates QUALIFY row_number() OVER (PARTITION BY plan_id ORDER BY rate, scarce) = 1),
 parts AS (SELECT a.*, of_, nano * times AS product, nano * times // of_ AS whole, nano * times % of_ AS rest FROM asked a JOIN scale USING (plan_id)),
 rounded AS (SELECT *, whole + CASE WHEN row_number() OVER (PARTITION BY plan_id ORDER BY rest DESC, category) <= (2 * sum(product) OVER (PARTITION BY plan_id) + of_) // (2 * of_) - sum(whole) OVER (PARTITION BY plan_id) THEN 1 ELSE 0 END AS rounded FROM parts),
 quotas AS (SELECT *, CAST(greatest(low, ceil(CAST(target_share AS DECIMAL(18, 9)) * sample_size)) AS BIGINT) AS needed, CAST(least(available, greatest(low, rounded)) AS BIGINT) AS quota FROM rounded)"""
ORACLE["p4_found"] = f"WITH {_RECORDS}, {_LONG}, {_QUOTAS} SELECT plan_id, category FROM quotas WHERE available < needed"
ORACLE["p4_report"] = f"WITH {_RECORDS}, {_LONG}, {_QUOTAS} SELECT plan_id, category, available, needed, quota, quota / sum(quota) OVER (PARTITION BY plan_id) AS share, available < needed AS exhausted FROM quotas"
ORACLE["p4_sample"] = f"""WITH {_RECORDS}, {_LONG}, {_QUOTAS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY field_name, key ORDER BY CAST('0x' || substr(md5('quota:' || record), 1, 15) AS BIGINT), record) AS rk FROM long)
 SELECT plan_id, category, q_row FROM ranked r JOIN quotas q ON q.field_name = r.field_name AND q.key = r.key WHERE r.rk <= q.quota"""
_NAMED = f"named AS (SELECT q_row, batch_no, {record_key()} AS record FROM questions)"
ORACLE["p5_found"] = f"WITH {_NAMED} SELECT a.q_row AS q_row_a, b.q_row AS q_row_b FROM named a JOIN named b ON a.record = b.record AND a.q_row < b.q_row"
ORACLE["p5_sample"] = f"""WITH {_NAMED}, r AS (SELECT q_row, COALESCE(batch_no, 0) AS epoch, COALESCE(record, '#' || q_row) AS record FROM named), l AS (SELECT record, min(epoch) AS first_epoch FROM r GROUP BY 1)
 SELECT q_row, first_epoch, 0.1::DOUBLE AS rate FROM r JOIN l USING (record) WHERE CAST('0x' || substr(md5('20240:0:' || record), 1, 13) AS BIGINT) / 4503599627370496::DOUBLE < 0.1"""
