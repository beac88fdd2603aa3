"""Tolerance, nearest and positional joins, candidate scoring and top-k (name -> query text).

Tolerance joins meet on a bucket of time as wide as the tolerance; the right side stands in its own bucket and in both
neighbours, so the join stays an equi-join whatever the number of events of a track.
"""

from __future__ import annotations

_HOUR = 3600000000


def _near(stem: str, width: int) -> str:
    return f"d AS (RANGE(3, o)), k AS (SELECT track_id, us, event_id, us /~ {width} + o - 1 AS b FROM ev CROSS JOIN d WHERE stem = '{stem}')"


#: Loop candidates: peaks (o), those of enough energy (c), the pattern of 64 slots from each (p) with its spacing (g), and how many later
#: loops begin at a candidate near the expected time whose pattern differs in at most ten slots (n).  A loop is 45 hours.
_LOOP = """$mx, o AS (SELECT track_id, i, t, v FROM (SELECT *, max(v) OVER (PARTITION BY track_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near_, max(v) OVER (PARTITION BY track_id) AS top FROM mx) WHERE v = near_ AND v > 0.05 * top),
e AS (SELECT *, avg(v) OVER (PARTITION BY track_id) AS mu, max(t) OVER (PARTITION BY track_id) AS last_o FROM o), c AS (SELECT *, max(v) OVER (PARTITION BY track_id) AS top_c, max(t) OVER (PARTITION BY track_id) AS last_c FROM e WHERE v >= 0.7 * mu),
ob AS (SELECT track_id, t, CAST(floor(t / 45.0) AS BIGINT) AS bk FROM o), cb AS (SELECT track_id, i, t, bk FROM (SELECT track_id, i, t, CAST(floor(t / 45.0) AS BIGINT) AS bk FROM c UNION ALL SELECT track_id, i, t, CAST(floor(t / 45.0) AS BIGINT) + 1 AS bk FROM c UNION ALL SELECT track_id, i, t, CAST(floor(t / 45.0) AS BIGINT) - 1 AS bk FROM c)),
p AS (SELECT DISTINCT track_id, i, slot FROM (SELECT cb.track_id, cb.i, CAST(floor((ob.t - cb.t) / 0.703125 + 0.5) AS BIGINT) AS slot, ob.t - cb.t AS d FROM cb JOIN ob ON cb.track_id = ob.track_id AND cb.bk = ob.bk) WHERE slot BETWEEN 0 AND 63 AND abs(d - slot * 0.703125) <= 0.25),
pd AS (SELECT *, slot - lag(slot) OVER (PARTITION BY track_id, i ORDER BY slot) AS gap FROM p), g AS (SELECT track_id, i, count(*) AS hits, stddev_pop(gap) AS spread, max(CASE WHEN slot = 0 THEN 1 ELSE 0 END) AS first_slot FROM pd GROUP BY track_id, i),
x AS (SELECT c.track_id, c.i, k.k, c.t + k.k * 45.0 AS want FROM c CROSS JOIN (SELECT k + 1 AS k FROM (RANGE(64, k))) k WHERE c.t + k.k * 45.0 <= c.last_o),
tb AS (SELECT track_id, i, t, CAST(floor(t) AS BIGINT) AS h FROM c UNION ALL SELECT track_id, i, t, CAST(floor(t) AS BIGINT) + 1 AS h FROM c UNION ALL SELECT track_id, i, t, CAST(floor(t) AS BIGINT) - 1 AS h FROM c),
m AS (SELECT track_id, i, k, j FROM (SELECT x.track_id, x.i, x.k, tb.i AS j, row_number() OVER (PARTITION BY x.track_id, x.i, x.k ORDER BY abs(tb.t - x.want), tb.i) AS rk FROM x JOIN tb ON x.track_id = tb.track_id AND CAST(floor(x.want) AS BIGINT) = tb.h WHERE abs(tb.t - x.want) <= 0.5) WHERE rk = 1),
q AS (SELECT m.track_id, m.i, m.k, m.j, count(*) AS common_ FROM m JOIN p a ON a.track_id = m.track_id AND a.i = m.i JOIN p b ON b.track_id = m.track_id AND b.i = m.j AND b.slot = a.slot GROUP BY m.track_id, m.i, m.k, m.j),
n AS (SELECT m.track_id, m.i, count(*) AS anchors FROM m JOIN g a ON a.track_id = m.track_id AND a.i = m.i JOIN g b ON b.track_id = m.track_id AND b.i = m.j LEFT JOIN q ON q.track_id = m.track_id AND q.i = m.i AND q.k = m.k AND q.j = m.j WHERE a.hits + b.hits - 2 * coalesce(q.common_, 0) <= 10 GROUP BY m.track_id, m.i)"""

_RHYTHM = """
WITH $fr, k AS (SELECT track_id, t, v FROM fr WHERE stem = 'view'), a AS (SELECT track_id, min(t) AS t0 FROM k WHERE v >= 30 GROUP BY track_id), g AS (RANGE(8, b)), x AS (SELECT DISTINCT track_id FROM fr),
h AS (SELECT a.track_id, count(*) AS pairs FROM a CROSS JOIN g JOIN k ON a.track_id = k.track_id AND abs(k.t - (a.t0 + g.b * 45.0)) <= 12.0 AND k.v >= 30 GROUP BY a.track_id)
SELECT x.track_id, coalesce(h.pairs, 0) AS pairs, CASE WHEN h.pairs >= 6 THEN '4x4' ELSE 'broken' END AS rhythm_type FROM x LEFT JOIN h ON x.track_id = h.track_id"""

QUERIES: dict[str, str] = {
    "band_join_pairs": f"""
WITH $ev, {_near("view", _HOUR)}
SELECT a.event_id AS left_id, k.event_id AS right_id, a.track_id, R((k.us - a.us) / 3.6e9) AS dt FROM ev a JOIN k ON a.track_id = k.track_id AND a.us /~ {_HOUR} = k.b AND abs(k.us - a.us) <= {_HOUR} WHERE a.stem = 'click'""",
    "nearest_onset": """
WITH $ev, b AS (SELECT * FROM ev WHERE stem = 'click'), u AS (SELECT track_id, us, event_id, 0 AS side FROM ev WHERE stem = 'view' UNION ALL SELECT track_id, us, event_id, 1 AS side FROM b),
w AS (SELECT *, max(CASE WHEN side = 0 THEN us END) OVER (PARTITION BY track_id ORDER BY us, side ROWS UNBOUNDED PRECEDING) AS lo, min(CASE WHEN side = 0 THEN us END) OVER (PARTITION BY track_id ORDER BY us DESC, side ROWS UNBOUNDED PRECEDING) AS hi FROM u)
SELECT event_id, track_id, least(coalesce(us - lo, hi - us), coalesce(hi - us, us - lo)) AS nearest_us FROM w WHERE side = 1""",
    "asof_previous": """
WITH $ev, w AS (SELECT *, max(CASE WHEN stem = 'view' THEN us END) OVER (PARTITION BY track_id ORDER BY us, CASE WHEN stem = 'view' THEN 0 ELSE 1 END ROWS UNBOUNDED PRECEDING) AS lo FROM ev)
SELECT event_id, track_id, us - lo AS since_us FROM w WHERE stem = 'click'""",
    "snap_to_peak": """
WITH $mx, x AS (SELECT track_id, (min(t) + max(t)) / 2 AS target FROM mx GROUP BY track_id), n AS (SELECT m.track_id, m.i, m.t, m.v, x.target FROM mx m JOIN x ON m.track_id = x.track_id WHERE abs(m.t - x.target) <= 48.0),
p AS (SELECT *, lag(v) OVER (PARTITION BY track_id ORDER BY i) AS a, lead(v) OVER (PARTITION BY track_id ORDER BY i) AS b FROM n), s AS (SELECT track_id, min_by(t, abs(t - target)) AS t FROM p WHERE v > a AND v > b GROUP BY track_id)
SELECT x.track_id, R(x.target) AS target, R(coalesce(s.t, x.target)) AS snapped FROM x LEFT JOIN s ON x.track_id = s.track_id""",
    "rhythm_stem_select": """
WITH $fr, o AS (SELECT * FROM (VALUES ('purchase', 1), ('click', 2), ('view', 3), ('signup', 4), ('error', 5)) AS o(stem, prio)),
w AS (SELECT *, lag(v) OVER (PARTITION BY track_id, stem ORDER BY i) AS p, lead(v) OVER (PARTITION BY track_id, stem ORDER BY i) AS q FROM fr),
s AS (SELECT w.track_id, w.stem, avg(v) AS mean_v, coalesce(sum(v) FILTER (WHERE v > p AND v > q AND CAST(floor(t) AS BIGINT) % 24 BETWEEN 8 AND 20), 0) AS score FROM w GROUP BY w.track_id, w.stem),
r AS (SELECT s.track_id, s.stem, o.prio, row_number() OVER (PARTITION BY s.track_id ORDER BY round(s.score, 4) DESC, o.prio) AS rk FROM s JOIN o ON s.stem = o.stem WHERE s.mean_v >= 45.0), k AS (SELECT DISTINCT track_id FROM s)
SELECT k.track_id, min_by(r.stem, r.prio) AS first_eligible, min_by(r.stem, r.rk) AS best_scored FROM k LEFT JOIN r ON k.track_id = r.track_id GROUP BY k.track_id""",
    "onset_alignment_ratio": f"""
WITH $ev, {_near("view", _HOUR)}, h AS (SELECT DISTINCT a.event_id FROM ev a JOIN k ON a.track_id = k.track_id AND a.us /~ {_HOUR} = k.b AND abs(k.us - a.us) <= {_HOUR} WHERE a.stem = 'error')
SELECT a.track_id, count(*) AS onsets, count(h.event_id) AS aligned, R(count(h.event_id) / CAST(count(*) AS DOUBLE)) AS ratio FROM ev a LEFT JOIN h ON a.event_id = h.event_id WHERE a.stem = 'error' GROUP BY a.track_id""",
    "bass_kick_sync": """
WITH $ev, u AS (SELECT track_id, us, CASE WHEN stem = 'view' THEN 0 ELSE 1 END AS side FROM ev WHERE stem IN ('view', 'click')),
w AS (SELECT *, max(CASE WHEN side = 0 THEN us END) OVER (PARTITION BY track_id ORDER BY us, side ROWS UNBOUNDED PRECEDING) AS lo, min(CASE WHEN side = 0 THEN us END) OVER (PARTITION BY track_id ORDER BY us DESC, side ROWS UNBOUNDED PRECEDING) AS hi FROM u),
d AS (SELECT track_id, least(coalesce(us - lo, hi - us), coalesce(hi - us, us - lo)) / 3.6e9 AS d FROM w WHERE side = 1)
SELECT track_id, R(avg(d)) AS syncopation_distance, R(avg(CASE WHEN d <= 4.0 THEN 1.0 ELSE 0.0 END)) AS on_kick_ratio FROM d WHERE d IS NOT NULL GROUP BY track_id""",
    "bass_quantization": """
WITH $ev, g AS (SELECT track_id, t, 11.25 / 4 AS iv FROM ev WHERE stem = 'click')
SELECT track_id, R(1 - avg(abs(t - least(floor(t / iv + 0.5), 255) * iv) / (iv / 2))) AS quantization, count(*) AS onsets FROM g GROUP BY track_id""",
    "onset_density": """
WITH $ev, d AS (SELECT track_id, t, t - lag(t) OVER (PARTITION BY track_id ORDER BY us, event_id) AS ioi FROM ev WHERE stem = 'click')
SELECT track_id, R(count(*) / nullif(max(t) - min(t), 0)) AS density, R(var_pop(ioi)) AS ioi_variance FROM d GROUP BY track_id""",
    "slot_pattern64": """
WITH $ev, $sl, d AS (RANGE(3, o)), k AS (SELECT track_id, t, CAST(floor(t / 11.25) AS BIGINT) + o - 1 AS slot FROM ev CROSS JOIN d WHERE stem = 'click')
SELECT sl.track_id, sl.slot, CAST(max(CASE WHEN abs(k.t - sl.slot * 11.25) <= 2.0 THEN 1 ELSE 0 END) AS BIGINT) AS hit FROM sl LEFT JOIN k ON sl.track_id = k.track_id AND sl.slot = k.slot GROUP BY sl.track_id, sl.slot""",
    "pattern_hamming": """
WITH $sf, p AS (SELECT a.track_id, a.bar AS bar_a, b.bar AS bar_b, abs(CASE WHEN a.kick > 0 THEN 1 ELSE 0 END - CASE WHEN b.kick > 0 THEN 1 ELSE 0 END) AS d FROM sf a JOIN sf b ON a.track_id = b.track_id AND a.step = b.step AND a.bar < b.bar)
SELECT track_id, bar_a, bar_b, CAST(sum(d) AS BIGINT) AS hamming FROM p GROUP BY track_id, bar_a, bar_b""",
    "fuzzy_anchor": f"WITH {_LOOP} SELECT c.track_id, c.i, coalesce(n.anchors, 0) AS anchors, coalesce(g.hits, 0) AS hits FROM c LEFT JOIN n ON c.track_id = n.track_id AND c.i = n.i LEFT JOIN g ON c.track_id = g.track_id AND c.i = g.i",
    "loop_candidate_score": f"""
WITH {_LOOP}, s AS (SELECT c.track_id, c.i, 0.4 * coalesce(n.anchors, 0) + 0.2 * (1 - CASE WHEN coalesce(g.hits, 0) > 1 THEN g.spread ELSE 10.0 END / 10.0) + 0.15 * c.v / nullif(c.top_c, 0) + 0.15 * coalesce(g.first_slot, 0) + 0.1 * (1 - c.t / nullif(c.last_c, 0)) AS score
 FROM c LEFT JOIN n ON c.track_id = n.track_id AND c.i = n.i LEFT JOIN g ON c.track_id = g.track_id AND c.i = g.i), r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY round(score, 9) DESC, i) AS rk FROM s)
SELECT track_id, i, CAST(rk AS BIGINT) AS rk, R(score) AS score FROM r WHERE rk <= 3""",
    "downbeat_candidates": f"""
WITH $mx, $fr, rt AS ({_RHYTHM}), e AS (SELECT track_id, i, t, (v - min(v) OVER (PARTITION BY track_id)) / (max(v) OVER (PARTITION BY track_id) - min(v) OVER (PARTITION BY track_id) + 1e-6) AS x FROM mx),
s AS (SELECT *, (coalesce(lag(x) OVER (PARTITION BY track_id ORDER BY i), x) + x + coalesce(lead(x) OVER (PARTITION BY track_id ORDER BY i), x)) / 3 AS y FROM e),
m AS (SELECT *, avg(y) OVER (PARTITION BY track_id) AS mu, lag(y) OVER (PARTITION BY track_id ORDER BY i) AS p, lead(y) OVER (PARTITION BY track_id ORDER BY i) AS q FROM s), o AS (RANGE(9, k)),
c AS (SELECT a.track_id, a.i, a.y, a.mu, count(*) AS n, count_if(o.k < 4 AND b.y < 0.5 * a.y) AS quiet, count_if(o.k > 4 AND b.y >= 0.9 * a.y) AS strong, count_if(o.k > 4 AND b.y >= 0.7 * a.y) AS firm
 FROM m a CROSS JOIN o JOIN m b ON a.track_id = b.track_id AND b.i = a.i + o.k - 4 WHERE a.y > a.p AND a.y > a.q AND a.y > 1.5 * a.mu GROUP BY a.track_id, a.i, a.y, a.mu),
k AS (SELECT c.*, rt.rhythm_type, 4 + CASE WHEN rt.rhythm_type = '4x4' THEN CASE WHEN strong >= 3 THEN 1 ELSE 0 END ELSE CASE WHEN firm >= 2 THEN 1 ELSE 0 END + CASE WHEN strong >= 1 THEN 1 ELSE 0 END END AS score FROM c JOIN rt ON c.track_id = rt.track_id WHERE n >= 5 AND quiet >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY score DESC, i) AS rk, min(CASE WHEN score >= 5 THEN i END) OVER (PARTITION BY track_id) AS early FROM k)
SELECT track_id, i, CAST(score AS BIGINT) AS score, CAST(rk AS BIGINT) AS rk, coalesce(early, -1) AS earliest_strong, rhythm_type, i = CASE WHEN rhythm_type = 'broken' AND early IS NOT NULL THEN early ELSE min(CASE WHEN rk = 1 THEN i END) OVER (PARTITION BY track_id) END AS downbeat FROM r""",
    "rhythm_type": _RHYTHM,
    "log_anti_join": "SELECT d.doc_id, d.source FROM @documents d LEFT ANTI JOIN @labels l ON d.doc_id = l.doc_id",
    "labelled_semi_join": "SELECT d.doc_id, d.lang FROM @documents d LEFT SEMI JOIN @labels l ON d.doc_id = l.doc_id AND l.toxic = 1",
    "frame_index_lookup": """
WITH $fr, o AS (SELECT track_id, CAST(floor(t / 56.25) AS BIGINT) AS i FROM fr WHERE stem = 'view')
SELECT o.track_id, count(*) AS lookups, count(fr.i) AS found, R(avg(CASE WHEN fr.v >= 30 THEN 1.0 ELSE 0.0 END)) AS loud_ratio FROM o LEFT JOIN fr ON o.track_id = fr.track_id AND fr.stem = 'click' AND fr.i = o.i GROUP BY o.track_id""",
    "positional_zip": """
WITH a AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, role FROM @conversations WHERE role = 'user'), b AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, length(text) AS answer_chars FROM @conversations WHERE role = 'assistant')
SELECT a.conv_id, CAST(a.n AS BIGINT) AS n, CAST(b.answer_chars AS BIGINT) AS answer_chars FROM a JOIN b ON a.conv_id = b.conv_id AND a.n = b.n""",
}
ORACLE = {
    "log_anti_join": "SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "labelled_semi_join": "SELECT d.doc_id, d.lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)",
}
