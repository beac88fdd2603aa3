"""The 64-slot grid: slots, label sets, bars, similarity, entropy, syncopation and classes (name -> query text)."""

from __future__ import annotations

#: Metrical weights of the 16 steps of a bar.
_WEIGHTS = "(VALUES (0, 4), (1, 1), (2, 2), (3, 1), (4, 3), (5, 1), (6, 2), (7, 1), (8, 4), (9, 1), (10, 2), (11, 1), (12, 3), (13, 1), (14, 2), (15, 1))"
_B = "CASE WHEN {} > 0 THEN 1.0 ELSE 0.0 END"
_KICK, _SNARE, _HAT = (_B.format(c) for c in ("kick", "snare", "hat"))

QUERIES: dict[str, str] = {
    "beat_grid": """
WITH $tr, g AS (RANGE(64, slot))
SELECT track_id, slot, slot /~ 16 AS bar, slot % 16 AS step, (slot % 16) /~ 4 AS beat_in_bar, slot % 4 AS sub_in_beat, R(60.0 / bpm / 4 * slot) AS time, R(60000.0 / bpm / 4 * slot) AS time_ms FROM tr CROSS JOIN g""",
    "slot_roles": """
WITH $sl SELECT track_id, slot, step = 0 AS is_downbeat, step % 4 = 0 AS is_beat, step % 4 = 2 AS is_offbeat, step % 2 = 1 AS is_odd FROM sl""",
    "barstep_lookup": """
WITH $ev, $sl, q AS (SELECT event_id, track_id, event_id % 4 AS bar, (event_id /~ 4) % 16 AS step FROM ev) SELECT q.event_id, q.track_id, sl.slot FROM q JOIN sl ON q.track_id = sl.track_id AND q.bar = sl.bar AND q.step = sl.step""",
    "slot_confidence_metrics": """
WITH $ev, $sl, c AS (SELECT track_id, CAST(least(floor(t / 11.25), 63) AS BIGINT) AS slot, sum(v) AS v FROM ev WHERE stem = 'click' GROUP BY track_id, CAST(least(floor(t / 11.25), 63) AS BIGINT)),
k AS (SELECT sl.track_id, sl.slot, sl.step, coalesce(c.v, 0.0) / (max(coalesce(c.v, 0.0)) OVER (PARTITION BY sl.track_id) + 1e-9) AS conf FROM sl LEFT JOIN c ON sl.track_id = c.track_id AND sl.slot = c.slot)
SELECT track_id, R(avg(conf)) AS density_w, R(avg(conf) FILTER (WHERE step = 0) / (avg(conf) + 1e-9)) AS downbeat_emphasis, R(avg(conf) FILTER (WHERE slot % 2 = 1) / (avg(conf) FILTER (WHERE slot % 2 = 0) + 1e-9)) AS swing_ratio, R(-sum(conf * ln(conf + 1e-12))) AS entropy, count_if(conf >= 0.2) AS active FROM k GROUP BY track_id""",
    "rhythm_histogram": "WITH $sf SELECT track_id, slot /~ 4 AS beat, R(avg(n)) AS mean_labels, CAST(sum(kick) AS BIGINT) AS kicks FROM sf GROUP BY track_id, slot /~ 4",
    "slot_label_default": "WITH $ev, $st, $sl SELECT sl.track_id, sl.slot, coalesce(nullif(array_join(array_sort(collect_set(st.label)), '|'), ''), 'none') AS labels FROM sl LEFT JOIN st ON sl.track_id = st.track_id AND sl.slot = st.slot GROUP BY sl.track_id, sl.slot",
    "label_density": "WITH $st SELECT track_id, label, count(*) AS n, R(count(*) / 64.0) AS density FROM st GROUP BY track_id, label",
    "label_diversity": "WITH $st, s AS (SELECT track_id, slot, count(*) AS n FROM st GROUP BY track_id, slot) SELECT track_id, count(*) AS active_slots, R(count(*) / 64.0) AS density, R(sum(n) / 64.0) AS avg_labels_per_step FROM s GROUP BY track_id",
    "dominant_label": "WITH $st, c AS (SELECT track_id, label, count(*) AS n, min(slot) AS first_slot FROM st GROUP BY track_id, label), r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY n DESC, first_slot, label) AS rk FROM c) SELECT track_id, label, n FROM r WHERE rk = 1",
    "kick_snare_ratio": "WITH $st SELECT track_id, CASE WHEN count_if(label = 'kick') = 0 AND count_if(label = 'snare') = 0 THEN 0.0 WHEN count_if(label = 'snare') = 0 THEN NULL ELSE R(count_if(label = 'kick') / CAST(count_if(label = 'snare') AS DOUBLE)) END AS ratio FROM st GROUP BY track_id",
    "label_entropy": "WITH $st, c AS (SELECT track_id, label, count(*) AS c FROM st GROUP BY track_id, label), p AS (SELECT track_id, c / CAST(sum(c) OVER (PARTITION BY track_id) AS DOUBLE) AS p FROM c) SELECT track_id, R(-sum(p * ln(p) / ln(2.0))) AS entropy FROM p GROUP BY track_id",
    "per_bar_activity": f"WITH $sf SELECT track_id, bar, count_if(n > 0) AS active_steps, R(count_if(n > 0) / 16.0) AS density, R(avg({_KICK})) AS kick_density, R(avg({_SNARE})) AS snare_density FROM sf GROUP BY track_id, bar",
    "bar_density_spread": "WITH $sf, b AS (SELECT track_id, bar, count_if(n > 0) / 16.0 AS d FROM sf GROUP BY track_id, bar) SELECT track_id, R(var_pop(d)) AS bar_density_var, R(max(d) - min(d)) AS bar_density_range FROM b GROUP BY track_id",
    "bar_similarity_mean": """
WITH $sf, x AS (SELECT a.track_id, a.slot AS sa, b.slot AS sb, count(*) AS k FROM st a JOIN st b ON a.track_id = b.track_id AND a.label = b.label AND a.slot % 16 = b.slot % 16 GROUP BY a.track_id, a.slot, b.slot),
m AS (SELECT a.track_id, a.bar AS bar_a, b.bar AS bar_b, avg(CASE WHEN a.n + b.n = 0 THEN 1.0 ELSE coalesce(x.k, 0) / CAST(a.n + b.n - coalesce(x.k, 0) AS DOUBLE) END) AS similarity
FROM sf a JOIN sf b ON a.track_id = b.track_id AND a.step = b.step AND a.bar <> b.bar LEFT JOIN x ON x.track_id = a.track_id AND x.sa = a.slot AND x.sb = b.slot GROUP BY a.track_id, a.bar, b.bar)
SELECT track_id, R(avg(similarity)) AS mean_similarity FROM m GROUP BY track_id""",
    "bar_similarity_matrix": """
WITH $sf, x AS (SELECT a.track_id, a.slot AS sa, b.slot AS sb, count(*) AS k FROM st a JOIN st b ON a.track_id = b.track_id AND a.label = b.label AND a.slot % 16 = b.slot % 16 GROUP BY a.track_id, a.slot, b.slot)
SELECT a.track_id, a.bar AS bar_a, b.bar AS bar_b, R(avg(CASE WHEN a.n + b.n = 0 THEN 1.0 ELSE coalesce(x.k, 0) / CAST(a.n + b.n - coalesce(x.k, 0) AS DOUBLE) END)) AS similarity
FROM sf a JOIN sf b ON a.track_id = b.track_id AND a.step = b.step LEFT JOIN x ON x.track_id = a.track_id AND x.sa = a.slot AND x.sb = b.slot GROUP BY a.track_id, a.bar, b.bar""",
    "repetition": """
WITH $sf, x AS (SELECT a.track_id, a.slot AS sa, b.slot AS sb, count(*) AS k FROM st a JOIN st b ON a.track_id = b.track_id AND a.label = b.label AND a.slot % 16 = b.slot GROUP BY a.track_id, a.slot, b.slot)
SELECT a.track_id, R(avg(CASE WHEN a.n + b.n = 0 THEN 1.0 ELSE coalesce(x.k, 0) / CAST(a.n + b.n - coalesce(x.k, 0) AS DOUBLE) END)) AS repetition
FROM sf a JOIN sf b ON a.track_id = b.track_id AND a.step = b.step AND b.bar = 0 AND a.bar > 0 LEFT JOIN x ON x.track_id = a.track_id AND x.sa = a.slot AND x.sb = b.slot GROUP BY a.track_id""",
    "ngram4_ratio": """
WITH $mx, w AS (SELECT track_id, stem AS a, lead(stem, 1) OVER (PARTITION BY track_id ORDER BY i) AS b, lead(stem, 2) OVER (PARTITION BY track_id ORDER BY i) AS c, lead(stem, 3) OVER (PARTITION BY track_id ORDER BY i) AS d FROM mx)
SELECT track_id, count(*) AS ngrams, R(count(DISTINCT concat_ws('|', a, b, c, d)) / CAST(count(*) AS DOUBLE)) AS unique_ratio FROM w WHERE d IS NOT NULL GROUP BY track_id""",
    "binary_ngram4_ratio": """
WITH $sf, a AS (SELECT track_id, slot, CASE WHEN n > 0 THEN '1' ELSE '0' END AS x FROM sf), w AS (SELECT track_id, x, lead(x, 1) OVER (PARTITION BY track_id ORDER BY slot) AS b, lead(x, 2) OVER (PARTITION BY track_id ORDER BY slot) AS c, lead(x, 3) OVER (PARTITION BY track_id ORDER BY slot) AS d FROM a)
SELECT track_id, R(count(DISTINCT concat(x, b, c, d)) / CAST(count(*) AS DOUBLE)) AS unique_ratio FROM w WHERE d IS NOT NULL GROUP BY track_id""",
    "pattern_entropy": "WITH $ev, $st, $sl, k AS (SELECT sl.track_id, sl.slot, coalesce(nullif(array_join(array_sort(collect_set(st.label)), '|'), ''), '_') AS token FROM sl LEFT JOIN st ON sl.track_id = st.track_id AND sl.slot = st.slot GROUP BY sl.track_id, sl.slot), c AS (SELECT track_id, token, count(*) / 64.0 AS p FROM k GROUP BY track_id, token) SELECT track_id, count(*) AS tokens, R(-sum(p * ln(p) / ln(2.0))) AS entropy FROM c GROUP BY track_id",
    "meter_confidence": """
WITH $sf, p AS (SELECT * FROM (VALUES (4)) AS p(period)), a AS (SELECT track_id, step, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END AS x FROM sf WHERE bar = 0), s AS (SELECT a.track_id, p.period, sum(a.x * b.x) / greatest(1.0, sum(a.x * a.x)) AS score FROM a CROSS JOIN p JOIN a b ON a.track_id = b.track_id AND b.step = (a.step + p.period) % 16 GROUP BY a.track_id, p.period)
SELECT track_id, R(score) AS score_44, R(exp(score) / (exp(score) + exp(0.0))) AS meter_44_conf, R(exp(0.0) / (exp(score) + exp(0.0))) AS meter_68_conf FROM s""",
    "four_on_floor": f"WITH $sf, b AS (SELECT track_id, bar, avg({_KICK}) FILTER (WHERE step % 4 = 0) AS r FROM sf GROUP BY track_id, bar) SELECT track_id, R(avg(r)) AS kick_quarter_ratio, avg(r) >= 0.8 AS four_on_floor, bool_and(r = 1.0) AS every_quarter FROM b GROUP BY track_id",
    "backbeat_strength": f"""
WITH $sf SELECT track_id, R(CASE WHEN avg({_SNARE}) FILTER (WHERE step % 4 = 0) > 0 THEN avg({_SNARE}) FILTER (WHERE step IN (4, 12)) / avg({_SNARE}) FILTER (WHERE step % 4 = 0) ELSE 0.0 END) AS relative_backbeat, R(avg({_SNARE}) FILTER (WHERE step IN (4, 12))) AS backbeat,
  R(avg(CASE WHEN kick + snare > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE step = 0)) AS downbeat_strength, R(avg(CASE WHEN kick + snare + hat > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE step = 0)) AS downbeat_any FROM sf GROUP BY track_id""",
    "hat_offbeat_ratio": f"WITH $sf SELECT track_id, R(avg({_HAT}) FILTER (WHERE step % 4 = 2)) AS presence, R(sum({_HAT}) FILTER (WHERE step % 4 = 2) / nullif(sum({_HAT}) FILTER (WHERE step % 4 IN (0, 2)), 0)) AS share FROM sf GROUP BY track_id",
    "fill_rate": """
WITH $sf, b AS (SELECT track_id, bar, avg(n) AS m, avg(n) FILTER (WHERE step >= 14) AS tail, count_if(n > 0) / 16.0 AS d FROM sf GROUP BY track_id, bar)
SELECT track_id, R(avg(CASE WHEN tail > 1.5 * m THEN 1.0 ELSE 0.0 END)) AS fill_rate, R(greatest(0.0, least(1.0, max(d) FILTER (WHERE bar = 3) - avg(d) FILTER (WHERE bar < 3)))) AS last_bar_lift FROM b GROUP BY track_id""",
    "kick_ioi_cv": """
WITH $ev, d AS (SELECT track_id, t - lag(t) OVER (PARTITION BY track_id ORDER BY us, event_id) AS ioi FROM ev WHERE stem = 'click')
SELECT track_id, R(greatest(0.0, least(1.0, 1 - stddev_pop(ioi) / nullif(avg(ioi), 0)))) AS tempo_stability, count(ioi) AS intervals FROM d GROUP BY track_id""",
    "syncopation": f"""
WITH $sf, w AS (SELECT step, (weight - 1) / 3.0 AS w FROM {_WEIGHTS} AS w(step, weight)), b AS (SELECT sf.track_id, sf.bar, sum((1 - w.w) * CASE WHEN sf.kick + sf.snare > 0 THEN 1.0 ELSE 0.0 END) / 16.0 + count_if(sf.step % 4 = 0 AND sf.kick + sf.snare = 0) / 4.0 AS s FROM sf JOIN w ON sf.step = w.step GROUP BY sf.track_id, sf.bar)
SELECT track_id, R(avg(least(1.0, s / 2))) AS syncopation FROM b GROUP BY track_id""",
    "triplet_remap": """
WITH $st, r AS (SELECT DISTINCT track_id, slot /~ 16 AS bar, least(CAST(floor((slot % 16) * 0.75 + 0.5) - CASE WHEN floor((slot % 16) * 0.75 + 0.5) = (slot % 16) * 0.75 + 0.5 AND CAST(floor((slot % 16) * 0.75 + 0.5) AS BIGINT) % 2 = 1 THEN 1 ELSE 0 END AS BIGINT), 11) AS step12, label FROM st)
SELECT track_id, count(*) AS labels, R(count_if(label = 'hihat' AND step12 % 3 <> 0) / nullif(CAST(count_if(label = 'hihat') AS DOUBLE), 0)) AS triplet_hat_ratio FROM r GROUP BY track_id""",
    "kick_pattern_class": """
WITH $sf, b AS (SELECT track_id, count_if(step % 4 = 0 AND kick > 0) AS q, count_if(kick > 0) AS kicks, max(CASE WHEN step = 8 THEN snare ELSE 0 END) AS mid, max(CASE WHEN step = 0 THEN kick ELSE 0 END) AS one, count_if(step IN (4, 12) AND snare > 0) / 2.0 AS back FROM sf WHERE bar = 0 GROUP BY track_id)
SELECT track_id, CASE WHEN q = 4 THEN 'four_on_floor' WHEN kicks <= 2 AND mid > 0 THEN 'two_step' WHEN one > 0 AND back >= 0.8 THEN 'backbeat_pop' ELSE 'syncopated_break' END AS kick_pattern_class FROM b""",
    "swing_normalise": """
WITH $tr, x AS (SELECT track_id, CASE WHEN track_id % 2 = 0 THEN (track_id % 15) / 10.0 ELSE (track_id % 100) * 1.0 END AS swing FROM tr)
SELECT track_id, R(greatest(0.0, least(1.0, CASE WHEN swing <= 1.5 THEN swing ELSE swing / 100 END))) AS swing_ratio_norm, (CASE WHEN swing <= 1.5 THEN swing ELSE swing / 100 END) >= 0.6 AS uses_triplets FROM x""",
}
ORACLE = {n: q.replace("array_join(array_sort(collect_set(st.label)), '|')", "string_agg(DISTINCT st.label, '|' ORDER BY st.label)") for n, q in QUERIES.items() if "collect_set" in q}
