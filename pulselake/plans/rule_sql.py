"""Rules, event logs, feature hub, scans, tags, documents and lookups (name -> query text)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R_
from .dialect import spark_text

_STEM = "CASE stem WHEN 'click' THEN 'drums' WHEN 'purchase' THEN 'bass' WHEN 'view' THEN 'other' WHEN 'error' THEN 'vocals' ELSE CASE WHEN event_id % 2 = 0 THEN 'guitar' ELSE 'piano' END END"
_OF = "PARTITION BY track_id, stem, win"
_FLAG_SQL = """CASE WHEN coalesce(max(pickup) FILTER (WHERE stem = 'vocals'), 0) > 0 THEN 1.0 ELSE 0.0 END AS pickup_like, CAST(max(valleys) FILTER (WHERE stem = 'vocals') AS DOUBLE) AS vocal_valley_count,
  CASE WHEN coalesce(max(slope) FILTER (WHERE stem = 'bass'), 0.0) < -0.001 AND coalesce(max(mean_energy) FILTER (WHERE stem = 'bass'), 0.0) < 0.02 THEN 1.0 ELSE 0.0 END AS highpass_like, CASE WHEN coalesce(max(offgrid) FILTER (WHERE stem = 'drums'), 0) >= 3 THEN 1.0 ELSE 0.0 END AS offgrid_like, min(lead_s) AS first_downbeat_s"""
#: Features of each track, stem and window: the frames before and from the snap point, the drum peak nearest to the middle of the
#: drums; energies on a scale of one.  A window holds up to 32 frames.
_FEATURES = f"""$ev, sm AS (SELECT track_id, {_STEM} AS stem, v / 1000 AS v, t, us, event_id FROM ev),
dr AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY us, event_id) AS i, count(*) OVER (PARTITION BY track_id) AS n, lag(v) OVER (PARTITION BY track_id ORDER BY us, event_id) AS p, lead(v) OVER (PARTITION BY track_id ORDER BY us, event_id) AS q FROM sm WHERE stem = 'drums'),
sp AS (SELECT track_id, us AS snap_us, t AS snap_t FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY abs(2 * i - n), i) AS rk FROM dr WHERE v > p AND v > q) WHERE rk = 1),
cut AS (SELECT sm.*, sp.snap_t, min(sm.t) OVER (PARTITION BY sm.track_id) AS t0, CASE WHEN sm.us < sp.snap_us THEN 'pre' ELSE 'post' END AS win FROM sm JOIN sp ON sm.track_id = sp.track_id),
near AS (SELECT * FROM (SELECT *, row_number() OVER ({_OF} ORDER BY CASE WHEN win = 'pre' THEN -us ELSE us END, event_id) AS rk FROM cut) WHERE rk <= 32),
w AS (SELECT *, CAST(row_number() OVER ({_OF} ORDER BY us, event_id) - 1 AS BIGINT) AS i, lag(v) OVER ({_OF} ORDER BY us, event_id) AS p, lead(v) OVER ({_OF} ORDER BY us, event_id) AS q, avg(v) OVER ({_OF}) AS mu, CAST(count(*) OVER ({_OF}) AS BIGINT) AS n FROM near),
wf AS (SELECT track_id, stem, win, min(t) AS a, max(t) AS b, round(max(snap_t) - min(t0), 9) / 100 AS lead_s, round(avg(v), 9) AS mean_energy, round(CASE WHEN count(*) > 1 THEN regr_slope(v, i) END, 9) AS slope, CAST(count_if(v > p AND v > q AND v >= mu + 0.05) AS DOUBLE) AS spike_count, round(count_if(v > p AND v > q AND v >= mu + 0.05) / CAST(count(*) AS DOUBLE), 9) AS spike_density,
  round(CASE WHEN count(*) > 2 THEN max_by(v, i) - min_by(v, i) END, 9) AS energy_jump, round(CASE WHEN count(*) > 2 THEN abs(regr_slope(v, i)) END, 9) AS abs_slope, round(CASE WHEN count(*) > 2 THEN stddev_pop(v - p) END, 9) AS flatness_score, round(CASE WHEN count(*) > 2 THEN avg(v) FILTER (WHERE i >= n - 5) END, 9) AS tail_energy,
  count_if(v < p AND v < q AND v < 0.05) AS valleys, count_if(i = 0 AND n > 4 AND v < 0.02 AND q > mu + 0.05) AS pickup,
  count_if(v > p AND v > q AND v > mu + 0.05 AND abs((i - 1) - floor((i - 1) / (n / 32.0)) * (n / 32.0) - n / 64.0) < n / 32.0 * 0.2) AS offgrid FROM w GROUP BY track_id, stem, win),
wx AS (SELECT track_id, win, min(a) AS a, max(b) AS b, {_FLAG_SQL} FROM wf GROUP BY track_id, win)"""
_NAMES = ("mean_energy", "slope", "spike_count", "spike_density", "energy_jump", "abs_slope", "flatness_score", "tail_energy")
_FLAGS = ("pickup_like", "vocal_valley_count", "highpass_like", "offgrid_like")
_PRE = "CASE WHEN win = 'post' THEN 'post_' ELSE '' END"
_LONG = " UNION ALL ".join([f"SELECT track_id, win, a, b, {_PRE} || '{n}_' || stem AS feature, {n} AS value FROM wf" for n in _NAMES] + [f"SELECT track_id, win, a, b, {_PRE} || '{n}' AS feature, {n} AS value FROM wx" for n in _FLAGS] + ["SELECT track_id, win, a, b, 'first_downbeat_s' AS feature, first_downbeat_s AS value FROM wx WHERE win = 'pre'"])
_PER_STEM = ", ".join(f"struct('{n}_' || s.stem AS n, s.{n} AS x, s.a AS a, s.b AS b)" for n in _NAMES)
_PER_WINDOW = ", ".join(f"struct('{n}' AS n, {n} AS x, a, b)" for n in _FLAGS)
#: The same in one pass over the features.
_LONG_ONCE = f"""SELECT track_id, win, e.a, e.b, {_PRE} || e.n AS feature, e.x AS value FROM (SELECT track_id, win, explode(concat(flatten(transform(stems, s -> array({_PER_STEM}))), array({_PER_WINDOW}), CASE WHEN win = 'pre' THEN array(struct('first_downbeat_s' AS n, first_downbeat_s AS x, a, b)) ELSE array() END)) AS e
 FROM (SELECT track_id, win, min(a) AS a, max(b) AS b, collect_list(struct(stem, a, b, {", ".join(_NAMES)})) AS stems, {_FLAG_SQL} FROM wf GROUP BY track_id, win))"""
_RULES = ", ".join(f"('{g}', '{s}', '{f}', '{op}', CAST({v} AS DOUBLE))" for g, s, f, op, v in R_.STYLE_RULES)


def _match(rules: str) -> str:
    return f"""
WITH {_FEATURES}, lf AS ({_LONG}), ru AS (SELECT * FROM (VALUES {rules}) AS ru(style_group, style, feature, op, bound)), tk AS (SELECT DISTINCT track_id FROM lf),
m AS (SELECT tk.track_id, ru.style_group, ru.style, bool_and(coalesce(CASE ru.op WHEN '>' THEN lf.value > ru.bound WHEN '<' THEN lf.value < ru.bound WHEN '>=' THEN lf.value >= ru.bound WHEN '<=' THEN lf.value <= ru.bound WHEN '==' THEN lf.value = ru.bound END, false)) AS ok
 FROM tk CROSS JOIN ru LEFT JOIN lf ON lf.track_id = tk.track_id AND lf.feature = ru.feature GROUP BY tk.track_id, ru.style_group, ru.style)
SELECT track_id, style_group, style FROM m WHERE ok"""


_MATCH = _match(_RULES)
_RULES_V1 = ", ".join(f"('{g}', '{s}', '{f}', '{op}', CAST({v} AS DOUBLE))" for g, s, f, op, v in R_.STYLE_RULES_V1)
_EVENTS = f"""
WITH {_FEATURES}, lf AS ({_LONG}), ru AS (SELECT * FROM (VALUES {_RULES}) AS ru(style_group, style, feature, op, bound))
SELECT lf.track_id, lf.feature, win AS position, R(a) AS start_t, R(b) AS end_t FROM lf JOIN (SELECT DISTINCT feature FROM ru) u ON lf.feature = u.feature WHERE lf.value IS NOT NULL"""

QUERIES: dict[str, str] = {
    "rule_match_long": _MATCH,
    "rule_match_compiled": _MATCH,
    "rule_match_first_edition": _match(_RULES_V1),
    "rule_features_used": f"SELECT DISTINCT feature FROM (VALUES {_RULES}) AS ru(style_group, style, feature, op, bound)",
    "feature_event_log": _EVENTS,
    "feature_unpivot": f"WITH {_FEATURES}, lf AS ({_LONG}) SELECT track_id, feature, R(value) AS value FROM lf WHERE value IS NOT NULL",
    "feature_split": f"WITH {_FEATURES}, lf AS ({_LONG}) SELECT DISTINCT feature, split_part(feature, '_', CAST(-1 AS INT)) AS stem, regexp_replace(feature, '_[^_]*$', '') AS base FROM lf",
    "event_log_dedupe": """
WITH $ev, n AS (SELECT track_id, stem, CAST(floor(t) AS BIGINT) AS start_t, count(*) AS n FROM ev WHERE t >= 360 GROUP BY track_id, stem, CAST(floor(t) AS BIGINT)), o AS (SELECT DISTINCT track_id, stem, CAST(floor(t) AS BIGINT) - 360 AS start_t FROM ev)
SELECT n.track_id, n.stem, n.start_t, n.n FROM n LEFT JOIN o ON n.track_id = o.track_id AND n.stem = o.stem AND n.start_t - 360 = o.start_t + 360 WHERE o.track_id IS NULL""",
    "feature_hub": f"""
WITH {_FEATURES}, $tr SELECT tr.track_id, CAST(tr.bpm AS DOUBLE) AS tempo_bpm, R(max(mean_energy) FILTER (WHERE stem = 'drums')) AS rhythm_mean_energy, R(max(spike_density) FILTER (WHERE stem = 'drums')) AS rhythm_spike_density, R(max(mean_energy) FILTER (WHERE stem = 'bass')) AS bass_mean_energy,
  R(max(flatness_score) FILTER (WHERE stem = 'bass')) AS bass_flatness, R(max(mean_energy) FILTER (WHERE stem = 'other')) AS harmony_mean_energy, R(max(tail_energy) FILTER (WHERE stem = 'vocals')) AS vocal_tail_energy, R(avg(mean_energy)) AS energy_avg, R(stddev_pop(mean_energy)) AS energy_energy_std
FROM tr LEFT JOIN wf ON tr.track_id = wf.track_id AND wf.win = 'pre' GROUP BY tr.track_id, tr.bpm""",
    "consistency_stats": f"WITH {_FEATURES} SELECT track_id, R(avg(spike_density)) AS mean_consistency, R(stddev_pop(spike_density)) AS std_consistency, R(1 - avg(abs_slope)) AS tightness FROM wf WHERE win = 'pre' GROUP BY track_id",
    "completeness_scan": f"WITH {_FEATURES}, lf AS ({_LONG}) SELECT feature, count(*) AS total, count(value) AS filled, R(count(value) / CAST(count(*) AS DOUBLE)) AS completeness, count(DISTINCT value) AS distinct_values FROM lf GROUP BY feature",
    "redundancy_corr": f"""
WITH {_FEATURES}, lf AS (SELECT track_id, 'mean_energy' AS f, stem, mean_energy AS x FROM wf WHERE win = 'pre' UNION ALL SELECT track_id, 'tail_energy' AS f, stem, tail_energy AS x FROM wf WHERE win = 'pre' UNION ALL SELECT track_id, 'flatness' AS f, stem, flatness_score AS x FROM wf WHERE win = 'pre' UNION ALL SELECT track_id, 'spikes' AS f, stem, spike_density AS x FROM wf WHERE win = 'pre')
SELECT a.f AS feature_a, b.f AS feature_b, R(CASE WHEN count(*) > 1 AND min(a.x) < max(a.x) AND min(b.x) < max(b.x) THEN corr(a.x, b.x) END) AS r FROM lf a JOIN lf b ON a.track_id = b.track_id AND a.stem = b.stem AND a.f < b.f GROUP BY a.f, b.f""",
    "order_window_features": """
WITH x AS (SELECT l_orderkey, l_linenumber AS i, l_extendedprice AS v, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS n FROM @lineitem)
SELECT l_orderkey, R(avg(v) FILTER (WHERE i * 2 <= n)) AS pre_mean, R(avg(v) FILTER (WHERE i * 2 > n)) AS post_mean, R(max(v) - min(v)) AS spread, coalesce(avg(v) FILTER (WHERE i * 2 > n) > 1.2 * avg(v) FILTER (WHERE i * 2 <= n), false) AS rises FROM x GROUP BY l_orderkey""",
    "genre_sanitise": "SELECT DISTINCT p_type, replace(initcap(trim(split_part(split_part(p_type, '/', 1), ',', 1))), ' ', '_') AS genre FROM @part",
    "genre_taxonomy_join": """
WITH m AS (SELECT * FROM (VALUES ('standard', 'House', 'Deep'), ('small', 'Techno', 'Minimal'), ('medium', 'Techno', 'Peak'), ('large', 'Trance', 'Uplifting'), ('economy', 'Ignore', NULL)) AS m(tag, main, sub)), p AS (SELECT p_partkey, lower(split_part(p_type, ' ', 1)) AS tag FROM @part)
SELECT p.p_partkey, coalesce(m.main, 'Unknown') AS main, m.sub FROM p LEFT JOIN m ON p.tag = m.tag WHERE coalesce(m.main, '') <> 'Ignore'""",
    "tag_coalesce": "SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN event_type END, CASE WHEN event_id % 3 = 1 THEN upper(event_type) END, 'Unknown') AS tag, try_cast(CASE WHEN event_id % 5 = 0 THEN 'Unknown' ELSE CAST(event_id % 60 + 90 AS STRING) END AS DOUBLE) AS bpm FROM @events",
    "fuzzy_match": "WITH p AS (SELECT DISTINCT p_name AS name FROM @part), c AS (SELECT array_agg(DISTINCT n_name) AS cands FROM @nation), d AS (SELECT name, array_min(transform(cands, x -> struct(levenshtein(lower(name), lower(x)) AS d, x AS cand))) AS m FROM p CROSS JOIN c) SELECT name, m.cand, CAST(m.d AS BIGINT) AS distance FROM d",
    "json_dig": "SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, coalesce(get_json_object(props, '$.missing.deep'), 'none') AS missing FROM @events",
    "csv_list_parse": "SELECT event_id, CAST(size(filter(transform(split(concat_ws(',', CAST(event_id % 7 AS STRING), 'x', CAST(value AS STRING), ''), ','), x -> try_cast(x AS DOUBLE)), x -> x IS NOT NULL)) AS BIGINT) AS parsed FROM @events",
    "sample_per_group": "WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY (doc_id * 7919) % 10007, doc_id) AS rk FROM @documents) SELECT source, doc_id FROM r WHERE rk <= 2",
    "file_pick_priority": "WITH o AS (SELECT * FROM (VALUES ('user', 1), ('assistant', 2), ('system', 3)) AS o(role, prio)), r AS (SELECT c.conv_id, c.turn, row_number() OVER (PARTITION BY c.conv_id ORDER BY coalesce(o.prio, 9), c.turn) AS rk FROM @conversations c LEFT JOIN o ON c.role = o.role) SELECT conv_id, turn AS picked_turn FROM r WHERE rk = 1",
    "mix_detect": "WITH x AS (SELECT * FROM (VALUES ('drums'), ('bass'), ('other'), ('vocals'), ('guitar'), ('piano')) AS x(name)), d AS (SELECT d.source, d.doc_id, row_number() OVER (PARTITION BY d.source ORDER BY d.n_chars DESC, d.doc_id) AS rk FROM @documents d LEFT JOIN x ON lower(split_part(d.text, ' ', 1)) = x.name WHERE x.name IS NULL) SELECT source, doc_id AS mix_doc FROM d WHERE rk = 1",
    "path_parts": "SELECT page_id, split_part(url, '/', CAST(-1 AS INT)) AS basename, lower(regexp_extract(url, '[.]([A-Za-z0-9]+)$', 1)) AS ext FROM @pages",
    "cosine_similarity": "",
    "key_detection": "",
    "bpm_autocorr": """
WITH $ev, d AS (SELECT track_id, us - lag(us) OVER (PARTITION BY track_id ORDER BY us, event_id) AS g FROM ev), h AS (SELECT track_id, g /~ 1800000000 AS bin, count(*) AS n FROM d WHERE g IS NOT NULL AND g < 90000000000 GROUP BY track_id, g /~ 1800000000),
a AS (SELECT x.track_id, y.bin - x.bin AS lag_, sum(x.n * y.n) AS s FROM h x JOIN h y ON x.track_id = y.track_id AND y.bin - x.bin BETWEEN 2 AND 20 GROUP BY x.track_id, y.bin - x.bin), r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY s DESC, lag_) AS rk FROM a)
SELECT track_id, lag_, R(60.0 / lag_) AS rate FROM r WHERE rk = 1""",
    "style_union_distinct": f"WITH m AS ({_MATCH.strip()}) SELECT DISTINCT track_id, style FROM m WHERE style_group IN ('pre', 'crossover')",
}
_DIM = "SELECT e.vec_id, g.k, element_at(e.embedding, CAST(g.k + 1 AS INT)) AS x FROM @embeddings e CROSS JOIN (RANGE(64, k)) g"
#: Major and minor key profiles.
_MAJOR = (6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88)
_MINOR = (6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17)
_PROFILES = ", ".join(f"({m}, {r}, {(k + r) % 12}, CAST({p[k]} AS DOUBLE))" for m, p in enumerate((_MAJOR, _MINOR)) for r in range(12) for k in range(12))
_KEY = f"""
WITH x AS ({_DIM}), c AS (SELECT vec_id, k % 12 AS pc, sum(abs(x)) AS v FROM x GROUP BY vec_id, k % 12), p AS (SELECT * FROM (VALUES {_PROFILES}) AS p(mode, root, pc, w)),
s AS (SELECT c.vec_id, p.mode, p.root, round(sum(c.v * p.w) / sqrt(sum(c.v * c.v) * sum(p.w * p.w)), 7) AS cs FROM c JOIN p ON c.pc = p.pc GROUP BY c.vec_id, p.mode, p.root), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cs DESC, mode, root) AS rk FROM s)
SELECT vec_id, CAST(mode AS BIGINT) AS mode, CAST(root AS BIGINT) AS root, CAST(CASE WHEN (root * 7 + 8 - 3 * mode + 12) % 12 = 0 THEN 12 ELSE (root * 7 + 8 - 3 * mode + 12) % 12 END AS STRING) || CASE WHEN mode = 0 THEN 'B' ELSE 'A' END AS camelot FROM r WHERE rk = 1"""
_COS = f"WITH x AS ({_DIM}) SELECT a.vec_id AS vec_a, b.vec_id AS vec_b, round(sum(CAST(a.x AS DOUBLE) * b.x) / sqrt(sum(CAST(a.x AS DOUBLE) * a.x) * sum(CAST(b.x AS DOUBLE) * b.x)), 5) AS cs FROM x a JOIN x b ON a.k = b.k AND b.vec_id = a.vec_id + 1 GROUP BY a.vec_id, b.vec_id"
QUERIES["key_detection"], QUERIES["cosine_similarity"] = _KEY, _COS

#: The condition vocabulary that has numbers, over the features of the event's window; the other conditions have no definition to compute.
DEFINITIONS = [
    ("bass-structured-groove-start", "bass", "post", [("min_post_energy", 0.002), ("energy_jump", 3.0)], "groove-launch"),
    ("bass-enters-post-loop", "bass", "post", [("min_post_energy", 0.003), ("energy_jump", 4.0)], "delayed-bass-drop"),
    ("drum-entry-downbeat", "drums", "post", [("energy_jump", 3.0), ("min_post_energy", 0.005), ("max_pre_peak", 0.0035)], "syncopated-kick-pattern"),
    ("synth-ramp-intro", "other", "pre", [("energy_slope", 0.0), ("min_energy_range", 0.05), ("max_pre_peak", 0.065)], "synth-ramp"),
    ("synth-bed-post-downbeat", "other", "post", [("energy_at_least", 0.015), ("energy_at_most", 0.07)], "chordal-gated-bed"),
    ("synth-fill-loop-pre", "other", "pre", [("max_energy", 0.07), ("min_energy", 0.02)], "atmospheric-synth-fill"),
    ("synth-mute-post-loop", "other", "post", [("max_post_energy", 0.005)], "post-drop-silence"),
    ("vocal-busy-pre-downbeat", "vocals", "pre", [("min_energy", 0.02), ("max_energy", 0.08)], "female-vocal-reverbed-busy"),
    ("vocal-busy-post-downbeat", "vocals", "post", [("min_energy", 0.03), ("max_energy", 0.09)], "female-vocal-reverbed-busy"),
    ("vocal-bleed-ignore-post-loop", "vocals", "post", [("max_post_energy", 0.006)], "bleed-ignore"),
]
_CONDITIONS = {
    "min_post_energy": "post_mean >= {}", "max_post_energy": "post_mean <= {}", "energy_jump": "post_mean >= {} * pre_mean", "max_pre_peak": "pre_max <= {}", "energy_slope": "{w}_slope > {}",
    "min_energy_range": "{w}_max - {w}_min >= {}", "energy_at_least": "{w}_mean >= {}", "energy_at_most": "{w}_mean <= {}", "min_energy": "{w}_mean >= {}", "max_energy": "{w}_mean <= {}",
}


def _definition(name: str, stem: str, window: str, conditions: list[tuple[str, float]], tag: str) -> str:
    """A definition compiled to one predicate over both windows of its stem; a missing value is false."""
    tests = " AND ".join(f"coalesce({_CONDITIONS[c].format(float(x), w=window)}, false)" for c, x in conditions)
    return f"SELECT track_id, '{name}' AS event, stem, '{window}' AS position, '{tag}' AS style_tag, R({window}_a) AS start_t, R({window}_b) AS end_t FROM sides WHERE stem = '{stem}' AND {tests}"


_SIDES = ", ".join(f"max({x}) FILTER (WHERE win = '{w}') AS {w}_{n}" for w in ("pre", "post") for x, n in (("mean_energy", "mean"), ("slope", "slope"), ("a", "a"), ("b", "b"), ("hi", "max"), ("lo", "min")))
QUERIES["event_definitions"] = f"""
WITH {_FEATURES}, ends AS (SELECT track_id, stem, win, max(v) AS hi, min(v) AS lo FROM w GROUP BY track_id, stem, win), wide AS (SELECT wf.*, ends.hi, ends.lo FROM wf JOIN ends ON wf.track_id = ends.track_id AND wf.stem = ends.stem AND wf.win = ends.win),
sides AS (SELECT track_id, stem, {_SIDES} FROM wide GROUP BY track_id, stem) {" UNION ALL ".join(_definition(*d) for d in DEFINITIONS)}"""
#: Small functions of names and numbers.
QUERIES["label_clean"] = "SELECT event_id, lower(trim(' ' || upper(event_type) || ' ')) AS label FROM @events WHERE lower(trim(event_type)) <> 'none' AND trim(event_type) <> ''"
QUERIES["title_case_name"] = "SELECT p_partkey, initcap(replace(p_name, '_', ' ')) AS title FROM @part"
QUERIES["hat_labels"] = "WITH $st SELECT track_id, count_if(label LIKE '%hat%') AS hats, count(*) AS labels FROM st GROUP BY track_id"
QUERIES["int_list_parse"] = "SELECT page_id, CAST(sum(try_cast(part AS BIGINT)) AS BIGINT) AS total, count(try_cast(part AS BIGINT)) AS parsed FROM (SELECT page_id, explode(split(concat_ws(';', CAST(page_id AS STRING), CAST(page_id % 7 AS STRING), 'x', ''), ';')) AS part FROM @pages) GROUP BY page_id"
QUERIES["duration_text"] = "SELECT conv_id, max(turn) AS turns, CAST((max(turn) * 37) /~ 60 AS STRING) || 'm ' || CAST((max(turn) * 37) % 60 AS STRING) || 's' AS spoken FROM @conversations GROUP BY conv_id"
QUERIES["relative_diff_pct"] = "SELECT p_partkey, R(abs(p_retailprice - 1500.0) / nullif((p_retailprice + 1500.0) / 2, 0) * 100) AS diff_pct FROM @part"
QUERIES["step_loop_duration"] = "WITH $tr SELECT track_id, R(60.0 / bpm / 4) AS step_duration_s, R(16 * 60.0 / bpm) AS loop_duration_s, R(64 * 60.0 / bpm / 4) AS grid_duration_s FROM tr"
QUERIES["map_merge"] = "WITH m AS (SELECT conv_id, turn, map_concat(map_filter(map('role', role, 'kind', 'turn'), (k, v) -> NOT map_contains_key(map('kind', 'text', 'size', CAST(length(text) AS STRING)), k)), map('kind', 'text', 'size', CAST(length(text) AS STRING))) AS m FROM @conversations) SELECT conv_id, turn, CAST(cardinality(m) AS BIGINT) AS entries, element_at(m, 'role') AS role, element_at(m, 'kind') AS kind, element_at(m, 'size') AS size_ FROM m"
_ORDER = "(VALUES ('kick', 1), ('snare', 2), ('clap', 3), ('hihat', 4)) AS o(label, prio)"
QUERIES["preferred_label_order"] = f"WITH $st, l AS (SELECT DISTINCT track_id, label FROM st), o AS (SELECT * FROM {_ORDER}) SELECT l.track_id, array_join(transform(array_sort(collect_list(struct(coalesce(o.prio, 99) AS p, l.label AS label))), x -> x.label), ',') AS labels FROM l LEFT JOIN o ON l.label = o.label GROUP BY l.track_id"
#: Rules in hundredths.
PCT_RULES = [("pre", "busy-drums", "spike_density_drums", ">", 8.0, "pct"), ("pre", "busy-drums", "mean_energy_drums", ">=", 20.0, "pct"), ("post", "calm-vocals", "post_spike_density_vocals", "<=", 0.0, "pct")]
QUERIES["rule_match_pct"] = _match(", ".join(f"('{g}', '{s}', '{f}', '{op}', CAST({v} AS DOUBLE))" for g, s, f, op, v, _ in PCT_RULES)).replace("lf.value", "lf.value * 100")
QUERIES["style_outputs"] = f"WITH m AS ({_MATCH.strip()}) SELECT track_id, string_agg(DISTINCT style, ',' ORDER BY style) FILTER (WHERE style_group <> 'post') AS downbeat_style, string_agg(DISTINCT style, ',' ORDER BY style) FILTER (WHERE style_group = 'post') AS loop_post_style FROM m GROUP BY track_id"

ORACLE = {
    "map_merge": "SELECT conv_id, turn, CAST(3 AS BIGINT) AS entries, role, 'text' AS kind, CAST(length(text) AS VARCHAR) AS size_ FROM conversations",
    "preferred_label_order": f"WITH $st, l AS (SELECT DISTINCT track_id, label FROM st), o AS (SELECT * FROM {_ORDER}) SELECT l.track_id, string_agg(l.label, ',' ORDER BY coalesce(o.prio, 99), l.label) AS labels FROM l LEFT JOIN o ON l.label = o.label GROUP BY l.track_id",
    "fuzzy_match": "WITH p AS (SELECT DISTINCT p_name AS name FROM part), c AS (SELECT DISTINCT n_name AS cand FROM nation), d AS (SELECT p.name, c.cand, levenshtein(lower(p.name), lower(c.cand)) AS d, row_number() OVER (PARTITION BY p.name ORDER BY levenshtein(lower(p.name), lower(c.cand)), c.cand) AS rk FROM p CROSS JOIN c) SELECT name, cand, CAST(d AS BIGINT) AS distance FROM d WHERE rk = 1",
    "title_case_name": "SELECT p_partkey, array_to_string(list_transform(string_split(replace(p_name, '_', ' '), ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS title FROM part",
    "int_list_parse": "SELECT page_id, CAST(sum(try_cast(part AS BIGINT)) AS BIGINT) AS total, count(try_cast(part AS BIGINT)) AS parsed FROM (SELECT page_id, unnest(string_split(concat_ws(';', CAST(page_id AS VARCHAR), CAST(page_id % 7 AS VARCHAR), 'x', ''), ';')) AS part FROM pages) GROUP BY page_id",
    "genre_sanitise": "WITH g AS (SELECT DISTINCT p_type, trim(split_part(split_part(p_type, '/', 1), ',', 1)) AS g FROM part) SELECT p_type, array_to_string(list_transform(string_split(g, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '_') AS genre FROM g",
    "json_dig": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing.deep'), 'none') AS missing FROM events",
    "csv_list_parse": "SELECT event_id, CAST(len(list_filter(list_transform(string_split(concat_ws(',', CAST(event_id % 7 AS VARCHAR), 'x', CAST(value AS VARCHAR), ''), ','), lambda x: try_cast(x AS DOUBLE)), lambda x: x IS NOT NULL)) AS BIGINT) AS parsed FROM events",
    "tag_coalesce": QUERIES["tag_coalesce"].replace("AS STRING", "AS VARCHAR"),
    "key_detection": _KEY.replace("element_at(e.embedding, CAST(g.k + 1 AS INT))", "e.embedding[g.k + 1]").replace("AS STRING", "AS VARCHAR"),
    "cosine_similarity": _COS.replace("element_at(e.embedding, CAST(g.k + 1 AS INT))", "e.embedding[g.k + 1]"),
}


for _name, _text in list(QUERIES.items()):
    if _LONG in _text:
        ORACLE[_name], QUERIES[_name] = _text, _text.replace(_LONG, _LONG_ONCE)


def _long(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(spark_text(f"WITH {_FEATURES} {_LONG_ONCE}"), events=events).select("track_id", "feature", "value")


def rule_match_long(spark, sf_dir):
    """Rules as data, joined to unpivoted features."""
    return R_.match_long(_long(spark, sf_dir), R_.rule_table(spark))


def rule_match_first_edition(spark, sf_dir):
    return R_.match_long(_long(spark, sf_dir), R_.rule_table(spark, R_.STYLE_RULES_V1))


def rule_match_compiled(spark, sf_dir):
    """The same rules as one predicate per style over wide features; only features that some rule reads are kept."""
    used = sorted({r[2] for r in R_.STYLE_RULES})
    wide = _long(spark, sf_dir).where(F.col("feature").isin(used)).groupBy("track_id").agg(*[F.max(F.when(F.col("feature") == f, F.col("value"))).alias(f) for f in used])
    return R_.match_compiled(wide)


def rule_match_pct(spark, sf_dir):
    return R_.match_long(_long(spark, sf_dir), R_.rule_table(spark, PCT_RULES))


def style_outputs(spark, sf_dir):
    """The styles of each track, before and from the snap point, as sorted lists in text."""
    listed = lambda test: F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(test, F.col("style")))), ","), F.lit(""))
    post = F.col("style_group") == "post"
    return rule_match_long(spark, sf_dir).groupBy("track_id").agg(listed(~post).alias("downbeat_style"), listed(post).alias("loop_post_style"))


def style_union_distinct(spark, sf_dir):
    return rule_match_long(spark, sf_dir).where("style_group in ('pre', 'crossover')").select("track_id", "style").distinct()


FUNCTIONS = {f.__name__: f for f in (rule_match_long, rule_match_compiled, rule_match_first_edition, rule_match_pct, style_outputs, style_union_distinct)}
