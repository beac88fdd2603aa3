"""Window statistics, extrema, smoothing, segments and energy features over frames (name -> query text)."""

from __future__ import annotations

_LAGS = "lag(v) OVER (PARTITION BY track_id, stem ORDER BY i) AS p, lead(v) OVER (PARTITION BY track_id, stem ORDER BY i) AS q"
_MIX = "lag(v) OVER (PARTITION BY track_id ORDER BY i) AS p, lead(v) OVER (PARTITION BY track_id ORDER BY i) AS q"

QUERIES: dict[str, str] = {
    "stem_window_features": f"""
WITH $fr, w AS (SELECT *, {_LAGS}, avg(v) OVER (PARTITION BY track_id, stem) AS mu, count(*) OVER (PARTITION BY track_id, stem) AS n FROM fr)
SELECT track_id, stem, count(*) AS n, R(avg(v)) AS mean_energy, R(CASE WHEN count(*) > 1 THEN regr_slope(v, i) END) AS slope,
  count_if(v > p AND v > q AND v >= mu + 5) AS spike_count, R(count_if(v > p AND v > q AND v >= mu + 5) / CAST(count(*) AS DOUBLE)) AS spike_density,
  R(CASE WHEN count(*) > 2 THEN max_by(v, i) - min_by(v, i) END) AS energy_jump, R(CASE WHEN count(*) > 2 THEN abs(regr_slope(v, i)) END) AS abs_slope,
  R(CASE WHEN count(*) > 2 THEN stddev_pop(v - p) END) AS flatness_score, R(CASE WHEN count(*) > 2 THEN avg(v) FILTER (WHERE i >= n - 5) END) AS tail_energy,
  count_if(v < p AND v < q AND v < 5) AS valley_count, coalesce(bool_or(i = 1 AND n > 4 AND p < 20 AND v > mu + 5), false) AS pickup_like
FROM w GROUP BY track_id, stem""",
    "scan_window_features": f"""
WITH $fr, w AS (SELECT *, {_LAGS}, stddev_pop(v) OVER (PARTITION BY track_id, stem) AS sd FROM fr)
SELECT track_id, stem, R(avg(v)) AS mean_energy, R(stddev_pop(v)) AS std_energy, R((max_by(v, i) - min_by(v, i)) / count(*)) AS slope, R(abs(max_by(v, i) - min_by(v, i)) / count(*)) AS abs_slope,
  R(max(v - p) FILTER (WHERE i = 1)) AS energy_jump, count_if(v - p > sd) AS spike_count, R(avg(abs(v - p))) AS flatness_score
FROM w GROUP BY track_id, stem""",
    "pre_post_windows": """
WITH $fr, c AS (SELECT track_id, stem, count(*) /~ 2 AS snap FROM fr GROUP BY track_id, stem)
SELECT fr.track_id, fr.stem, CASE WHEN fr.i < c.snap THEN 'pre' ELSE 'post' END AS position, count(*) AS n, R(avg(fr.v)) AS mean_energy, R(min(fr.t)) AS start_t, R(max(fr.t)) AS end_t
FROM fr JOIN c ON fr.track_id = c.track_id AND fr.stem = c.stem WHERE fr.i BETWEEN c.snap - 4 AND c.snap + 3 GROUP BY fr.track_id, fr.stem, CASE WHEN fr.i < c.snap THEN 'pre' ELSE 'post' END""",
    "local_peaks": f"WITH $fr, w AS (SELECT *, {_LAGS} FROM fr) SELECT track_id, stem, i, v FROM w WHERE v > p AND v > q",
    "local_valleys": f"WITH $fr, w AS (SELECT *, {_LAGS} FROM fr) SELECT track_id, stem, i, v FROM w WHERE v < p AND v < q AND v < 20",
    "maxfilter_peaks": """
WITH $mx, w AS (SELECT *, max(v) OVER (PARTITION BY track_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM mx)
SELECT track_id, i, v FROM w WHERE v = m AND v > 5""",
    "plateau_peaks": """
WITH $mx, r AS (SELECT track_id, i, floor(v / 10) AS v FROM mx),
c AS (SELECT *, CASE WHEN v <> lag(v) OVER (PARTITION BY track_id ORDER BY i) THEN 1 ELSE 0 END AS new FROM r),
g AS (SELECT *, sum(new) OVER (PARTITION BY track_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM c),
k AS (SELECT track_id, run, min(v) AS v, min(i) AS a, max(i) AS b FROM g GROUP BY track_id, run),
n AS (SELECT *, lag(v) OVER (PARTITION BY track_id ORDER BY run) AS p, lead(v) OVER (PARTITION BY track_id ORDER BY run) AS q FROM k)
SELECT track_id, (a + b) /~ 2 AS i, CAST(v AS DOUBLE) AS height, b - a + 1 AS width FROM n WHERE v > p AND v > q""",
    "tumbling_rms": "WITH $fr SELECT track_id, stem, i /~ 4 AS frame, count(*) AS n, R(sqrt(avg(v * v))) AS rms FROM fr GROUP BY track_id, stem, i /~ 4",
    "sliding_rms": """
WITH $fr, o AS (RANGE(2, d)), n AS (SELECT track_id, stem, count(*) AS n FROM fr GROUP BY track_id, stem),
x AS (SELECT fr.*, fr.i /~ 2 - o.d AS frame FROM fr CROSS JOIN o)
SELECT x.track_id, x.stem, x.frame, R(sqrt(avg(x.v * x.v))) AS rms, R(sqrt(sqrt(avg(x.v * x.v)))) AS root_rms FROM x JOIN n ON x.track_id = n.track_id AND x.stem = n.stem
WHERE x.frame >= 0 AND x.frame * 2 + 4 <= n.n GROUP BY x.track_id, x.stem, x.frame""",
    "smooth3_reflect": f"WITH $mx, w AS (SELECT *, {_MIX} FROM mx) SELECT track_id, i, R((coalesce(p, v) + v + coalesce(q, v)) / 3) AS smooth FROM w",
    "moving_average9": "WITH $mx SELECT track_id, i, R(sum(v) OVER (PARTITION BY track_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) / 9) AS smooth FROM mx",
    "gradient_zscore": f"""
WITH $mx, w AS (SELECT *, {_MIX} FROM mx)
SELECT track_id, i, R(CASE WHEN p IS NULL THEN q - v WHEN q IS NULL THEN v - p ELSE (q - p) / 2 END) AS gradient,
  R((v - avg(v) OVER (PARTITION BY track_id)) / (stddev_pop(v) OVER (PARTITION BY track_id) + 1e-9)) AS z FROM w""",
    "minmax_normalise": "WITH $fr SELECT track_id, stem, i, R((v - min(v) OVER (PARTITION BY track_id, stem)) / (max(v) OVER (PARTITION BY track_id, stem) - min(v) OVER (PARTITION BY track_id, stem) + 1e-6)) AS x FROM fr",
    "first_entry": """
WITH $fr, m AS (SELECT *, max(v) OVER (PARTITION BY track_id, stem) AS peak, max(t) OVER (PARTITION BY track_id) AS total FROM fr)
SELECT track_id, stem, min(i) FILTER (WHERE v > 0.05 * peak) AS first_index, R(min(t) FILTER (WHERE v > 0.05 * peak)) AS first_t, R(min(t) FILTER (WHERE v > 0.05 * peak) / max(total)) AS first_norm FROM m GROUP BY track_id, stem""",
    "active_gaps": """
WITH $mx, a AS (SELECT track_id, i - lag(i) OVER (PARTITION BY track_id ORDER BY i) AS gap FROM mx WHERE v >= 30)
SELECT track_id, count_if(gap > 1) AS gaps, R(coalesce(avg(gap) FILTER (WHERE gap > 1), 0.0)) AS mean_gap FROM a GROUP BY track_id""",
    "voiced_segments": """
WITH $mx, s AS (SELECT track_id, sum(CASE WHEN v >= 30 THEN 1 ELSE 0 END) OVER (PARTITION BY track_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS seg FROM mx),
n AS (SELECT track_id, seg, count(*) AS n FROM s GROUP BY track_id, seg)
SELECT track_id, count(*) AS segments, R(avg(n)) AS mean_length, max(n) AS longest, R(stddev_pop(n)) AS std_length FROM n GROUP BY track_id""",
    "autocorr_repetition": """
WITH $mx, g AS (RANGE(11, lag_)), c AS (SELECT track_id, i, v - avg(v) OVER (PARTITION BY track_id) AS x FROM mx)
SELECT a.track_id, b.i - a.i AS lag_, R(sum(a.x * b.x)) AS acf FROM c a JOIN g ON g.lag_ >= 1 JOIN c b ON a.track_id = b.track_id AND b.i = a.i + g.lag_ GROUP BY a.track_id, b.i - a.i""",
    "repetition_score": """
WITH $mx, g AS (RANGE(17, lag_)), z AS (SELECT track_id, sum(v * v) AS power FROM mx GROUP BY track_id),
a AS (SELECT x.track_id, g.lag_, sum(x.v * y.v) AS acf FROM mx x JOIN g ON g.lag_ >= 2 JOIN mx y ON x.track_id = y.track_id AND y.i = x.i + g.lag_ GROUP BY x.track_id, g.lag_)
SELECT z.track_id, R(max(a.acf) / nullif(max(z.power), 0)) AS score FROM z LEFT JOIN a ON z.track_id = a.track_id GROUP BY z.track_id""",
    "energy_summary": """
WITH $mx, m AS (SELECT *, avg(v) OVER (PARTITION BY track_id) AS mu, lag(v) OVER (PARTITION BY track_id ORDER BY i) AS p FROM mx)
SELECT track_id, R(avg(v)) AS avg_energy, R(stddev_pop(v)) AS energy_std, R(max(v)) AS peak_energy, R(avg(power(v - mu, 3)) / nullif(power(avg(power(v - mu, 2)), 1.5), 0)) AS energy_skewness,
  R(stddev_pop(v) / nullif(avg(v), 0)) AS energy_variation, R(max(v) / nullif(avg(v), 0)) AS energy_crest, R(exp(avg(ln(v + 1e-9))) / nullif(avg(v), 0)) AS energy_flatness,
  count_if(v - p < -50) AS drop_count, R(avg(CASE WHEN v < 5 THEN 1.0 ELSE 0.0 END)) AS break_silence_ratio FROM m GROUP BY track_id""",
    "ramp_up_score": "WITH $mx SELECT track_id, R(CASE WHEN count(*) > 1 AND min(v) < max(v) THEN corr(v, i) END) AS ramp FROM mx GROUP BY track_id",
    "energy_histogram": """
WITH $mx, x AS (SELECT track_id, (v - min(v) OVER (PARTITION BY track_id)) / nullif(max(v) OVER (PARTITION BY track_id) - min(v) OVER (PARTITION BY track_id), 0) AS x FROM mx)
SELECT track_id, CAST(least(floor(x * 10), 9) AS BIGINT) AS bin, count(*) AS n FROM x GROUP BY track_id, CAST(least(floor(x * 10), 9) AS BIGINT)""",
    "energy_entropy": """
WITH $mx, p AS (SELECT track_id, v / nullif(sum(v) OVER (PARTITION BY track_id), 0) AS p, CASE WHEN v > avg(v) OVER (PARTITION BY track_id) THEN 1.0 ELSE 0.0 END AS a FROM mx)
SELECT track_id, R(-sum(p * ln(p + 1e-12))) AS entropy, R(-(avg(a) * ln(avg(a) + 1e-12) + (1 - avg(a)) * ln(1 - avg(a) + 1e-12)) / ln(2.0)) AS activity_entropy FROM p GROUP BY track_id""",
    "energy_percentiles": "WITH $mx SELECT track_id, R(PCT(v, 0.25)) AS p25, R(median(v)) AS p50, R(PCT(v, 0.75)) AS p75, R(PCT(v, 0.75) - PCT(v, 0.25)) AS iqr FROM mx GROUP BY track_id",
    "beat_means": """
WITH $mx, b AS (SELECT track_id, i /~ 4 AS beat, avg(v) AS m FROM mx GROUP BY track_id, i /~ 4)
SELECT track_id, count(*) AS beats, R(avg(m)) AS beat_energy_mean, R(stddev_pop(m)) AS beat_energy_std FROM b GROUP BY track_id""",
    "beat_stats_rollup": """
WITH $sf SELECT track_id, bar, step /~ 4 AS beat, CAST(sum(n) AS BIGINT) AS labels, count(*) AS slots, R(avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END)) AS density FROM sf GROUP BY ROLLUP (track_id, bar, step /~ 4)""",
    "onset_energy_correlation": """
WITH $mx, b AS (SELECT track_id, i /~ 4 AS beat, avg(v) AS energy, count_if(stem = 'purchase') AS hits FROM mx GROUP BY track_id, i /~ 4)
SELECT track_id, R(CASE WHEN count(*) > 1 AND min(energy) < max(energy) AND min(hits) < max(hits) THEN corr(energy, hits) END) AS r FROM b GROUP BY track_id""",
    "linear_resample": """
WITH $mx, n AS (SELECT track_id, count(*) AS n FROM mx GROUP BY track_id), g AS (RANGE(16, k)), q AS (SELECT n.track_id, g.k, g.k * (n.n - 1) / 15.0 AS x FROM n CROSS JOIN g)
SELECT q.track_id, q.k, R(a.v + (coalesce(b.v, a.v) - a.v) * (q.x - floor(q.x))) AS v FROM q JOIN mx a ON a.track_id = q.track_id AND a.i = CAST(floor(q.x) AS BIGINT) LEFT JOIN mx b ON b.track_id = q.track_id AND b.i = CAST(floor(q.x) AS BIGINT) + 1""",
    "vibrato_residual": """
WITH $mx, c AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY track_id) > 1 THEN regr_slope(v, i) OVER (PARTITION BY track_id) ELSE 0 END AS b, avg(v) OVER (PARTITION BY track_id) AS mv, avg(i) OVER (PARTITION BY track_id) AS mi FROM mx)
SELECT track_id, R(stddev_pop(v - (mv + b * (i - mi)))) AS residual_std, R(1 - stddev_pop(v) / nullif(avg(v), 0)) AS consistency FROM c GROUP BY track_id""",
    "stem_presence": """
WITH $fr, p AS (SELECT track_id, stem, avg(CASE WHEN v >= 20 THEN 1.0 ELSE 0.0 END) AS presence, count(*) AS n FROM fr GROUP BY track_id, stem)
SELECT track_id, R(max(presence) FILTER (WHERE stem = 'click')) AS drums, R(max(presence) FILTER (WHERE stem = 'purchase')) AS bass, R(max(presence) FILTER (WHERE stem = 'error')) AS vocals,
  count_if(presence > 0.1) AS stem_variety, R(count_if(presence > 0.1) / 5.0) AS variety_score, R(max(presence) FILTER (WHERE stem = 'error') / nullif(avg(presence) FILTER (WHERE stem <> 'error'), 0)) AS vocals_vs_instruments FROM p GROUP BY track_id""",
    "stem_entry_order": """
WITH $fr, e AS (SELECT track_id, stem, min(us) AS first_us FROM fr WHERE v >= 20 GROUP BY track_id, stem)
SELECT track_id, stem, CAST(row_number() OVER (PARTITION BY track_id ORDER BY first_us, stem) AS BIGINT) AS entry_rank FROM e""",
    "peak_stems": """
WITH $st, a AS (SELECT track_id, slot, count(*) AS n FROM st GROUP BY track_id, slot), b AS (SELECT track_id, slot, sum(n) OVER (PARTITION BY track_id ORDER BY slot ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS w FROM a)
SELECT track_id, CAST(max(w) AS BIGINT) AS peak_labels FROM b GROUP BY track_id""",
    "impute_normalise": """
WITH $mx, x AS (SELECT track_id, i, CASE WHEN v < 5 THEN NULL ELSE v END AS v FROM mx), y AS (SELECT track_id, i, coalesce(v, avg(v) OVER (PARTITION BY track_id)) AS v FROM x)
SELECT track_id, i, R((v - avg(v) OVER (PARTITION BY track_id)) / (stddev_pop(v) OVER (PARTITION BY track_id) + 1e-9)) AS z FROM y""",
    "section_boundaries": """
WITH $mx, b AS (SELECT track_id, i /~ 2 AS beat, avg(v) AS e, count_if(stem = 'click') AS kick FROM mx GROUP BY track_id, i /~ 2),
s AS (SELECT *, sum(e) OVER (PARTITION BY track_id ORDER BY beat ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) / 9 AS v, CAST(count(*) OVER (PARTITION BY track_id) AS BIGINT) AS n, median(kick) OVER (PARTITION BY track_id) AS mk FROM b),
z AS (SELECT *, (v - avg(v) OVER (PARTITION BY track_id)) / (stddev_pop(v) OVER (PARTITION BY track_id) + 1e-9) AS z, lag(v) OVER (PARTITION BY track_id ORDER BY beat) AS p, lead(v) OVER (PARTITION BY track_id ORDER BY beat) AS q, max(v) OVER (PARTITION BY track_id) AS top FROM s WHERE n >= 16),
c AS (SELECT *, CASE WHEN v > p AND v > q AND z >= 1.0 AND q - p > 0 AND kick >= mk THEN beat END AS cand, CASE WHEN v = top THEN beat END AS peak FROM z),
d AS (SELECT *, coalesce(min(cand) OVER (PARTITION BY track_id), min(peak) OVER (PARTITION BY track_id)) AS dr, max(cand) OVER (PARTITION BY track_id) AS last_drop FROM c),
f AS (SELECT *, CASE WHEN dr = 0 THEN n ELSE dr END AS stop_, least(dr + 4, n - 1) AS lo, least(dr + greatest(16, n /~ 6), n - 1) AS hi FROM d),
g AS (SELECT *, min(CASE WHEN beat BETWEEN lo AND hi AND lo < hi THEN v END) OVER (PARTITION BY track_id) AS low FROM f),
h AS (SELECT *, min(CASE WHEN beat BETWEEN lo AND hi AND lo < hi AND v = low THEN beat END) OVER (PARTITION BY track_id) AS valley FROM g),
a AS (SELECT track_id, max(n) AS beats, max(dr) AS drop_beat, coalesce(min(beat) FILTER (WHERE beat < stop_ AND v >= 0.4 * top), min(least(stop_, n /~ 8))) AS intro_end,
  max(low) AS low, max(v) FILTER (WHERE beat BETWEEN dr - 8 AND dr) AS before, max(valley) AS valley, max(kick) FILTER (WHERE beat = valley) AS valley_kick, max(mk) AS mk, max(last_drop) AS last_drop,
  min(beat) FILTER (WHERE beat >= last_drop AND coalesce(q, v) - coalesce(p, v) < 0) AS falls FROM h GROUP BY track_id)
SELECT track_id, beats, drop_beat, intro_end, CASE WHEN low <= 0.75 * before AND valley_kick <= 0.3 * (mk + 1e-9) THEN greatest(valley - 4, drop_beat + 2) END AS break_start, CASE WHEN low <= 0.75 * before AND valley_kick <= 0.3 * (mk + 1e-9) THEN least(valley + 4, beats - 1) END AS break_end,
  CASE WHEN beats >= 32 THEN coalesce(falls, CAST(floor(0.75 * beats) AS BIGINT)) END AS outro, R(CASE WHEN beats < 48 THEN 0.8 ELSE 1.0 END) AS confidence FROM a""",
    "rms_envelope": """
WITH $mx, h AS (SELECT track_id, i /~ 3 AS k, sum(v * v) AS e, count(*) AS n FROM mx GROUP BY track_id, i /~ 3), x AS (SELECT track_id, k, n, e, lead(e) OVER (PARTITION BY track_id ORDER BY k) AS e2, lead(n) OVER (PARTITION BY track_id ORDER BY k) AS n2 FROM h)
SELECT track_id, k AS frame, R(sqrt((e + e2) / 6 + 1e-12)) AS rms FROM x WHERE n = 3 AND n2 = 3""",
    "loop_std_entropy": """
WITH $mx, l AS (SELECT track_id, i /~ 16 AS loop_, avg(v) AS m FROM mx GROUP BY track_id, i /~ 16), s AS (SELECT track_id, R(stddev_pop(m)) AS loop_std FROM l GROUP BY track_id),
c AS (SELECT track_id, stem, count(*) AS c FROM mx GROUP BY track_id, stem), p AS (SELECT track_id, c / CAST(sum(c) OVER (PARTITION BY track_id) AS DOUBLE) AS p FROM c), e AS (SELECT track_id, R(-sum(p * ln(p) / ln(2.0))) AS repetition_entropy FROM p GROUP BY track_id)
SELECT s.track_id, s.loop_std, e.repetition_entropy FROM s JOIN e ON s.track_id = e.track_id""",
    "bass_per_beat": """
WITH $fr, b AS (SELECT track_id, v, v - lag(v) OVER (PARTITION BY track_id ORDER BY i) AS dv, t FROM fr WHERE stem = 'purchase')
SELECT track_id, R(count(*) / greatest((max(t) - min(t)) / 11.25, 1.0)) AS notes_per_beat, R(1 / (1 + coalesce(stddev_pop(dv), 0.0))) AS smoothness FROM b GROUP BY track_id""",
    "drop_crest": """
WITH $mx, d AS (SELECT track_id, i AS at FROM (SELECT track_id, i, row_number() OVER (PARTITION BY track_id ORDER BY v DESC, i) AS rk FROM mx) WHERE rk = 1)
SELECT d.track_id, d.at, R(max(m.v) / nullif(avg(m.v), 0)) AS crest FROM d JOIN mx m ON m.track_id = d.track_id AND m.i BETWEEN d.at - 4 AND d.at + 4 GROUP BY d.track_id, d.at""",
    "slot_envelope_alignment": """
WITH $mx, $sl, n AS (SELECT track_id, count(*) AS n FROM mx GROUP BY track_id)
SELECT sl.track_id, sl.slot, R(mx.v) AS v FROM sl JOIN n ON sl.track_id = n.track_id JOIN mx ON mx.track_id = sl.track_id AND mx.i = least(greatest(CAST(floor(sl.slot * 0.75 + 0.5) - CASE WHEN floor(sl.slot * 0.75 + 0.5) = sl.slot * 0.75 + 0.5 AND CAST(floor(sl.slot * 0.75 + 0.5) AS BIGINT) % 2 = 1 THEN 1 ELSE 0 END AS BIGINT), 0), n.n - 1)""",
}
