"""Queries and kernels against independent numpy forms of what they compute."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulselake import catalogue, tables
from pulselake.functions import kernels as K
from pulselake.operators import rules
from pulselake.streaming import streams

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tracks(spark):
    rows = tables.frames(spark, SF, by_stem=False).orderBy("track_id", "i").collect()
    out = {}
    for r in rows:
        out.setdefault(r.track_id, []).append(r)
    return out


def test_slots_and_triplets_round_half_to_even(spark, tracks):
    got = {(r.track_id, r.slot): r.v for r in catalogue.QUERIES["slot_envelope_alignment"](spark, SF).collect()}
    for k, frames in tracks.items():
        v = np.array([f.v for f in frames])
        want = v[np.clip(np.round(np.arange(64) * 0.75).astype(int), 0, len(v) - 1)]
        assert np.allclose([got[k, s] for s in range(64)], want)
    steps = spark.range(16).selectExpr("id", "CAST(floor(id * 0.75 + 0.5) - CASE WHEN floor(id * 0.75 + 0.5) = id * 0.75 + 0.5 AND CAST(floor(id * 0.75 + 0.5) AS BIGINT) % 2 = 1 THEN 1 ELSE 0 END AS BIGINT) AS s").collect()
    assert [r.s for r in steps] == np.round(np.arange(16) * 0.75).astype(int).tolist()


def sections_of(v, kick):
    n = len(v)
    x = np.convolve(v, np.ones(9) / 9, mode="same")
    z, slope, median = (x - x.mean()) / (x.std() + 1e-9), np.gradient(x), np.median(kick)
    drops = [b for b in range(1, n - 1) if x[b - 1] < x[b] > x[b + 1] and z[b] >= 1 and slope[b] > 0 and kick[b] >= median]
    drop = drops[0] if drops else int(x.argmax())
    stop = drop or n
    intro = next((b for b in range(stop) if x[b] >= 0.4 * x.max()), min(stop, n // 8))
    lo, hi, rest = min(n - 1, drop + 4), min(n - 1, drop + max(16, n // 6)), (None, None)
    if hi > lo:
        valley = lo + int(x[lo : hi + 1].argmin())
        if x[valley] <= 0.75 * x[max(0, drop - 8) : drop + 1].max() and kick[valley] <= 0.3 * (median + 1e-9):
            rest = (max(drop + 2, valley - 4), min(n - 1, valley + 4))
    outro = None
    if n >= 32:
        falling = np.flatnonzero(slope[drops[-1] :] < 0) if drops else []
        outro = drops[-1] + int(falling[0]) if len(falling) else int(0.75 * n)
    return drop, intro, *rest, outro


def test_section_boundaries(spark, tracks):
    got = {r.track_id: r for r in catalogue.QUERIES["section_boundaries"](spark, SF).collect()}
    checked = 0
    for k, frames in tracks.items():
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        if len(pairs) < 16:
            assert k not in got
            continue
        want = sections_of(np.array([np.mean([f.v for f in p]) for p in pairs]), np.array([sum(f.stem == "click" for f in p) for p in pairs]))
        r = got[k]
        assert (r.drop_beat, r.intro_end, r.break_start, r.break_end, r.outro) == want
        checked += 1
    assert checked > 5


def test_loop_candidates(spark, tracks):
    anchors = {(r.track_id, r.i): (r.anchors, r.hits) for r in catalogue.QUERIES["fuzzy_anchor"](spark, SF).collect()}
    best = {(r.track_id, r.rk): r for r in catalogue.QUERIES["loop_candidate_score"](spark, SF).collect()}
    for k, frames in list(tracks.items())[:12]:
        t, v = np.array([f.t for f in frames]), np.array([f.v for f in frames])
        peaks = [i for i in range(len(v)) if v[i] == v[max(0, i - 2) : i + 3].max() and v[i] > 0.05 * v.max()]
        cands = [i for i in peaks if v[i] >= 0.7 * v[peaks].mean()]
        width = 45 / 64
        pattern = {i: np.array([np.abs(t[peaks] - (t[i] + s * width)).min() <= 0.25 for s in range(64)]) for i in cands}
        scores = {}
        for i in cands:
            n = 0
            for want in np.arange(t[i] + 45, t[peaks[-1]] + 1e-9, 45):
                near = min(cands, key=lambda j: (abs(t[j] - want), j))
                n += abs(t[near] - want) <= 0.5 and int((pattern[i] != pattern[near]).sum()) <= 10
            slots = np.flatnonzero(pattern[i])
            assert anchors[k, i] == (n, len(slots))
            spread = np.diff(slots).std() if len(slots) > 1 else 10.0
            scores[i] = 0.4 * n + 0.2 * (1 - spread / 10) + 0.15 * v[i] / v[cands].max() + 0.15 * pattern[i][0] + 0.1 * (1 - t[i] / t[cands[-1]])
        top = max(cands, key=lambda i: (round(scores[i], 9), -i))
        assert best[k, 1].i == top and best[k, 1].score == pytest.approx(scores[top], abs=1e-5)


def features(**values):
    """All features of a quiet track, with some set."""
    base = {f"{pre}{n}_{s}": 0.5 for pre in ("", "post_") for n in ("mean_energy", "slope", "spike_count", "spike_density", "energy_jump", "abs_slope", "flatness_score", "tail_energy") for s in ("drums", "bass", "other", "vocals", "guitar", "piano")}
    base |= {f"{pre}{n}": 0.0 for pre in ("", "post_") for n in ("pickup_like", "highpass_like", "offgrid_like", "vocal_valley_count")} | {"first_downbeat_s": 9.0}
    return base | values


@pytest.mark.parametrize("edition", [rules.STYLE_RULES, rules.STYLE_RULES_V1])
def test_each_style_fires_and_both_forms_agree(spark, edition):
    """A track for each style that has just what its rules ask."""
    edge = {">": 1e-6, "<": -1e-6, ">=": 0.0, "<=": 0.0, "==": 0.0}
    styles = sorted({r[:2] for r in edition})
    rows = [(k, f, float(x)) for k, style in enumerate(styles) for f, x in features(**{r[2]: r[4] + edge[r[3]] for r in edition if r[:2] == style}).items()]
    long_ = spark.createDataFrame(rows, "track_id long, feature string, value double")
    joined = {tuple(r) for r in rules.match_long(long_, rules.rule_table(spark, edition)).collect()}
    wide = long_.groupBy("track_id").pivot("feature").agg(F.first("value"))
    compiled = {tuple(r) for r in rules.match_compiled(wide, edition).collect()}
    assert joined == compiled and all((k, *style) in joined for k, style in enumerate(styles)) and len(styles) >= 18
    lacking = long_.where("feature <> 'first_downbeat_s'")
    assert not [r for r in rules.match_long(lacking, rules.rule_table(spark, edition)).collect() if r.style == "hard-start"]


def test_rule_queries_see_two_windows(spark):
    long_ = catalogue.QUERIES["feature_unpivot"](spark, SF).collect()
    value = {(r.track_id, r.feature): r.value for r in long_}
    pairs = [(v, value[k, "post_" + f]) for (k, f), v in value.items() if (k, "post_" + f) in value and f.startswith("mean_energy")]
    assert len(pairs) > 20 and np.mean([a != b for a, b in pairs]) > 0.9
    log = catalogue.QUERIES["feature_event_log"](spark, SF).collect()
    assert {r.position for r in log} == {"pre", "post"} and all(r.start_t <= r.end_t for r in log)


def test_complexity_and_tempo():
    for tokens, phrases in (([], None), (["a"], 1), (["a", "a", "a", "a"], 4), (["k", "s", "k", "s"], 5)):
        n = len("\x1f".join(tokens))
        assert K.complexity(tokens) == (1.0 if phrases is None else round((phrases + 1) / n, 3))
    beat = np.arange(0.5, 60, 0.5)
    assert K.tempo_by_spectrum(beat) == pytest.approx(120, abs=1.1) and K.tempo_by_spectrum(beat[:1]) is None
    assert K.tempo_by_spectrum(np.array([0.0, 0.001])) is None


def test_adaptive_peaks_wait():
    rng = np.random.default_rng(2)
    for wait in (0, 1, 4, 9):
        v, out, k = rng.uniform(0, 1, 300), [], 0
        while k < len(v):
            if v[k] == v[max(0, k - 3) : k + 4].max() and v[k] >= v[max(0, k - 20) : k + 21].mean() + 0.2 and (not out or k - out[-1] >= 2):
                out.append(k)
                k += max(wait, 1)
            else:
                k += 1
        assert K.adaptive_peaks(v, 3, 20, 0.2, 2, wait).tolist() == out


def test_label_bands():
    t = np.arange(4096) / 44100
    loud = K.label_confidences(np.sin(2 * np.pi * 60 * t), 44100.0)
    assert max(loud, key=loud.get) in ("sub", "kick") and loud["hihat"] < 0.05 and len(loud) == 17
    assert all(x == 0 for x in K.label_confidences(np.zeros(16), 100.0).values())
    hi = K.band_pass(np.sin(2 * np.pi * 0.1 * np.arange(400)), 0.05, 0.2)
    lo = K.band_pass(np.sin(2 * np.pi * 0.005 * np.arange(400)), 0.05, 0.2)
    assert hi[200:].std() > 4 * lo[200:].std()


def test_streamed_peaks_equal_the_batch(spark):
    got = {(r.user_id, r.event_id, r.value) for r in streams.streaming_peaks(spark, SF).collect()}
    by_user = {}
    for r in tables.load(spark, SF, "events").orderBy("user_id", "ts", "event_id").collect():
        by_user.setdefault(r.user_id, []).append(r)
    want = {(u, b.event_id, b.value) for u, rows in by_user.items() for a, b, c in zip(rows, rows[1:], rows[2:]) if a.value < b.value > c.value}
    assert got == want and len(want) > 50


def test_spectral_kernels():
    rate, t = 1000.0, np.arange(2048) / 1000
    assert K.welch_share(np.sin(2 * np.pi * 100 * t), rate, 30, 180) > 0.99 > 0.01 > K.welch_share(np.sin(2 * np.pi * 400 * t), rate, 30, 180)
    assert K.welch_share(np.zeros(1), rate, 30, 180) == 0 and K.welch_share(np.ones(100), rate, 30, 180) == 0
    steady, clicks = np.sin(2 * np.pi * 0.2 * np.arange(800)), np.zeros(800)
    clicks[::80] = 5
    share = lambda v: (lambda h, p: h.sum() / (h.sum() + p.sum()))(*K.harmonic_percussive(v))
    assert share(steady) > 0.7 > 0.4 > share(clicks)
    m = np.random.default_rng(1).uniform(size=(9, 7))
    assert K.running_median(m, 2, 0)[4, 3] == np.median(m[2:7, 3]) and K.running_median(m, 2, 1)[4, 3] == np.median(m[4, 1:6])
    a = K.chroma(np.sin(2 * np.pi * 440 * np.arange(8000) / 8000), 8000.0, 1024, 512)
    assert a.argmax() == 0 and a.max() == 1 and len(a) == 12 and not K.chroma(np.zeros(2000), 8000.0).any()


def test_beats_follow_the_onsets():
    strength = np.zeros(200)
    strength[5::10] = 1
    strength[[31, 78]] = 0.4  # off the beat
    beats = K.track_beats(strength, 10)
    assert set(beats.tolist()) <= set(range(5, 200, 10)) and len(beats) >= 18
    assert len(K.track_beats(np.zeros(0), 4)) == 0
