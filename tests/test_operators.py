"""Operators on small literal frames against hand-made results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulselake.functions import kernels as K
from pulselake.operators import joins, rules, windows
from pulselake.sinks import logs
from pulselake.sources import audio, documents


def rows(df, *order):
    return sorted(map(tuple, df.collect()), key=str)


def test_band_join_matches_nested_loop(spark):
    rng = np.random.default_rng(1)
    a = [(int(k), i, float(t)) for i, (k, t) in enumerate(zip(rng.integers(0, 3, 60), rng.uniform(-5, 20, 60).round(1)))] + [(0, 99, None)]
    b = [(int(k), i, float(t)) for i, (k, t) in enumerate(zip(rng.integers(0, 3, 60), rng.uniform(-5, 20, 60).round(1)))]
    left, right = spark.createDataFrame(a, "k int, lid int, lt double"), spark.createDataFrame(b, "k int, rid int, rt double")
    got = joins.band_join(left, right, ["k"], "lt", "rt", 0.5)
    want = {(x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] is not None and abs(x[2] - y[2]) <= 0.5}
    assert {(r.lid, r.rid) for r in got.collect()} == want
    assert got.count() == len(want)
    assert joins.band_join(left, right, ["k"], "lt", "rt", 0.5, "left_anti").count() == len(a) - len({x for x, _ in want})
    near = joins.nearest_within(left, right, ["k"], "lid", "lt", "rid", "rt", 0.5)
    best = {x[1]: min(abs(x[2] - y[2]) for y in b if (x[1], y[1]) in want) for x in a if any((x[1], y[1]) in want for y in b)}
    assert {r.lid: pytest.approx(r.distance) for r in near.collect()} == best
    with pytest.raises(ValueError):
        joins.band_join(left, right, ["k"], "lt", "rt", 0)


def test_band_join_is_an_equi_join(spark):
    a = spark.createDataFrame([(1, 1.0)], "k int, lt double")
    plan = joins.band_join(a, a.withColumnRenamed("lt", "rt"), ["k"], "lt", "rt", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_both_directions(spark):
    left = spark.createDataFrame([(1, 10, "a"), (1, 25, "b"), (2, 1, "c")], "k int, lt int, name string")
    right = spark.createDataFrame([(1, 10, 5), (1, 20, 6), (1, 20, 7), (3, 0, 9)], "k int, rt int, v int")
    back = {r.name: r.v for r in joins.asof_join(left, right, ["k"], "lt", "rt", "v").collect()}
    assert back == {"a": 5, "b": 7, "c": None}
    ahead = {r.name: r.v for r in joins.asof_join(left, right, ["k"], "lt", "rt", "v", "forward").collect()}
    assert ahead == {"a": 5, "b": None, "c": None}


def frames(spark, *values):
    return spark.createDataFrame([(k, i, float(v)) for k, vs in enumerate(values) for i, v in enumerate(vs)], "k int, i long, v double")


def test_window_features_edges(spark):
    got = {r.k: r for r in windows.window_features(frames(spark, [1, 9, 1, 9, 1], [4], [2, 2, 2]), ["k"], 1.0).collect()}
    assert got[0].spike_count == 2 and got[0].slope == pytest.approx(0) and got[0].tail_energy == pytest.approx(4.2)
    assert got[1].slope is None and got[1].energy_jump is None and got[1].spike_count == 0
    assert got[2].flatness_score == 0 and got[2].slope == 0


def test_sliding_frames_cover_whole_windows_only(spark):
    got = {(r.frame): r.rms for r in windows.sliding_rms(frames(spark, [3, 4, 0, 0, 0, 12]), ["k"], 4, 2).collect()}
    assert got == {0: pytest.approx(2.5), 1: pytest.approx(6.0)}
    assert windows.tumbling_rms(frames(spark, [3, 4, 5]), ["k"], 2).count() == 2


def test_moving_average_and_segments(spark):
    got = [r.smooth for r in windows.moving_average(frames(spark, [3, 3, 3]), ["k"], 3).orderBy("i").collect()]
    assert got == [2, 3, 2]
    seg = rows(windows.segments(frames(spark, [0, 5, 0, 0, 5]), ["k"], F.col("v") > 1).select("segment", "first", "length"))
    assert seg == [(0, 0, 1), (1, 1, 3), (2, 4, 1)]


def test_rules_long_and_compiled_agree(spark):
    table = [("g", "loud", "e", ">", 1.0, None), ("g", "loud", "n", "<=", 2.0, None), ("g", "odd", "missing", "<", 9.0, None), ("g", "share", "e", ">=", 150.0, "pct"), ("g", "bad", "e", "~", 1.0, None)]
    wide = spark.createDataFrame([(1, 1.5, 2.0), (2, 1.5, 3.0), (3, None, 1.0), (4, 1.0, 0.0)], "track_id int, e double, n double")
    long_ = wide.unpivot(["track_id"], ["e", "n"], "feature", "value")
    want = [(1, "g", "loud"), (1, "g", "share"), (2, "g", "share")]
    assert rows(rules.match_long(long_, rules.rule_table(spark, table))) == want
    assert rows(rules.match_compiled(wide, table)) == want


def test_split_feature(spark):
    df = spark.createDataFrame([("mean_energy_drums",), ("pickup_like",)], "f string")
    assert rows(df.select(*rules.split_feature(F.col("f")))) == [("mean_energy", "drums"), ("pickup_like", None)]


def test_peak_kernels():
    v = np.array([0, 2, 2, 1, 3, 0, 5, 0.0])
    assert K.strict_peaks(v).tolist() == [1, 4, 6]
    assert K.distance_peaks(v, 3).tolist() == [1, 6]
    assert K.distance_peaks(np.array([1.0]), 2).tolist() == []
    assert K.adaptive_peaks(np.array([0, 9, 0, 0, 8, 0.0]), reach=1, separation=2, delta=1).tolist() == [1, 4]


def test_filter_tempo_and_complexity():
    x = np.ones(400)
    assert K.butterworth_lowpass(x, 0.1)[-1] == pytest.approx(1, abs=1e-6)
    fast = np.sin(np.pi * 0.9 * np.arange(400))
    assert np.abs(K.butterworth_lowpass(fast, 0.05)[200:]).max() < 0.05
    assert K.tempo_by_spectrum(np.arange(0, 30, 0.5)) == pytest.approx(120, abs=2)
    assert K.tempo_by_spectrum(np.array([1.0])) is None
    assert K.complexity(["a"] * 40) < K.complexity(list("qwertyuiopasdfghjklzxcvbnmqazwsxedcrfvtgbyhn"))
    assert sum(K.band_shares(np.sin(np.arange(64)), (0.0, 0.2, 0.5))) == pytest.approx(1, abs=0.3)


def test_log_sink_keys(spark):
    schema = "track_name string, event string, start double, stem string, target string"
    old = spark.createDataFrame([("t", "e", 1.0, "drums", None)], schema)
    new = spark.createDataFrame([("t", "e", 1.0, "drums", None), ("t", "e", 2.0, "drums", None), ("t", "e", 2.0, "drums", None)], schema)
    assert logs.new_events(new, old).count() == 2
    assert logs.new_events(new, old, within=True).count() == 1
    assert logs.wide_union([old.select("start"), new.select("event")]).columns == ["event", "start"]


def test_documents_of_three_shapes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('{"bpm": 129.2, "beat_times": [0.5, 1.0]}')
    (tmp_path / "a" / "y.json").write_text('{"bpm": {"value": 90}, "beats": {"used": [1.5]}}')
    (tmp_path / "a" / "z.json").write_text('{"bpm": "Unknown", "beat_times": "1, x,2"}')
    (tmp_path / "a" / ".z.json").write_text("{}")
    docs = documents.read_documents(spark, str(tmp_path))
    assert sorted((r.path[-6:], r.bpm) for r in docs.select("path", documents.tempo(F.col("raw")).alias("bpm")).collect()) == [("x.json", 129.2), ("y.json", 90.0), ("z.json", None)]
    assert sorted(r.t for r in documents.beats(docs).collect()) == [0.5, 1.0, 1.0, 1.5, 2.0]
    assert documents.first_of_folder(docs).first().path.endswith("x.json")


def test_listing_sampling_and_tags(spark, tmp_path):
    for d in "ab":
        (tmp_path / d).mkdir()
        for k in range(4):
            (tmp_path / d / f"{d}{k}.WAV").write_bytes(b"x" * (k + 1))
    files = documents.list_files(spark, str(tmp_path), ("wav",))
    assert files.count() == 8 and documents.sample_files(files, 2, 3, 7).count() == 4
    pick = documents.pick_by_priority(files.withColumn("folder", F.lit(1)), ["folder"], "name", ["zz", "b2.WAV"])
    assert pick.first().name == "b2.WAV"
    lines = spark.createDataFrame([("p", 1, "TBPM=120"), ("p", 2, "tempo=99"), ("p", 3, "genre=House=Deep"), ("p", 4, "nothing")], "path string, line_no int, line string")
    assert tuple(documents.tag_lines(lines).first()) == ("p", "120", None, "House=Deep")


def test_audio_frames(spark, tmp_path):
    import wave

    with wave.open(str(tmp_path / "s.wav"), "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.repeat(np.full(1000, 16384, "<i2"), 2).tobytes())
    (tmp_path / "bad.wav").write_bytes(b"no audio")
    samples = audio.read_audio(spark, str(tmp_path), chunk=300)
    assert samples.count() == 4
    got = audio.frame_energy(samples, 400, chunk=300).orderBy("i").collect()
    assert [(r.n, round(r.rms, 3)) for r in got] == [(400, 0.5), (400, 0.5), (200, 0.5)]
    assert len(audio.resample(np.arange(10, dtype=np.float32), 10, 5)) == 5


def test_rule_file_is_read_and_not_run(spark, tmp_path):
    (tmp_path / "rules.py").write_text("import os\nSTYLE_DEFINITIONS = {'pre': {'old': {'rules': []}}}\nSTYLE_DEFINITIONS = {'pre': {'s': {'rules': [{'feature': 'f', 'op': '>', 'value': 1}, {'feature': 'g', 'op': '==', 'value': True, 'mode': 'pct'}]}}}\nDEFINITIONS = {'d': {'target': 't', 'stem': 'bass', 'position': 'post', 'conditions': {'min_post_energy': 0.5, 'energy_jump': {'ratio': 3.0}}, 'style_tag': 'x'}}\nos.remove('/nowhere')\n")
    found, defs = documents.read_rules(spark, str(tmp_path / "rules.py"))
    assert rows(found) == [("pre", "s", "f", ">", 1.0, None), ("pre", "s", "g", "==", 1.0, "pct")]
    assert rows(defs) == [("d", "t", "bass", "post", "energy_jump", '{"ratio": 3.0}', "x"), ("d", "t", "bass", "post", "min_post_energy", "0.5", "x")]
    assert rows(rules.match_long(spark.createDataFrame([(1, "f", 2.0), (1, "g", 0.01), (2, "f", 0.5)], "track_id long, feature string, value double"), found)) == [(1, "pre", "s")]


def test_patterns_and_log_files(spark, tmp_path):
    path = str(tmp_path / "p")
    logs.write_patterns(spark.createDataFrame([(0.5, [1, 0, 1]), (2.0, [])], "onset_time double, pattern array<int>"), path)
    assert sorted((r.onset_time, r.pattern) for r in documents.read_patterns(spark, path).collect()) == [(0.5, [1, 0, 1]), (2.0, [None])]
    assert logs.preview(spark.createDataFrame([(3,), (1,), (2,)], "a int"), 2).collect()[0].a == 1


def test_frame_energy_over_chunk_ends(spark):
    x = np.random.default_rng(0).normal(size=1000).astype(np.float32)
    parts = spark.createDataFrame([("f", 10, k, x[k * 64 : (k + 1) * 64].tolist()) for k in range(16)], audio.SAMPLE_SCHEMA)
    got = {r.i: (r.rms, r.n) for r in audio.frame_energy(parts, 48, 64).collect()}
    for i in range(0, 1000 // 48 + 1):
        part = x[i * 48 : (i + 1) * 48].astype(float)
        assert got[i][0] == pytest.approx(np.sqrt((part**2).mean())) and got[i][1] == len(part)


def test_stages_are_selected_by_name():
    from pulselake.plans import operator_queries as O

    assert O.select_stages() == [q for qs in O.STAGES.values() for q in qs]
    assert O.select_stages("windows", "rules", skip=("grid",)) == ["stem_window_features", "rule_match_compiled"]
    with pytest.raises(ValueError):
        O.select_stages("nothing")
