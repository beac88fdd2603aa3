"""Queries over kernels (rows-only checks): pickers, filters, transforms, complexity, streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import tables
from ..functions import kernels as K
from ..streaming import streams


def distance_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame({"i": (p := K.distance_peaks(v, 3)), "v": v[p]})
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, i long, v double")


def adaptive_peak_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame({"i": (p := K.adaptive_peaks(v, delta=5.0, wait=3)), "t": t[p]})
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, i long, t double")


def butter_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame({"i": np.arange(len(v)), "causal": np.round(K.butterworth_lowpass(v, 0.1), 6), "zero_phase": np.round(K.butterworth_lowpass(v, 0.1, True), 6)})
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, i long, causal double, zero_phase double")


def spectral_flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame({"frame": np.arange(len(f := K.spectral_flux(v))), "flux": np.round(f, 6)})
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, frame long, flux double")


def band_energy_fft(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame([np.round(K.band_shares(v, (0.0, 0.1, 0.25, 0.5)), 6)], columns=["low", "mid", "high"])
    return K.per_group(tables.frames(spark, sf_dir), ["track_id", "stem"], kernel, "track_id long, stem string, low double, mid double, high double")


def label_band_confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidences of the 17 label bands in the frame around each slot centre; a sample stands for 1/28 000 s."""

    def kernel(t, v):
        rows = [(k, *(round(x, 6) for x in K.label_confidences(f, 28_000.0).values())) for k, f in enumerate(K.slot_frames(v, np.arange(8, len(v), 8), 8)) if len(f) >= 4]
        return pd.DataFrame(rows, columns=["slot", *K.LABEL_BANDS])

    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, slot long, " + ", ".join(f"{n} double" for n in K.LABEL_BANDS))


def band_pass_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame({"i": np.arange(len(v)), "v": np.round(K.band_pass(v, 0.05, 0.2), 6)})
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, i long, v double")


def kick_band_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the averaged periodogram in the lowest band, a sample standing for 1/1000 s."""
    kernel = lambda t, v: pd.DataFrame({"share": [round(K.welch_share(v, 1000.0, 30.0, 180.0, 32), 6)]})
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, share double")


def harmonic_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kernel(t, v):
        h, p = (x.sum() for x in K.harmonic_percussive(v))
        return pd.DataFrame({"harmonic": [round(float(h / (h + p)), 6) if h + p > 0 else 0.0]})

    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, harmonic double")


def chroma_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pitch classes of each track, a sample standing for 1/4000 s, and their entropy."""

    def kernel(t, v):
        c = K.chroma(v, 4000.0, 32, 16)
        p = c / c.sum() if c.sum() > 0 else np.full(12, 1 / 12)
        return pd.DataFrame({"pitch": np.arange(12), "weight": np.round(c, 6), "entropy": round(float(-(p[p > 0] * np.log2(p[p > 0])).sum()), 6)})

    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, pitch long, weight double, entropy double")


def tracked_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame({"i": (b := K.track_beats(v / max(v.max(), 1e-9), 4)), "t": t[b]})
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, i long, t double")


def bpm_fft(spark: SparkSession, sf_dir: str) -> DataFrame:
    kernel = lambda t, v: pd.DataFrame({"bpm": [K.tempo_by_spectrum(t)]}, dtype=float)
    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, bpm double")


def snapped_tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kernel(t, v):
        beats = K.snapped_intervals(np.arange(t[0], t[-1], 12.0), t, 2.0)
        return pd.DataFrame({"beat": np.arange(len(beats)), "t": np.round(beats, 6), "bpm": np.round(60 / np.diff(beats, prepend=np.nan), 6)})

    return K.per_group(tables.frames(spark, sf_dir, by_stem=False), ["track_id"], kernel, "track_id long, beat long, t double, bpm double")


def lz_complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("double")
    def score(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda x: round(K.complexity(list(x)), 6))

    rows = tables.events(spark, sf_dir).groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct("us", "event_id", "stem"))).alias("r"))
    return rows.select("track_id", score(F.col("r.stem")).alias("complexity"))


def close_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = [r.n_name for r in tables.load(spark, sf_dir, "nation").select("n_name").collect()]  # a fixed dimension of 25 names

    @F.pandas_udf("string")
    def nearest(names: pd.Series) -> pd.Series:
        return names.map(lambda x: K.close_match(x, nations))

    return tables.load(spark, sf_dir, "supplier").select("s_suppkey", nearest(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string"))).alias("nation"))


QUERIES = {f.__name__: f for f in (distance_peaks, adaptive_peak_pick, butter_filter, spectral_flux, band_energy_fft, bpm_fft, label_band_confidences, band_pass_filter, kick_band_share, harmonic_share, chroma_profile, tracked_beats, snapped_tempo, lz_complexity, close_match, streams.streaming_tumbling_energy, streams.streaming_session_segments, streams.streaming_dedupe_log, streams.streaming_sliding_energy, streams.streaming_peaks)}
