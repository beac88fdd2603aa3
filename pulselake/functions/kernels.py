"""Kernels that SQL cannot express: sequential pickers, recursive filters, transforms, complexity.

Each takes the ordered samples of one group as a numpy array; ``per_group`` applies one to every group in
``applyInPandas``, so a group (one stream of one track) is the unit of memory.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def per_group(frames: DataFrame, keys: list[str], kernel: Callable[[np.ndarray, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """``kernel(t, v)`` of each group in order of ``i``; the keys are added to its rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i", kind="stable")
        out = kernel(pdf["t"].to_numpy(float), pdf["v"].to_numpy(float))
        for name, value in zip(keys, key):
            out[name] = value
        return out[names]

    return frames.groupBy(*keys).applyInPandas(run, schema)


def strict_peaks(v: np.ndarray) -> np.ndarray:
    """Indices of local maxima; the middle of a plateau stands for it."""
    if len(v) < 3:
        return np.empty(0, int)
    start = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    end = np.append(start[1:], len(v)) - 1
    level = v[start]
    inner = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1
    return (start[inner] + end[inner]) // 2


def distance_peaks(v: np.ndarray, distance: int, height: float = -np.inf) -> np.ndarray:
    """Peaks at least ``distance`` apart: the higher one stays, of equals the later."""
    peaks = strict_peaks(v)
    peaks = peaks[v[peaks] >= height]
    keep = np.ones(len(peaks), bool)
    for k in np.argsort(v[peaks], kind="stable")[::-1]:
        if keep[k]:
            keep[np.searchsorted(peaks, peaks[k] - distance, "right") : np.searchsorted(peaks, peaks[k] + distance, "left")] = False
            keep[k] = True
    return peaks[keep]


def adaptive_peaks(v: np.ndarray, reach: int = 10, mean_reach: int = 50, delta: float = 0.05, separation: int = 5, wait: int = 0) -> np.ndarray:
    """Local maxima over ``reach`` that exceed the local mean by ``delta``, ``separation`` after the last; after each, ``wait`` samples are not looked at."""
    sums = np.concatenate([[0.0], np.cumsum(v)])
    at = np.arange(len(v))
    lo, hi = np.maximum(0, at - mean_reach), np.minimum(len(v), at + mean_reach + 1)
    padded = np.pad(v.astype(float), reach, constant_values=-np.inf)
    highest = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1).max(1) if len(v) else padded[:0]
    out: list[int] = []
    for k in np.flatnonzero((v == highest) & (v >= (sums[hi] - sums[lo]) / np.maximum(1, hi - lo) + delta - 1e-12)).tolist():
        if not out or k - out[-1] >= max(separation, wait):
            out.append(k)
    return np.array(out, int)


def complexity(tokens: list[str]) -> float:
    """Phrases of a parse of the joined tokens, each the shortest text that does not stand before it, and one, by characters."""
    text = "\x1f".join(tokens)
    n, at, phrases = len(text), 0, 0
    while at < n:
        size = 1
        while at + size <= n and text.find(text[at : at + size], 0, at) >= 0:
            size += 1
        phrases += 1
        at += size
    return round((phrases + 1) / n, 3) if n else 1.0


def tempo_by_spectrum(onsets: np.ndarray, low: float = 50, high: float = 200, rate: float = 100.0) -> float | None:
    """Beats per minute of the strongest component of an impulse train from time 0, strictly inside the band; None with fewer than two onsets."""
    if len(onsets) < 2 or int(onsets[-1] * rate) < 1:
        return None
    train = np.zeros(int(onsets[-1] * rate))
    at = (onsets * rate).astype(int)
    train[at[(at < len(train)) & (at >= 0)]] = 1
    power, bpm = np.abs(np.fft.rfft(train)), np.fft.rfftfreq(len(train), 1 / rate) * 60
    inside = (bpm > low) & (bpm < high)
    return round(float(bpm[inside][power[inside].argmax()]), 2) if inside.any() else None


#: The label bands in Hz.
LABEL_BANDS = {
    "sub": (20, 80), "kick": (30, 180), "snare": (100, 450), "snare_roll": (100, 450), "clap": (1000, 3000), "rim": (1500, 4000), "tom": (80, 180), "hihat": (5000, 12000), "ride": (4000, 10000),
    "crash": (2000, 8000), "stab": (300, 900), "bell": (700, 2000), "woodblock": (800, 1500), "glitch": (2000, 12000), "fx": (8500, 14000), "vocal": (200, 2000), "bass_click": (100, 300),
}


def label_confidences(v: np.ndarray, rate: float) -> dict[str, float]:
    """Share of the magnitude spectrum of a Hann-windowed frame in each label band, both ends included."""
    spectrum, at = np.abs(np.fft.rfft(v * np.hanning(len(v)))), np.fft.rfftfreq(len(v), 1 / rate)
    total = spectrum.sum() + 1e-12
    return {name: float(spectrum[(at >= lo) & (at <= hi)].sum() / total) for name, (lo, hi) in LABEL_BANDS.items()}


def slot_frames(v: np.ndarray, centres: np.ndarray, half: int) -> list[np.ndarray]:
    """The samples around each centre, cut at the ends of the signal."""
    return [v[max(0, c - half) : c + half] for c in centres.tolist()]


def band_pass(v: np.ndarray, low: float, high: float) -> np.ndarray:
    """Second-order high pass after a second-order low pass (edges as shares of the sampling rate)."""
    return v_low - butterworth_lowpass(v_low, low) if len(v_low := butterworth_lowpass(v, high)) else v


def butterworth_lowpass(v: np.ndarray, cutoff: float, zero_phase: bool = False) -> np.ndarray:
    """Second-order low pass (cutoff as a share of the sampling rate), causal or run both ways."""
    k = np.tan(np.pi * cutoff)
    norm = 1 / (1 + np.sqrt(2) * k + k * k)
    b0, a1, a2 = k * k * norm, 2 * (k * k - 1) * norm, (1 - np.sqrt(2) * k + k * k) * norm

    def once(x: np.ndarray) -> np.ndarray:
        y, z1, z2 = np.empty_like(x), 0.0, 0.0
        for i, s in enumerate(x):
            y[i] = b0 * s + z1
            z1 = 2 * b0 * s - a1 * y[i] + z2
            z2 = b0 * s - a2 * y[i]
        return y

    return once(once(v)[::-1])[::-1] if zero_phase else once(v)


def spectra(v: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Magnitudes of Hann-windowed frames; a short input is one padded frame."""
    if len(v) < size:
        v = np.pad(v, (0, size - len(v)))
    frames = np.lib.stride_tricks.sliding_window_view(v, size)[::hop]
    return np.abs(np.fft.rfft(frames * np.hanning(size), axis=1))


def spectral_flux(v: np.ndarray, size: int = 16, hop: int = 4) -> np.ndarray:
    """Half-wave rectified increase of the spectrum, on a scale of one."""
    m = spectra(v, size, hop)
    flux = np.concatenate([[0.0], np.maximum(np.diff(m, axis=0), 0).sum(1)])
    return flux / flux.max() if flux.max() > 0 else flux


def band_shares(v: np.ndarray, edges: tuple[float, ...], size: int = 16, hop: int = 8) -> list[float]:
    """Share of spectral energy in each band (edges as shares of the sampling rate, both ends included)."""
    power, at = spectra(v, size, hop).sum(0), np.fft.rfftfreq(size)
    total = power.sum()
    return [float(power[(at >= lo) & (at <= hi)].sum() / total) if total else 0.0 for lo, hi in zip(edges, edges[1:])]


def snapped_intervals(beats: np.ndarray, onsets: np.ndarray, tolerance: float) -> np.ndarray:
    """Beats moved one after another to the nearest onset within ``tolerance``; each starts from the last moved one."""
    if not len(beats):
        return beats
    step, out = (np.median(np.diff(beats)) if len(beats) > 1 else 0.0), [float(beats[0])]
    for _ in range(1, len(beats)):
        want = out[-1] + step
        near = onsets[np.abs(onsets - want).argmin()] if len(onsets) else want
        out.append(float(near) if abs(near - want) <= tolerance and near > out[-1] else want)
    return np.array(out)


def close_match(name: str, choices: list[str], cutoff: float = 0.6) -> str | None:
    import difflib

    found = difflib.get_close_matches(name, choices, n=1, cutoff=cutoff)
    return found[0] if found else None


def welch_share(v: np.ndarray, rate: float, low: float, high: float, size: int = 256) -> float:
    """Share of the averaged periodogram (Hann segments, half overlapping, each without its mean) between two frequencies."""
    size = min(size, len(v))
    if size < 2:
        return 0.0
    parts = np.lib.stride_tricks.sliding_window_view(v, size)[:: max(1, size // 2)]
    power = (np.abs(np.fft.rfft((parts - parts.mean(1, keepdims=True)) * np.hanning(size), axis=1)) ** 2).mean(0)
    at, total = np.fft.rfftfreq(size, 1 / rate), power.sum()
    return float(power[(at >= low) & (at <= high)].sum() / total) if total > 0 else 0.0


def running_median(m: np.ndarray, reach: int, axis: int) -> np.ndarray:
    """Median over 2 reach + 1 neighbours along an axis, the ends mirrored."""
    pad = [(reach, reach) if a == axis else (0, 0) for a in range(m.ndim)]
    return np.median(np.lib.stride_tricks.sliding_window_view(np.pad(m, pad, mode="symmetric"), 2 * reach + 1, axis=axis), axis=-1)


def harmonic_percussive(v: np.ndarray, size: int = 16, hop: int = 4, reach: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Magnitudes split by soft masks: what is steady over time, and what is spread over frequencies."""
    m = spectra(v, size, hop)
    h, p = running_median(m, reach, 0) ** 2, running_median(m, reach, 1) ** 2
    mask = np.divide(h, h + p, out=np.full_like(h, 0.5), where=h + p > 0)
    return m * mask, m * (1 - mask)


def chroma(v: np.ndarray, rate: float, size: int = 256, hop: int = 128) -> np.ndarray:
    """Magnitude in each of the 12 pitch classes (A first), on a scale of one."""
    m, at = spectra(v, size, hop).sum(0), np.fft.rfftfreq(size, 1 / rate)
    heard = at > 20
    out = np.bincount(np.round(12 * np.log2(at[heard] / 440)).astype(int) % 12, m[heard], 12)
    return out / out.max() if out.max() > 0 else out


def track_beats(strength: np.ndarray, period: int, tightness: float = 10.0) -> np.ndarray:
    """Beats that follow strong onsets at about the period: the best chain by dynamic programming, from its best end back."""
    n = len(strength)
    if n == 0 or period < 1:
        return np.empty(0, int)
    score, before = strength.astype(float).copy(), np.full(n, -1)
    for i in range(n):
        j = np.arange(max(0, i - 2 * period), i - max(1, period // 2) + 1)
        if len(j):
            gain = score[j] - tightness * np.log((i - j) / period) ** 2
            k = int(gain.argmax())
            if gain[k] > 0:
                score[i] += gain[k]
                before[i] = j[k]
    at = max(0, n - period) + int(score[max(0, n - period) :].argmax())
    out = []
    while at >= 0:
        out.append(at)
        at = before[at]
    return np.array(out[::-1])
