"""Waveforms as chunked sample tables."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_SCHEMA = "path string, sr int, chunk long, samples array<float>"


def decode_wav(data: bytes) -> tuple[int, np.ndarray]:
    """Sampling rate and mono samples on a scale of one; channels are averaged."""
    with wave.open(io.BytesIO(data)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / 2**23
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / 2 ** (8 * width - 1)
    return rate, x.reshape(-1, channels).mean(1)


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation to another rate."""
    if rate == target or not len(x):
        return x
    n = max(1, round(len(x) * target / rate))
    return np.interp(np.arange(n) * rate / target, np.arange(len(x)), x).astype(np.float32)


def read_audio(spark: SparkSession, path: str, target_rate: int | None = None, chunk: int = 1 << 16) -> DataFrame:
    """Rows of ``chunk`` samples of every .wav below ``path``; files that are no audio give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    rate, x = decode_wav(data.as_py())
                except (wave.Error, EOFError):
                    continue
                x, rate = (resample(x, rate, target_rate), target_rate) if target_rate else (x, rate)
                for k, at in enumerate(range(0, len(x), chunk)):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rate], pa.int32()), pa.array([k], pa.int64()), pa.array([x[at : at + chunk]], pa.list_(pa.float32()))], ["path", "sr", "chunk", "samples"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[wW][aA][vV]").load(path)
    return files.select("path", "content").mapInArrow(run, SAMPLE_SCHEMA)


def frame_energy(samples: DataFrame, frame: int, chunk: int = 1 << 16) -> DataFrame:
    """RMS of non-overlapping frames of ``frame`` samples (the last one may be short); exact over chunk ends.

    A chunk gives one row for each frame that it touches, its sum of squares, so samples are never rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, sr, k, x in zip(*(batch.column(c) for c in ("path", "sr", "chunk", "samples"))):
                x = x.values.to_numpy(zero_copy_only=False).astype(np.float64) if x.is_valid else np.zeros(0)
                at = (np.arange(len(x)) + k.as_py() * chunk) // frame
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                if len(starts):
                    sums, counts = np.add.reduceat(x * x, starts), np.diff(np.append(starts, len(x)))
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(starts)), pa.array([sr.as_py()] * len(starts), pa.int32()), pa.array(at[starts]), pa.array(sums), pa.array(counts)], ["path", "sr", "i", "e", "n"])

    parts = samples.select("path", "sr", "chunk", "samples").mapInArrow(run, "path string, sr int, i long, e double, n long")
    return parts.groupBy("path", "sr", "i").agg(F.sqrt(F.sum("e") / F.sum("n")).alias("rms"), F.sum("n").alias("n"))
