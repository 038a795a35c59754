"""Amplitude spectra of waveforms, on their own bins and on the common grid, and their statistics by sensor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.operators.peaks import find_peaks
from vibralake.operators.validate import guarded
from vibralake.schemas import GRID_HIGH, GRID_LOW, GRID_POINTS, SAMPLING_RATE
from vibralake.session import ship


def amplitude(v: np.ndarray, rate: float = SAMPLING_RATE) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and magnitudes of the real transform: no window, no detrending, no scaling."""
    return np.arange(len(v) // 2 + 1) * rate / max(len(v), 1), np.abs(np.fft.rfft(v.astype(np.float64)))


def fft_amplitude(df: DataFrame, column: str = "v", out: str = "amplitude", grid: bool = False) -> DataFrame:
    """df without column, with the spectrum of column (and n, its number of samples) instead; grid: at the common grid's points."""
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != column]
    points = np.linspace(GRID_LOW, GRID_HIGH, GRID_POINTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, n = [], []
            values = batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                v = values[i].values.to_numpy(zero_copy_only=False) if values[i].is_valid else np.zeros(0)
                n.append(len(v))
                if not len(v):
                    made.append(np.zeros(0))
                    continue
                freq, amp = amplitude(v)
                made.append(np.interp(points, freq, amp) if grid else amp)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(made, pa.list_(pa.float64()))], names=[*keep, "n", out])

    kinds = dict(df.dtypes)
    fields = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return df.select(*keep, column).mapInArrow(run, f"{fields}n bigint, `{out}` array<double>")


def average_spectrum(spectra: DataFrame, column: str = "amplitude") -> DataFrame:
    """(sensor_id, k, freq, mean, p05, p95) over all waveforms of a sensor; one NaN makes a point NaN."""
    rows = spectra.select("sensor_id", F.posexplode(column).alias("k", "a"))
    a = F.col("a")
    rows = rows.groupBy("sensor_id", "k").agg(
        F.avg(a).alias("mean"), guarded(F.percentile(a, F.lit(0.05)), a).alias("p05"), guarded(F.percentile(a, F.lit(0.95)), a).alias("p95")
    )
    step = (GRID_HIGH - GRID_LOW) / (GRID_POINTS - 1)
    return rows.select("sensor_id", "k", (F.lit(GRID_LOW) + F.col("k") * F.lit(step)).alias("freq"), "mean", "p05", "p95")


def natural_frequencies(v: np.ndarray, low: float = 0.5, high: float = 20.0, most: int = 3, ratio: float = 0.1) -> list[tuple[float, float]]:
    """The largest peaks in a band, at least 0.1 Hz apart, in order of frequency: (frequency, amplitude) pairs.

    Fewer than two bins in the band, or bins wider than 0.1 Hz, give none.
    """
    freq, amp = amplitude(v)
    inside = (freq >= low) & (freq <= high)
    freq, amp = freq[inside], amp[inside]
    if len(freq) < 2 or int(0.1 / (freq[1] - freq[0])) < 1:
        return []
    peaks, *_ = find_peaks(amp, amp.max() * ratio, int(0.1 / (freq[1] - freq[0])))
    top = peaks[np.argsort(amp[peaks], kind="stable")[::-1][:most]]
    return [(float(freq[p]), float(amp[p])) for p in np.sort(top)]
