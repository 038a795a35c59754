"""Modes of a sensor from its mean spectrum: adaptive threshold, merging, selection of three, search bands."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from vibralake.operators.peaks import half_widths, local_peaks, prominences
from vibralake.schemas import GRID_HIGH, GRID_LOW, GRID_POINTS
from vibralake.session import ship

#: Wanted numbers of peaks, adjustments at most, their factors, the threshold that gives up.
LEAST_PEAKS, MOST_PEAKS, ADJUSTMENTS, RAISE, LOWER, GIVE_UP = 1, 5, 15, 1.5, 0.7, 1e-6
START_SHARE, MODES = 0.05, 3
#: Weights of low frequency and of amplitude in a mode's score, and the decay in Hz.
FREQUENCY_WEIGHT, AMPLITUDE_WEIGHT, DECAY = 0.7, 0.3, 10.0


@dataclass(frozen=True)
class Threshold:
    """What the adaptive search gives: the threshold whose peaks are used, the last one tried, adjustments made."""

    used: float
    last: float
    rounds: int


def adapt_threshold(height: np.ndarray, span: float, least: int = LEAST_PEAKS, most: int = MOST_PEAKS, rounds: int = ADJUSTMENTS) -> Threshold:
    """A prominence threshold that leaves least to most of the peaks with these prominences, or the first that comes closest."""
    now = span * START_SHARE
    used, gap = now, None
    for i in range(rounds):
        count = int((height >= now).sum())
        if least <= count <= most:
            return Threshold(now, now, i)
        far = min(abs(count - least), abs(count - most))
        if gap is None or far < gap:
            used, gap = now, far
        if count > most:
            now *= RAISE
        elif now < GIVE_UP:
            return Threshold(used, now, i)
        else:
            now *= LOWER
    return Threshold(used, now, rounds)


def merge_close(freq: np.ndarray, amp: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Indices of candidates (in order of frequency) that stay.

    The leftmost neighbours closer than their mean width lose the lower one (the right one of
    equals), then the search begins anew from the left.
    """
    left = list(range(len(freq)))
    i = 0
    while i + 1 < len(left):
        a, b = left[i], left[i + 1]
        if freq[b] - freq[a] < (width[a] + width[b]) / 2:
            left.pop(i + 1 if amp[a] >= amp[b] else i)
            i = 0
        else:
            i += 1
    return np.array(left, np.int64)


def mode_scores(freq: np.ndarray, amp: np.ndarray) -> np.ndarray:
    """What modes are chosen by: low frequency and large amplitude."""
    return FREQUENCY_WEIGHT * np.exp(-freq / DECAY) + AMPLITUDE_WEIGHT * amp / amp.max() if len(freq) else np.zeros(0)


def modes_of(mean: np.ndarray) -> dict[str, np.ndarray] | None:
    """The three modes of a mean spectrum on the common grid, padded with zeros; None without any peak."""
    peaks = local_peaks(mean)
    height, left, right = prominences(mean, peaks)
    good = height >= adapt_threshold(height, float(mean.max() - mean.min())).used
    peaks, height, left, right = peaks[good], height[good], left[good], right[good]
    if not len(peaks):
        return None
    begin, end = half_widths(mean, peaks, height, left, right)
    step = (GRID_HIGH - GRID_LOW) / (GRID_POINTS - 1)
    grid = np.linspace(GRID_LOW, GRID_HIGH, GRID_POINTS)
    kept = merge_close(grid[peaks], mean[peaks], (end - begin) * step)
    if len(kept) > MODES:
        score = mode_scores(grid[peaks[kept]], mean[peaks[kept]])
        kept = np.sort(kept[np.argsort(-score, kind="stable")[:MODES]])
    out = {"idx": np.full(MODES, -1, np.int64)} | {c: np.zeros(MODES) for c in ("freq", "amp", "prominence", "left_hz", "right_hz", "low", "high")}
    n = len(kept)
    out["idx"][:n], out["freq"][:n], out["amp"][:n], out["prominence"][:n] = peaks[kept], grid[peaks[kept]], mean[peaks[kept]], height[kept]
    out["left_hz"][:n], out["right_hz"][:n] = GRID_LOW + begin[kept] * step, GRID_LOW + end[kept] * step
    out["low"][:n], out["high"][:n] = np.maximum(GRID_LOW, out["left_hz"][:n]), np.minimum(GRID_HIGH, out["right_hz"][:n])
    return out


MODE_SCHEMA = "sensor_id string, mode_no int, idx bigint, freq double, amp double, prominence double, left_hz double, right_hz double, low double, high double"


def identify_modes(spectra: DataFrame) -> DataFrame:
    """Three rows for each sensor with modes, from (sensor_id, k, mean); a sensor without peaks has none.

    A group is one sensor's grid, so its size is fixed.
    """
    ship(spectra.sparkSession)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = modes_of(rows.sort_values("k")["mean"].to_numpy(np.float64))
        blank = {"idx": np.full(MODES, -1, np.int64)} | {c: np.zeros(MODES) for c in ("freq", "amp", "prominence", "left_hz", "right_hz", "low", "high")}
        table = pd.DataFrame({"sensor_id": [str(key[0])] * MODES, "mode_no": np.arange(1, MODES + 1, dtype=np.int32), **(found or blank)})
        return table if found else table.iloc[:0]

    return spectra.select("sensor_id", "k", "mean").groupBy("sensor_id").applyInPandas(run, MODE_SCHEMA)
