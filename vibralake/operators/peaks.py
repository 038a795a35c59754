"""Peaks of sampled curves: local maxima, prominences, widths at half prominence, greedy distance.

A peak is a run of equal values with lower neighbours on both sides, placed at the middle of the run
(rounded down); a run at an end is none. Prominence: on each side, the least value before the curve
rises above the peak (or ends); the peak's height above the higher of the two. Width: at the peak
less half its prominence, between the crossings, linearly interpolated, inside the two bases.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def local_peaks(y: np.ndarray) -> np.ndarray:
    """Indices of peaks."""
    if len(y) < 3:
        return np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]]))  # of runs; a NaN is a run of its own
    stop = np.append(start[1:], len(y)) - 1
    level = y[start]
    inner = np.arange(1, len(start) - 1)
    top = inner[(level[inner] > level[inner - 1]) & (level[inner] > level[inner + 1])]
    return (start[top] + stop[top]) // 2


def prominences(y: np.ndarray, peaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prominences and both bases of peaks."""
    height, left, right = np.zeros(len(peaks)), np.zeros(len(peaks), np.int64), np.zeros(len(peaks), np.int64)
    for i, p in enumerate(peaks.tolist()):
        above = np.flatnonzero(y > y[p])
        at = np.searchsorted(above, p)
        low = above[at - 1] + 1 if at else 0
        high = above[at] if at < len(above) else len(y)
        before, after = y[low : p + 1], y[p:high]
        left[i] = p - int(np.argmin(before[::-1]))  # nearest to the peak
        right[i] = p + int(np.argmin(after))
        height[i] = y[p] - max(before.min(), after.min())
    return height, left, right


def half_widths(y: np.ndarray, peaks: np.ndarray, height: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Crossings left and right of peaks, as fractional indices."""
    begin, end = np.zeros(len(peaks)), np.zeros(len(peaks))
    for i, p in enumerate(peaks.tolist()):
        level = y[p] - 0.5 * height[i]
        down = np.flatnonzero(y[left[i] : p + 1] <= level)
        k = left[i] + (down[-1] if len(down) else 0)
        begin[i] = k + (level - y[k]) / (y[k + 1] - y[k]) if y[k] < level else k
        down = np.flatnonzero(y[p : right[i] + 1] <= level)
        k = p + down[0] if len(down) else right[i]
        end[i] = k - (level - y[k]) / (y[k - 1] - y[k]) if y[k] < level else k
    return begin, end


def apart(peaks: np.ndarray, amplitude: np.ndarray, distance: int) -> np.ndarray:
    """Whether each peak stays if, from the highest down, each removes its neighbours closer than distance."""
    kept = np.ones(len(peaks), bool)
    for i in np.argsort(amplitude, kind="stable")[::-1].tolist():
        if kept[i]:
            near = np.abs(peaks - peaks[i]) < distance
            near[i] = False
            kept[near] = False
    return kept


def find_peaks(y: np.ndarray, prominence: float, distance: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Peaks of at least this prominence, their prominences and bases; a distance applies first."""
    if distance is not None and distance < 1:
        raise ValueError("distance must be at least 1")
    peaks = local_peaks(y)
    if distance is not None:
        peaks = peaks[apart(peaks, y[peaks], distance)]
    height, left, right = prominences(y, peaks)
    good = height >= prominence
    return peaks[good], height[good], left[good], right[good]


PEAK_SCHEMA = "sensor_id string, k bigint, height double, prominence double, left_base bigint, right_base bigint, left_pos double, right_pos double"


def peak_table(spectra: DataFrame, column: str = "mean") -> DataFrame:
    """All peaks of each sensor's curve (sensor_id, k, column) with prominence, bases and half-prominence crossings.

    A group is one sensor's grid, so its size is fixed.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        y = rows.sort_values("k")[column].to_numpy(np.float64)
        peaks = local_peaks(y)
        height, left, right = prominences(y, peaks)
        begin, end = half_widths(y, peaks, height, left, right)
        return pd.DataFrame({"sensor_id": key[0], "k": peaks, "height": y[peaks], "prominence": height, "left_base": left, "right_base": right, "left_pos": begin, "right_pos": end})

    return spectra.select("sensor_id", "k", column).groupBy("sensor_id").applyInPandas(run, PEAK_SCHEMA)
