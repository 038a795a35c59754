"""Second pass: each hour's strongest frequency inside a sensor's search bands, with statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.operators.modes import MODES
from vibralake.operators.spectrum import amplitude
from vibralake.operators.validate import tracking_valid
from vibralake.session import ship

_NUMBERS = ("ptp", "mean", "std", "rms")


def strongest(freq: np.ndarray, amp: np.ndarray, low: float, high: float) -> float:
    """Frequency of the largest amplitude in a band, both ends included; the lowest of equals; 0 without a bin or for the band (0, 0)."""
    if low == 0 and high == 0:
        return 0.0
    inside = np.flatnonzero((freq >= low) & (freq <= high))
    return float(freq[inside[np.argmax(amp[inside])]]) if len(inside) else 0.0


def bands_of(modes: DataFrame) -> DataFrame:
    """One row a sensor: sensor_id and bands, its (mode_no, low, high) in order."""
    return modes.groupBy("sensor_id").agg(F.array_sort(F.collect_list(F.struct("mode_no", "low", "high"))).alias("bands"))  # three each


def track(waveforms: DataFrame, modes: DataFrame) -> DataFrame:
    """Feature rows of the waveforms (time, sensor_id, v) of sensors with modes: ptp, mean, std, rms, noise_level, data_count, is_valid, 1st_mode to 3rd_mode.

    Every waveform gives a row: several of the same hour aren't joined. noise_level is always null.
    """
    ship(waveforms.sparkSession)
    joined = waveforms.select("time", "sensor_id", "v").join(bands_of(modes), "sensor_id").select("time", "sensor_id", "bands", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bands = batch.column(3), batch.column(2).to_pylist()
            out: dict[str, list] = {c: [] for c in (*_NUMBERS, "data_count", "is_valid", *range(MODES))}
            for i in range(batch.num_rows):
                v = values[i].values.to_numpy(zero_copy_only=False).astype(np.float64)
                freq, amp = amplitude(v)
                for name, value in zip(_NUMBERS, (v.max() - v.min(), v.mean(), v.std(), np.sqrt((v * v).mean())), strict=True):
                    out[name].append(float(value))
                out["data_count"].append(len(v))
                out["is_valid"].append(tracking_valid(v))
                for m in range(MODES):
                    out[m].append(strongest(freq, amp, bands[i][m]["low"], bands[i][m]["high"]))
            numbers = [pa.array(out[c], pa.float64()) for c in _NUMBERS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *numbers, pa.nulls(batch.num_rows, pa.float64()), pa.array(out["data_count"], pa.int64()), pa.array(out["is_valid"], pa.bool_()), *[pa.array(out[m], pa.float64()) for m in range(MODES)]],
                names=["time", "sensor_id", *_NUMBERS, "noise_level", "data_count", "is_valid", "1st_mode", "2nd_mode", "3rd_mode"],
            )

    schema = "time timestamp_ntz, sensor_id string, ptp double, mean double, std double, rms double, noise_level double, data_count bigint, is_valid boolean, `1st_mode` double, `2nd_mode` double, `3rd_mode` double"
    return joined.mapInArrow(run, schema)


def frequency_trend(dynamic: DataFrame, modes: DataFrame) -> DataFrame:
    """Points of the trend plot: sensor_id, time, mode_no, freq, ref_freq (null if it is 0); zero frequencies are left out."""
    names = ("1st_mode", "2nd_mode", "3rd_mode")
    points = dynamic.select("sensor_id", "time", F.posexplode(F.array(*[F.col(f"`{c}`") for c in names])).alias("place", "freq")).filter("freq > 0")
    points = points.select("sensor_id", "time", (F.col("place") + 1).alias("mode_no"), "freq")
    return points.join(modes.select("sensor_id", "mode_no", F.nullif("freq", F.lit(0.0)).alias("ref_freq")), ["sensor_id", "mode_no"], "left").select("sensor_id", "time", "mode_no", "freq", "ref_freq")
