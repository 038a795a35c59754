"""Statistics of series of long rows, as built-in aggregates, and of whole waveforms, as array operations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vibralake.operators.validate import guarded

NOISE_METHODS = ("static_std", "full_std", "snr")
#: A quiet part counts if it has more samples than this.
LEAST_QUIET = 10


def statistics(v: Column) -> dict[str, Column]:
    """mean, std (population), min, max, median, ptp, rms, kurtosis (excess) and skewness (both biased)."""
    nan = F.lit(float("nan"))
    return {
        "mean": F.avg(v),
        "std": F.stddev_pop(v),
        "min": guarded(F.min(v), v),
        "max": guarded(F.max(v), v),
        "median": guarded(F.median(v), v),
        "ptp": guarded(F.max(v) - F.min(v), v),
        "rms": F.sqrt(F.avg(v * v)),
        "kurtosis": F.coalesce(F.kurtosis(v), nan),
        "skewness": F.coalesce(F.skewness(v), nan),
    }


def series_statistics(df: DataFrame, keys: list[str], value: str, names: list[str] | None = None) -> DataFrame:
    """keys, the named statistics, data_count: partial aggregation, one shuffle on the keys."""
    made = statistics(F.col(value).cast("double"))
    return df.groupBy(*keys).agg(*[made[n].alias(n) for n in names or made], F.count("*").alias("data_count"))


def noise_level(df: DataFrame, keys: list[str], value: str, order: list[str], method: str = "static_std", threshold: float = 0.01) -> DataFrame:
    """keys, noise_level.

    static_std: standard deviation of the samples whose step to the next is below the threshold, if
    there are more than ten, else of all. full_std: of all. snr: variance by mean square, 0 without
    variance, infinite for a ratio that isn't positive.
    """
    if method not in NOISE_METHODS:
        raise ValueError(f"unknown noise method {method}")
    v = F.col("v")
    rows = df.select(*keys, *order, F.col(value).cast("double").alias("v"))
    if method == "full_std":
        return rows.groupBy(*keys).agg(F.stddev_pop("v").alias("noise_level"))
    if method == "snr":
        ratio = F.avg(v * v) / F.nullif(F.var_pop(v), F.lit(0.0))
        level = F.when(ratio > 0, 1 / ratio).when(ratio.isNotNull(), F.lit(float("inf"))).otherwise(0.0)
        return rows.groupBy(*keys).agg(level.alias("noise_level"))
    by = Window.partitionBy(*keys).orderBy(*order)
    quiet = F.coalesce(F.abs(F.lead("v").over(by) - v) < threshold, F.lit(False))
    rows = rows.withColumn("quiet", quiet)
    few = F.count_if("quiet") <= LEAST_QUIET
    return rows.groupBy(*keys).agg(F.when(few, F.stddev_pop("v")).otherwise(F.stddev_pop(F.when(F.col("quiet"), v))).alias("noise_level"))


def waveform_noise(v: np.ndarray, method: str, threshold: float) -> float:
    """The same for one waveform."""
    if method == "static_std":
        quiet = v[:-1][np.abs(np.diff(v)) < threshold]
        return float(np.std(quiet if len(quiet) > LEAST_QUIET else v))
    if method == "full_std":
        return float(np.std(v))
    if method != "snr":
        raise ValueError(f"unknown noise method {method}")
    variance = np.var(v)
    if not variance > 0:
        return 0.0
    ratio = np.mean(v * v) / variance
    return float(1 / ratio) if ratio > 0 else float("inf")


def waveform_statistics(v: np.ndarray) -> dict[str, float]:
    """Statistics of one waveform, in double precision."""
    v = v.astype(np.float64)
    mean, std = v.mean(), v.std()
    centred = v - mean
    with np.errstate(invalid="ignore", divide="ignore"):
        return {
            "mean": float(mean),
            "std": float(std),
            "min": float(v.min()),
            "max": float(v.max()),
            "median": float(np.median(v)),
            "ptp": float(v.max() - v.min()),
            "rms": float(np.sqrt((v * v).mean())),
            "kurtosis": float(np.float64((centred**4).mean()) / std**4 - 3),
            "skewness": float(np.float64((centred**3).mean()) / std**3),
        }
