"""Validation rules. There are three, and they differ on purpose: data quality, file quality, and the tracking pass."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vibralake.schemas import FEW_RECORDS, MANY_RECORDS, VALUE_BOUND


def check_waveform(t_ms: np.ndarray, v: np.ndarray) -> tuple[list[str], list[str]]:
    """Issues and warnings of one decoded waveform."""
    if not len(v):
        return ["empty_data"], []
    issues, warnings = [], []
    if len(v) > MANY_RECORDS:
        warnings.append("too_many_records")
    elif len(v) < FEW_RECORDS:
        warnings.append("too_few_records")
    if len(v) >= 2:
        gap = float(t_ms[1] - t_ms[0])
        if gap == 0:
            issues.append("zero_time_delta")
        elif not 9 <= gap <= 11:
            warnings.append(f"abnormal_time_delta_{gap:.2f}ms")
    if not np.isfinite(v).all():
        issues.append("non_finite_values")
    low, high = float(v.min()), float(v.max())
    if low < -VALUE_BOUND or high > VALUE_BOUND:
        warnings.append(f"out_of_range_[{low:.2f},{high:.2f}]")
    if (np.diff(t_ms) < 0).any():
        issues.append("time_not_sorted")
    if len(np.unique(t_ms)) < len(t_ms):
        warnings.append("duplicate_timestamps")
    return issues, warnings


def tracking_valid(v: np.ndarray) -> bool:
    """The rule of the tracking pass: all finite, fewer than the most records, strictly within bounds."""
    return bool(len(v) and np.isfinite(v).all() and len(v) < MANY_RECORDS and -VALUE_BOUND < v.min() and v.max() < VALUE_BOUND)


def finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) != float("inf"))


def guarded(aggregate: Column, v: Column) -> Column:
    """An aggregate that is NaN if any value is, where the built-in one would rank NaN highest."""
    return F.when(F.bool_or(F.isnan(v)), F.lit(float("nan"))).otherwise(aggregate)


def series_facts(df: DataFrame, keys: list[str], time: str, value: str, order: list[str]) -> DataFrame:
    """What the rules need to know of each series of long rows: one window over the series, one aggregation on the same keys.

    Columns: keys, n, gap_ms, all_finite, low, high, in_order, n_times. NaN is above all other values in low and high.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    millis = (F.unix_micros(F.col(time).cast("timestamp")) / 1000).alias("ms")
    rows = df.select(*keys, *order, millis, F.col(value).cast("double").alias("v"))
    rows = rows.withColumns({"place": F.row_number().over(by), "step": F.col("ms") - F.lag("ms").over(by)})
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.max(F.when(F.col("place") == 2, F.col("step"))).alias("gap_ms"),
        F.bool_and(finite(F.col("v"))).alias("all_finite"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.coalesce(F.bool_and(F.col("step") >= 0), F.lit(True)).alias("in_order"),
        F.countDistinct("ms").alias("n_times"),
    )


def _flags(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(rule, F.lit(name) if isinstance(name, str) else name) for name, rule in rules.items()]))


def printed(template: str, *numbers: Column) -> Column:
    """The template filled as C's printf does: exact values, ties to even, nan and inf. (Java rounds ties up: 0.125 to 0.13.)"""

    def fill(*values: float | None) -> str | None:
        return None if None in values else template % values

    return F.udf(fill, "string")(*numbers)


def data_quality(facts: DataFrame) -> DataFrame:
    """facts with issues, warnings (arrays of names) and is_valid."""
    n, gap, low, high = (F.col(c) for c in ("n", "gap_ms", "low", "high"))
    issues = {"empty_data": n == 0, "zero_time_delta": gap == 0, "non_finite_values": ~F.col("all_finite"), "time_not_sorted": ~F.col("in_order")}
    named = [
        F.when(n > MANY_RECORDS, "too_many_records").when(n < FEW_RECORDS, "too_few_records"),
        F.when((gap != 0) & ((gap < 9) | (gap > 11)), printed("abnormal_time_delta_%.2fms", gap)),
        F.when((low < -VALUE_BOUND) | (high > VALUE_BOUND), printed("out_of_range_[%.2f,%.2f]", low, high)),
        F.when(F.col("n_times") < n, "duplicate_timestamps"),
    ]
    out = facts.withColumns({"issues": _flags(issues), "warnings": F.array_compact(F.array(*named))})
    return out.withColumn("is_valid", F.size("issues") == 0)


def file_quality(facts: DataFrame) -> DataFrame:
    """facts with problems: names of the file rule, which knows no warnings and no duplicates."""
    n, gap = F.col("n"), F.col("gap_ms")
    rules = {
        "empty": n == 0,
        "too_many_records": n > MANY_RECORDS,
        "too_few_records": (n > 0) & (n < FEW_RECORDS),
        "zero_time_delta": gap == 0,
        "abnormal_time_delta": (gap != 0) & ((gap < 9) | (gap > 11)),
        "non_finite_values": ~F.col("all_finite"),
        "out_of_range": (F.col("low") < -VALUE_BOUND) | (F.col("high") > VALUE_BOUND),
        "time_not_sorted": ~F.col("in_order"),
    }
    return facts.withColumn("problems", _flags(rules))


def tracking_quality(facts: DataFrame) -> DataFrame:
    """facts with is_valid by the tracking rule."""
    return facts.withColumn("is_valid", F.col("all_finite") & (F.col("n") < MANY_RECORDS) & (F.col("low") > -VALUE_BOUND) & (F.col("high") < VALUE_BOUND))
