"""Scalar functions over names, sizes and times; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def sensor_dir(path: Column) -> Column:
    """Name of the folder that holds a file."""
    return F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 2)


def parse_file_name(path: Column) -> Column:
    """struct(system, system_id, system_id_int, sensor_id, timestamp, hour, error) of <system>_<id>_<sensor>[_...]_<time>.

    The time has ten digits (to the hour) or twelve (to the minute). A name with fewer than four
    parts or without a valid time has an error and is otherwise null.
    """
    parts = F.split(stem(path), "_")
    last = F.element_at(parts, -1)
    time = F.when(
        last.rlike(r"^\d{10}$"), F.try_to_timestamp(F.concat(last, F.lit("00")), F.lit("yyyyMMddHHmm"))
    ).when(last.rlike(r"^\d{12}$"), F.try_to_timestamp(last, F.lit("yyyyMMddHHmm")))
    error = F.when(F.size(parts) < 4, "fewer than 4 parts").when(~last.rlike(r"^(\d{10}|\d{12})$"), "time has not 10 or 12 digits").when(time.isNull(), "no such time")
    good = lambda c: F.when(error.isNull(), c)
    return F.struct(
        good(F.get(parts, F.lit(0))).alias("system"),
        good(F.get(parts, F.lit(1))).alias("system_id"),
        good(F.get(parts, F.lit(1)).try_cast("int")).alias("system_id_int"),
        good(F.get(parts, F.lit(2))).alias("sensor_id"),
        good(time.cast("timestamp_ntz")).alias("timestamp"),
        good(F.date_trunc("hour", time).cast("timestamp_ntz")).alias("hour"),
        error.alias("error"),
    )


def classify_sensor(sensor_id: Column) -> Column:
    """static if the name contains GW in any case, acceleration if it starts with DNA in upper case, else unknown."""
    return F.when(F.contains(F.upper(sensor_id), F.lit("GW")), "static").when(F.startswith(sensor_id, F.lit("DNA")), "acceleration").otherwise("unknown")


def processing_time(files: Column, per_second: float = 3.0) -> Column:
    """Estimate as text: hours and minutes, or minutes below an hour."""
    seconds = files / F.lit(per_second)
    hours = F.floor(seconds / 3600)
    minutes = F.floor((seconds - hours * 3600) / 60)
    return F.when(hours > 0, F.format_string("%d시간 %d분", hours, minutes)).otherwise(F.format_string("%d분", minutes))


def hour_title(hour: Column) -> Column:
    """Hour as in titles; N/A where there is none."""
    return F.coalesce(F.date_format(hour, "yyyy-MM-dd HH:00"), F.lit("N/A"))
