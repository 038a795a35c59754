"""From archives to feature tables: static and acceleration sensors, fallback, failures, resume."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vibralake.functions.names import classify_sensor, hour_title, parse_file_name, sensor_dir
from vibralake.operators.features import waveform_noise, waveform_statistics
from vibralake.operators.modes import identify_modes
from vibralake.operators.spectrum import average_spectrum, fft_amplitude, natural_frequencies
from vibralake.operators.tracking import frequency_trend, track
from vibralake.operators.validate import check_waveform
from vibralake.schemas import DYNAMIC_COLUMNS, STATIC_COLUMNS, STATUS
from vibralake.session import ship
from vibralake.sources import archives, sinks

log = logging.getLogger(__name__)

_LIBRARY = ("mean", "std", "min", "max", "median", "ptp", "rms", "noise_level", "kurtosis", "skewness")
_STATIC = ("mean", "ptp", "noise_level", "min", "max")


@dataclass(frozen=True)
class FeatureOptions:
    """Options of the feature extractor."""

    low_hz: float = 0.5
    high_hz: float = 20.0
    n_peaks: int = 3
    prominence_ratio: float = 0.1
    noise_method: str = "static_std"
    noise_threshold: float = 0.01


def extract_features(waveforms: DataFrame, sensor_type: str = "acceleration", options: FeatureOptions = FeatureOptions()) -> DataFrame:
    """One row for each waveform with the library's columns; warnings is an extra one.

    acceleration: statistics and natural frequencies; static: mean, ptp, noise_level (standard
    deviation), min, max. Another type, or a waveform that fails, has nulls, is_valid false,
    data_count 0 and the error as its issue. Columns of waveforms: member, path, hour, file_size,
    sensor_id, t_ms, v.
    """

    ship(waveforms.sparkSession)

    def features(t: np.ndarray, v: np.ndarray) -> dict:
        if sensor_type not in ("acceleration", "static"):
            raise ValueError(f"unknown sensor type {sensor_type}")
        if not len(v):
            raise ValueError("empty_data")
        issues, warnings = check_waveform(t, v)
        out = waveform_statistics(v)
        freqs: list[tuple[float, float]] = []
        if sensor_type == "acceleration":
            out["noise_level"] = waveform_noise(v.astype(np.float64), options.noise_method, options.noise_threshold)
            freqs = natural_frequencies(v, options.low_hz, options.high_hz, options.n_peaks, options.prominence_ratio)
        else:
            out = {c: out["std"] if c == "noise_level" else out[c] for c in _STATIC}
        return {**out, "is_valid": not issues, "validation_issues": ",".join(issues), "warnings": ",".join(warnings), "data_count": len(v), "freqs": freqs}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                t, v = (batch.column(k)[i] for k in (5, 6))
                arrays = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0) for x in (t, v)]
                try:
                    rows.append(features(*arrays))
                except ValueError as error:
                    rows.append({"is_valid": False, "validation_issues": str(error), "warnings": "", "data_count": 0, "freqs": []})
            freqs = [[f for f, _ in r["freqs"]] for r in rows]
            columns = [pa.array([r.get(c) for r in rows], pa.float64()) for c in _LIBRARY]
            columns += [pa.array([r["is_valid"] for r in rows], pa.bool_()), pa.array([r["validation_issues"] for r in rows], pa.string()), pa.array([r["warnings"] for r in rows], pa.string()), pa.array([r["data_count"] for r in rows], pa.int64())]
            powers = [[a for _, a in r["freqs"]] for r in rows]
            columns += [*batch.columns[:5], pa.array(freqs, pa.list_(pa.float64())), pa.array(powers, pa.list_(pa.float64()))]
            names = [*_LIBRARY, "is_valid", "validation_issues", "warnings", "data_count", "sensor_id", "hour", "source_zip", "source_bin", "file_size", "natural_freqs", "natural_powers"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    numbers = ", ".join(f"{c} double" for c in _LIBRARY)
    schema = f"{numbers}, is_valid boolean, validation_issues string, warnings string, data_count bigint, sensor_id string, hour timestamp_ntz, source_zip string, source_bin string, file_size bigint, natural_freqs array<double>, natural_powers array<double>"
    made = waveforms.select("sensor_id", "hour", "path", "member", "file_size", "t_ms", "v").mapInArrow(run, schema)
    base = [c for c in _LIBRARY if sensor_type != "static" or c in _STATIC]
    return made.select(
        *base, "is_valid", "validation_issues", "data_count", "sensor_id", "hour", "source_zip", "source_bin", "file_size",
        *[F.get("natural_freqs", F.lit(i)).alias(f"freq_{i + 1}") for i in range(3)], "warnings", "natural_freqs", "natural_powers",
    )


def static_features(waveforms: DataFrame) -> DataFrame:
    """Rows of static sensors; the sensor is the folder's name. A waveform that fails has nulls and data_count 0."""
    rows = waveforms.select("path", "member", "hour", "file_size", "t_ms", "v", F.col("sensor_dir").alias("sensor_id"))
    made = extract_features(rows, "static").withColumns({"time": F.col("hour"), "std": F.col("noise_level")})
    return made.select(*STATIC_COLUMNS)


@dataclass
class Result:
    """Everything a run gives; tables are lazy."""

    static: DataFrame
    dynamic: DataFrame
    modes: DataFrame
    average: DataFrame
    trend: DataFrame
    failed: DataFrame
    titles: DataFrame


def analyse(waveforms: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> Result:
    """Static and acceleration features of decoded waveforms. keep may store what several results are made of (avg_spectrum, modes, dynamic_features).

    Acceleration and unknown sensors go through the two passes; unknown ones without modes become
    static, acceleration ones without modes are failed. One NaN sample makes a sensor's mean
    spectrum NaN, so it has no modes.
    """
    typed = waveforms.withColumn("kind", classify_sensor(F.col("sensor_dir")))
    moving = typed.filter("kind <> 'static'").select("path", "kind", F.col("sensor_dir").alias("sensor_id"), F.col("hour").alias("time"), "v")
    spectra = fft_amplitude(moving.select("sensor_id", "v"), grid=True)
    average = keep(average_spectrum(spectra), "avg_spectrum")
    modes = keep(identify_modes(average), "modes")
    found = modes.select("sensor_id").distinct()
    dynamic = keep(track(moving, modes).select(*[F.col(f"`{c}`") for c in DYNAMIC_COLUMNS]), "dynamic_features")
    missing = typed.filter("kind <> 'static'").join(found, typed["sensor_dir"] == found["sensor_id"], "left_anti")
    still = typed.filter("kind = 'static'").unionByName(missing.filter("kind = 'unknown'"))
    failed = missing.filter("kind = 'acceleration'").select(F.col("sensor_dir").alias("sensor_id"), F.lit("no modes were found").alias("reason")).distinct()
    titles = moving.groupBy("sensor_id").agg(F.min("path").alias("first"), F.max("path").alias("last"), F.countDistinct("path").alias("file_count"))
    hour = lambda c: hour_title(parse_file_name(F.col(c))["hour"])
    titles = titles.select("sensor_id", hour("first").alias("start"), hour("last").alias("end"), "file_count")
    return Result(static_features(still), dynamic, modes, average, frequency_trend(dynamic, modes), failed, titles)


def process(spark: SparkSession, root: str, target: str, format: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Run over all sensors below root that target doesn't have yet; returns the run's ingest status.

    Finished sensors are known from the table `finished`, which is written last, and their files
    aren't opened. target gets status, waveforms, static_features, dynamic_features (in the format
    given), modes, avg_spectrum, freq_trend and titles, all partitioned by sensor, so those of
    sensors that were finished before stay; and failed_sensors, which a run writes anew, as failed
    sensors are taken up again. A run that dies leaves no mark, and its sensors are done again.
    """
    files = archives.sensor_folders(archives.find_archives(spark, f"{root.rstrip('/')}/*", recursive=False))
    pending = sinks.pending(files.select("path", F.col("sensor_dir").alias("sensor_id")), sinks.finished_sensors(spark, f"{target}/finished"))
    if max_files:
        pending = pending.orderBy("path").limit(max_files)
    chosen = pending.groupBy("sensor_id").agg(F.collect_list("path").alias("paths") if max_files else F.min("path").alias("path")).collect()  # a row a sensor
    sensors = sorted(r["sensor_id"] for r in chosen)
    if not sensors:
        return spark.createDataFrame([], STATUS)
    paths = sorted(p for r in chosen for p in r["paths"]) if max_files else sorted(r["path"].rsplit("/", 1)[0] for r in chosen)
    members = archives.read_members(spark, [archives._literal(p) for p in paths], recursive=False)
    members = members.withColumn("sensor_id", sensor_dir(F.col("path")))
    sinks.write_sensors(members, f"{target}/waveforms")  # decoded once, then both passes read it
    members = sinks.read_sensors(spark, f"{target}/waveforms", members.schema, sensors)
    status = archives.ingest_status(members)
    sinks.write_sensors(status.withColumn("sensor_id", sensor_dir(F.col("path"))), f"{target}/status")
    counts = archives.ingest_statistics(status).first()
    log.info("%d sensors: %s", len(sensors), counts.asDict())

    def keep(rows: DataFrame, name: str) -> DataFrame:
        if name == "dynamic_features":
            sinks.write_features(rows, f"{target}/{name}", format)
            if format != "parquet":
                return rows
        else:
            sinks.write_sensors(rows, f"{target}/{name}")
        return sinks.read_sensors(spark, f"{target}/{name}", rows.schema, sensors).select(*[F.col(f"`{c}`") for c in rows.columns])

    result = analyse(archives.waveforms(members.drop("sensor_id")), keep)
    sinks.write_features(result.static, f"{target}/static_features", format)
    sinks.write_sensors(result.trend, f"{target}/freq_trend", ("time", "mode_no"))
    sinks.write_sensors(result.titles, f"{target}/titles")
    result.failed.write.mode("overwrite").parquet(f"{target}/failed_sensors")
    failed = spark.read.schema(result.failed.schema).parquet(f"{target}/failed_sensors")
    done = spark.createDataFrame([(s,) for s in sensors], "sensor_id string").join(failed, "sensor_id", "left_anti")
    if max_files is None:  # a sensor of which some files were left out isn't finished
        sinks.write_sensors(done.select("sensor_id", F.lit(counts["processed_bins"]).alias("members_of_run")), f"{target}/finished")
    for row in failed.collect():  # a row a sensor
        log.warning("%s failed: %s", row["sensor_id"], row["reason"])
    return sinks.read_sensors(spark, f"{target}/status", f"{STATUS}, sensor_id string", sensors).drop("sensor_id")
