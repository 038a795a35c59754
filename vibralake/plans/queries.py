"""Queries of the waveform engine over the driver's tables, and their DuckDB SQL.

Two tables stand in for sensor data: events are static series (sensor = event_type, bucket = day of
ts), embeddings are waveforms (file = vec_id, sensor = label, samples at 100 Hz).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vibralake.functions import grids, names
from vibralake.operators import decode, features, modes, peaks, spectrum, tracking, validate
from vibralake.schemas import GRID_HIGH, GRID_LOW, GRID_POINTS
from vibralake.session import ship
from vibralake.sources import archives, sinks

KEYS, ORDER = ["sensor_id", "time"], ["ts", "event_id"]
NOISE_THRESHOLD = 5.0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", "ts", "value", F.col("event_type").alias("sensor_id"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("time"))


def _waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", F.col("label").cast("string").alias("sensor_id"), F.col("embedding").alias("v"))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.series_facts(_series(spark, sf_dir), KEYS, "ts", "value", ORDER)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def static_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = features.series_statistics(_series(spark, sf_dir), KEYS, "value", ["mean", "std", "min", "max", "ptp"])
    quality = validate.data_quality(_facts(spark, sf_dir)).select(*KEYS, "is_valid")
    return _rounded(stats.join(quality, KEYS).select("time", "sensor_id", "mean", "std", "min", "max", "ptp", "data_count", "is_valid"))


def accel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rounded(features.series_statistics(_series(spark, sf_dir), KEYS, "value"), 5)
    return rows.withColumns({c: F.col(c) + F.lit(0.0) for c in ("kurtosis", "skewness")})  # no negative zero


def _noise(method: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(features.noise_level(_series(spark, sf_dir), KEYS, "value", ORDER, method, NOISE_THRESHOLD))

    return query


def validate_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.data_quality(_facts(spark, sf_dir))
    return rows.select(*KEYS, "n", F.array_join("issues", ",").alias("issues"), F.array_join("warnings", ",").alias("warnings"), "is_valid")


def validate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.file_quality(_facts(spark, sf_dir)).select(*KEYS, F.array_join("problems", ",").alias("problems"))


def tracking_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.tracking_quality(_facts(spark, sf_dir)).select(*KEYS, "n", "is_valid")


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id and a file name: four good patterns and four bad ones."""
    e, ts = F.col("event_id"), F.col("ts")
    hour, minute = F.date_format(ts, "yyyyMMddHH"), F.date_format(ts, "yyyyMMddHHmm")
    shapes = [
        F.concat(F.lit("bmaps_"), (e % 9).cast("string"), F.lit("_DNA"), (e % 40).cast("string"), F.lit("_"), hour, F.lit(".zip")),
        F.concat(F.lit("bmaps_1_gcskyb01_"), minute, F.lit(".zip")),
        F.concat(F.lit("bmaps_5_gnss1_0_"), hour, F.lit(".zip")),
        F.concat(F.lit("smart_x_DNAGW"), (e % 7).cast("string"), F.lit("_99_1_"), hour, F.lit(".bin")),
        F.lit("a_b.bin"),
        F.lit("a_b_c_2024.bin"),
        F.lit("a_x_c_2024139901.bin"),
        F.lit("a_1_gw01_202413990100.bin"),
    ]
    name: Column = F.element_at(F.array(*shapes), (e % 8 + 1).cast("int"))
    return _table(spark, sf_dir, "events").select("event_id", name.alias("name"))


def parse_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).select("event_id", "name", names.parse_file_name(F.col("name")).alias("p")).select("event_id", "name", "p.*").fillna(-1, ["system_id_int"])


def classify_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _named(spark, sf_dir).select(names.parse_file_name(F.col("name"))["sensor_id"].alias("sensor_id")).filter("sensor_id is not null")
    return parsed.groupBy("sensor_id").agg(F.count("*").alias("files")).withColumn("kind", names.classify_sensor(F.col("sensor_id")))


def sensor_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten sensors by name; the limit is the report's."""
    return classify_sensor(spark, sf_dir).select("sensor_id", "files").orderBy("sensor_id").limit(10)


def processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _series(spark, sf_dir).groupBy("sensor_id").agg((F.count("*") * 7).alias("files"))
    return rows.withColumn("estimate", names.processing_time(F.col("files")))


def hour_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last hour of each sensor by order of path, which need not be chronological."""
    rows = _named(spark, sf_dir).select("name", names.parse_file_name(F.col("name")).alias("p")).filter("p.error is null")
    rows = rows.groupBy(F.col("p.sensor_id").alias("sensor_id")).agg(F.min("name").alias("first"), F.max("name").alias("last"))
    return rows.select("sensor_id", *[names.hour_title(names.parse_file_name(F.col(c))["hour"]).alias(a) for c, a in (("first", "start"), ("last", "end"))])


def disk_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(archives.disk_usage(_table(spark, sf_dir, "documents"), "n_chars"), 9)


def ingest_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive a sensor and day; members above 400 failed, and archives whose members all failed."""
    rows = _series(spark, sf_dir)
    status = rows.select(F.concat_ws("/", "sensor_id", F.col("time").cast("string")).alias("path"), F.col("event_id").cast("string").alias("member"), (F.col("value") <= 400).alias("ok"))
    return _rounded(archives.ingest_statistics(status))


def pending_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resume: days of sensors that have no value above 489 yet, by an anti-join."""
    rows = _series(spark, sf_dir)
    done = rows.filter("value > 489").select("sensor_id").distinct()
    return sinks.pending(rows, done).groupBy("sensor_id").agg(F.count("*").alias("rows"))


def bin_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select("event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint").alias("ms"), F.col("value").cast("float").alias("value"))
    back = decode.decode_rows(decode.encode_rows(rows, "ms", "value").select("event_id", "record"))
    return back.select("event_id", "t_ms", F.round(F.col("value").cast("double"), 4).alias("value"))


def _spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectrum.fft_amplitude(_waveforms(spark, sf_dir))


def fft_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spectra(spark, sf_dir).select("vec_id", "n", F.posexplode("amplitude").alias("k", "amplitude"))
    return _rounded(rows.select("vec_id", "k", grids.bin_frequency(F.col("k"), F.col("n")).alias("freq"), "amplitude"))


def band_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins from 3.125 Hz to 20 Hz, both ends included."""
    rows = _spectra(spark, sf_dir).select("vec_id", "n", F.posexplode("amplitude").alias("k", "a"))
    rows = rows.withColumn("freq", grids.bin_frequency(F.col("k"), F.col("n"))).filter("freq BETWEEN 3.125D AND 20D")
    return _rounded(rows.groupBy("vec_id").agg(F.count("*").alias("bins"), F.sum("a").alias("total"), F.min("freq").alias("low"), F.max("freq").alias("high")))


def band_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strongest frequency in three fixed bands, the last of which holds no bin; the lowest of equals."""
    rows = _spectra(spark, sf_dir).select("vec_id", "n", F.posexplode("amplitude").alias("k", "a"))
    rows = rows.withColumn("freq", grids.bin_frequency(F.col("k"), F.col("n")))
    best = lambda low, high: F.coalesce(F.max_by(F.when(F.col("freq").between(low, high), F.col("freq")), F.when(F.col("freq").between(low, high), F.struct(F.round("a", 9), -F.col("freq")))), F.lit(0.0))
    return rows.groupBy("vec_id").agg(*[best(a, b).alias(f"mode_{i}") for i, (a, b) in enumerate(((0.5, 10.0), (10.0, 30.0), (1.6, 3.0)), 1)])


def interp_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and first moment of each spectrum on the common grid."""
    rows = _spectra(spark, sf_dir).select("vec_id", F.posexplode(grids.on_grid(F.col("amplitude"), F.col("n"))).alias("k", "a"))
    return _rounded(rows.groupBy("vec_id").agg(F.count("*").alias("points"), F.sum("a").alias("total"), (F.sum(F.col("a") * F.col("k")) / GRID_POINTS).alias("moment")), 5)


def _average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectrum.average_spectrum(spectrum.fft_amplitude(_waveforms(spark, sf_dir).select("sensor_id", "v"), grid=True))


def avg_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_average(spark, sf_dir))


def _smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean spectra, rounded so that plateaus and ties occur on both sides of a comparison alike."""
    return _average(spark, sf_dir).select("sensor_id", "k", F.round("mean", 4).alias("mean"))


def local_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(peaks.peak_table(_smooth(spark, sf_dir)).select("sensor_id", "k", "height"))


def prominences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(peaks.peak_table(_smooth(spark, sf_dir)).select("sensor_id", "k", "prominence", "left_base", "right_base"))


def half_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(peaks.peak_table(_smooth(spark, sf_dir)).select("sensor_id", "k", "left_pos", "right_pos"))


def iterative_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adaptive threshold of each sensor, with the peaks that it leaves."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        y = rows.sort_values("k")["mean"].to_numpy(np.float64)
        height, _, _ = peaks.prominences(y, peaks.local_peaks(y))
        found = modes.adapt_threshold(height, float(y.max() - y.min()))
        return pd.DataFrame({"sensor_id": [key[0]], "threshold": [found.used], "peaks": [int((height >= found.used).sum())], "rounds": [found.rounds]})

    return _rounded(_smooth(spark, sf_dir).groupBy("sensor_id").applyInPandas(run, "sensor_id string, threshold double, peaks bigint, rounds int"))


def _modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.identify_modes(_smooth(spark, sf_dir))


def mode_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_modes(spark, sf_dir))


def search_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_modes(spark, sf_dir).select("sensor_id", "mode_no", "low", "high"))


def _dynamic(spark: SparkSession, sf_dir: str, found: DataFrame) -> DataFrame:
    hour = F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 3600).cast("timestamp_ntz")
    return tracking.track(_waveforms(spark, sf_dir).withColumn("time", hour), found)


def dynamic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_dynamic(spark, sf_dir, _modes(spark, sf_dir)))


def freq_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _modes(spark, sf_dir)
    return _rounded(tracking.frequency_trend(_dynamic(spark, sf_dir, found), found))


def natural_freqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural frequencies of sixteen waveforms each, one after the other: 1,024 samples."""
    parts = _waveforms(spark, sf_dir).groupBy(F.expr("vec_id DIV 16").alias("part")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "v"))).alias("all"))
    long = parts.select("part", F.flatten("all.v").alias("v"))

    def run(batches):
        for rows in batches:
            made = [spectrum.natural_frequencies(np.asarray(v, np.float64)) for v in rows["v"]]
            yield pd.DataFrame({"part": rows["part"], "freqs": [",".join(f"{f:.4f}" for f, _ in x) for x in made]})

    return long.mapInPandas(run, "part bigint, freqs string")


QUERIES = {
    f.__name__: f
    for f in (
        static_features, accel_stats, validate_data, validate_file, tracking_validity, parse_file_name, classify_sensor, sensor_file_counts,
        processing_time, hour_titles, disk_usage, ingest_statistics, pending_series, bin_roundtrip, fft_spectrum, band_filter, band_argmax,
        interp_grid, avg_spectrum, local_peaks, prominences, half_widths, iterative_peaks, mode_selection, search_bins, dynamic_features,
        freq_trend, natural_freqs,
    )
} | {f"noise_{m}": _noise(m) for m in features.NOISE_METHODS}

_SERIES = "s AS (SELECT event_id, ts, value AS v, event_type AS sensor_id, date_trunc('day', ts)::TIMESTAMP AS time, epoch_us(ts) / 1000.0 AS ms FROM events)"
_FACTS = f"""{_SERIES},
w AS (SELECT *, row_number() OVER win AS place, ms - lag(ms) OVER win AS step FROM s WINDOW win AS (PARTITION BY sensor_id, time ORDER BY ts, event_id)),
f AS (SELECT sensor_id, time, count(*) AS n, max(step) FILTER (place = 2) AS gap, bool_and(isfinite(v)) AS finite, min(v) AS low, max(v) AS high,
  coalesce(bool_and(step >= 0), true) AS sorted, count(DISTINCT ms) AS times FROM w GROUP BY sensor_id, time)"""
_ISSUES = "concat_ws(',', CASE WHEN gap = 0 THEN 'zero_time_delta' END, CASE WHEN NOT finite THEN 'non_finite_values' END, CASE WHEN NOT sorted THEN 'time_not_sorted' END)"
_AMPLITUDE = """x AS (SELECT vec_id, label, len(embedding) AS n, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS j FROM embeddings),
a AS (SELECT vec_id, label, n, k, sqrt(pow(sum(v * cos(2 * pi() * k * j / n)), 2) + pow(sum(v * sin(2 * pi() * k * j / n)), 2)) AS a
  FROM x, LATERAL (SELECT unnest(range(n // 2 + 1)) AS k) GROUP BY vec_id, label, n, k)"""
_GRID = f"""{_AMPLITUDE},
l AS (SELECT vec_id, label, n, list(a ORDER BY k) AS p FROM a GROUP BY vec_id, label, n),
q AS (SELECT vec_id, label, p, i AS k, ({GRID_LOW} + i * ({GRID_HIGH} - {GRID_LOW}) / {GRID_POINTS - 1}) * n / 100.0 AS pos FROM l, LATERAL (SELECT unnest(range({GRID_POINTS})) AS i)),
g AS (SELECT vec_id, label, k, CASE WHEN floor(pos) >= len(p) - 1 THEN p[len(p)] ELSE p[floor(pos)::INT + 1] + (p[floor(pos)::INT + 2] - p[floor(pos)::INT + 1]) * (pos - floor(pos)) END AS a FROM q)"""
_CURVE = f"""{_GRID},
y AS (SELECT label::VARCHAR AS sensor_id, k, round(avg(a), 4) AS y FROM g GROUP BY label, k),
r0 AS (SELECT *, CASE WHEN y = lag(y) OVER (PARTITION BY sensor_id ORDER BY k) THEN 0 ELSE 1 END AS fresh FROM y),
r1 AS (SELECT *, sum(fresh) OVER (PARTITION BY sensor_id ORDER BY k) AS run FROM r0),
r2 AS (SELECT sensor_id, run, min(y) AS y, min(k) AS k0, max(k) AS k1 FROM r1 GROUP BY sensor_id, run),
r3 AS (SELECT *, lag(y) OVER (PARTITION BY sensor_id ORDER BY run) AS before, lead(y) OVER (PARTITION BY sensor_id ORDER BY run) AS after FROM r2),
p AS (SELECT sensor_id, (k0 + k1) // 2 AS k, y FROM r3 WHERE y > before AND y > after)"""
_PROMINENCE = f"""{_CURVE},
e AS (SELECT p.sensor_id, p.k, p.y, coalesce(max(o.k) FILTER (o.k < p.k), -1) AS lo, coalesce(min(o.k) FILTER (o.k > p.k), {GRID_POINTS}) AS hi
  FROM p LEFT JOIN y o ON o.sensor_id = p.sensor_id AND o.y > p.y GROUP BY p.sensor_id, p.k, p.y),
m AS (SELECT e.sensor_id, e.k, e.y, min(o.y) FILTER (o.k <= e.k) AS lmin, min(o.y) FILTER (o.k >= e.k) AS rmin, lo, hi
  FROM e JOIN y o ON o.sensor_id = e.sensor_id AND o.k > e.lo AND o.k < e.hi GROUP BY e.sensor_id, e.k, e.y, lo, hi),
b AS (SELECT m.sensor_id, m.k, m.y, m.y - greatest(lmin, rmin) AS prominence, max(o.k) FILTER (o.k <= m.k AND o.y = lmin) AS left_base, min(o.k) FILTER (o.k >= m.k AND o.y = rmin) AS right_base
  FROM m JOIN y o ON o.sensor_id = m.sensor_id AND o.k > lo AND o.k < hi GROUP BY m.sensor_id, m.k, m.y, lmin, rmin)"""
_HALF = f"""{_PROMINENCE}, h AS (SELECT *, y - 0.5 * prominence AS h FROM b),
c0 AS (SELECT h.sensor_id, h.k, h.h, coalesce(max(o.k) FILTER (o.k <= h.k AND o.y <= h), any_value(left_base)) AS lk, coalesce(min(o.k) FILTER (o.k >= h.k AND o.y <= h), any_value(right_base)) AS rk
  FROM h JOIN y o ON o.sensor_id = h.sensor_id AND o.k BETWEEN left_base AND right_base GROUP BY h.sensor_id, h.k, h.h),
c1 AS (SELECT c0.sensor_id, c0.k, (CASE WHEN l0.y < h THEN lk + (h - l0.y) / (l1.y - l0.y) ELSE lk END)::DOUBLE AS left_pos, (CASE WHEN u0.y < h THEN rk - (h - u0.y) / (u1.y - u0.y) ELSE rk END)::DOUBLE AS right_pos
  FROM c0 JOIN y l0 ON l0.sensor_id = c0.sensor_id AND l0.k = lk JOIN y l1 ON l1.sensor_id = c0.sensor_id AND l1.k = lk + 1
  JOIN y u0 ON u0.sensor_id = c0.sensor_id AND u0.k = rk JOIN y u1 ON u1.sensor_id = c0.sensor_id AND u1.k = rk - 1)"""
_ADAPTED = """t0 AS (SELECT sensor_id, list(prominence) AS all_p FROM b GROUP BY sensor_id),
t1 AS (SELECT t0.sensor_id, all_p, 0 AS rounds, (SELECT (max(y.y) - min(y.y)) * 0.05 FROM y WHERE y.sensor_id = t0.sensor_id) AS threshold FROM t0
  UNION ALL SELECT sensor_id, all_p, rounds + 1, threshold * CASE WHEN len(list_filter(all_p, lambda v: v >= threshold)) > 5 THEN 1.5 ELSE 0.7 END FROM t1
  WHERE rounds < 14 AND len(list_filter(all_p, lambda v: v >= threshold)) NOT BETWEEN 1 AND 5),
t2 AS (SELECT *, len(list_filter(all_p, lambda v: v >= threshold)) AS peaks FROM t1),
t AS (SELECT * FROM t2 WHERE peaks BETWEEN 1 AND 5)"""
_STEP = (GRID_HIGH - GRID_LOW) / (GRID_POINTS - 1)
#: Merging goes on from a sensor's list of candidates until no neighbours are too close; then the best three by score, in order of frequency, padded.
_MODES = f"""{_HALF}, {_ADAPTED},
k0 AS (SELECT b.sensor_id, list({{'k': b.k, 'f': {GRID_LOW} + b.k * {_STEP}, 'a': b.y, 'p': b.prominence, 'l': {GRID_LOW} + left_pos * {_STEP}, 'r': {GRID_LOW} + right_pos * {_STEP}}} ORDER BY b.k) AS c
  FROM b JOIN c1 USING (sensor_id, k) JOIN t ON t.sensor_id = b.sensor_id AND b.prominence >= t.threshold GROUP BY b.sensor_id),
k1 AS (SELECT sensor_id, c, list_filter(range(1, len(c)), lambda i: c[i+1].f - c[i].f < (c[i].r - c[i].l + c[i+1].r - c[i+1].l) / 2)[1] AS j FROM k0
  UNION ALL SELECT sensor_id, d, list_filter(range(1, len(d)), lambda i: d[i+1].f - d[i].f < (d[i].r - d[i].l + d[i+1].r - d[i+1].l) / 2)[1]
  FROM (SELECT sensor_id, CASE WHEN c[j].a >= c[j+1].a THEN list_concat(c[1:j], c[j+2:]) ELSE list_concat(c[1:j-1], c[j+1:]) END AS d FROM k1 WHERE j IS NOT NULL)),
k2 AS (SELECT sensor_id, unnest(c) AS x FROM k1 WHERE j IS NULL),
k3 AS (SELECT sensor_id, x, row_number() OVER (PARTITION BY sensor_id ORDER BY 0.7 * exp(-x.f / 10) + 0.3 * x.a / top DESC, x.f) AS place
  FROM (SELECT *, max(x.a) OVER (PARTITION BY sensor_id) AS top FROM k2)),
k4 AS (SELECT sensor_id, x, row_number() OVER (PARTITION BY sensor_id ORDER BY x.f) AS mode_no FROM k3 WHERE place <= 3),
modes AS (SELECT s.sensor_id, s.mode_no::INT AS mode_no, coalesce(x.k, -1)::BIGINT AS idx, coalesce(x.f, 0)::DOUBLE AS freq, coalesce(x.a, 0)::DOUBLE AS amp, coalesce(x.p, 0)::DOUBLE AS prominence,
  coalesce(x.l, 0)::DOUBLE AS left_hz, coalesce(x.r, 0)::DOUBLE AS right_hz, (CASE WHEN x.k IS NULL THEN 0 ELSE greatest(x.l, {GRID_LOW}) END)::DOUBLE AS low, (CASE WHEN x.k IS NULL THEN 0 ELSE least(x.r, {GRID_HIGH}) END)::DOUBLE AS high
  FROM (SELECT sensor_id, unnest(range(1, 4)) AS mode_no FROM k0) s LEFT JOIN k4 ON k4.sensor_id = s.sensor_id AND k4.mode_no = s.mode_no)"""
_TRACK = f"""{_MODES},
v0 AS (SELECT a.vec_id, m.mode_no, m.freq AS ref, arg_max(k * 100.0::DOUBLE / n, (a.a, -k)) FILTER (k * 100.0 / n BETWEEN m.low AND m.high AND NOT (m.low = 0 AND m.high = 0)) AS f, a.label::VARCHAR AS sensor_id
  FROM a JOIN modes m ON m.sensor_id = a.label::VARCHAR GROUP BY a.vec_id, m.mode_no, m.freq, a.label),
v1 AS (SELECT vec_id, sensor_id, mode_no, ref, coalesce(f, 0)::DOUBLE AS f, to_timestamp(1704067200 + vec_id * 3600)::TIMESTAMP AS time FROM v0)"""
_NAMES = """n AS (SELECT event_id, CASE event_id % 8
  WHEN 0 THEN 'bmaps_' || (event_id % 9) || '_DNA' || (event_id % 40) || '_' || strftime(ts, '%Y%m%d%H') || '.zip'
  WHEN 1 THEN 'bmaps_1_gcskyb01_' || strftime(ts, '%Y%m%d%H%M') || '.zip'
  WHEN 2 THEN 'bmaps_5_gnss1_0_' || strftime(ts, '%Y%m%d%H') || '.zip'
  WHEN 3 THEN 'smart_x_DNAGW' || (event_id % 7) || '_99_1_' || strftime(ts, '%Y%m%d%H') || '.bin'
  WHEN 4 THEN 'a_b.bin' WHEN 5 THEN 'a_b_c_2024.bin' WHEN 6 THEN 'a_x_c_2024139901.bin' ELSE 'a_1_gw01_202413990100.bin' END AS name FROM events),
c AS (SELECT *, string_split(regexp_replace(name, '\\.[^.]*$', ''), '_') AS parts FROM n),
d AS (SELECT *, parts[-1] AS tail, try_strptime(rpad(parts[-1], 12, '0'), '%Y%m%d%H%M') AS t FROM c),
z AS (SELECT *, CASE WHEN len(parts) < 4 THEN 'fewer than 4 parts' WHEN NOT regexp_full_match(tail, '[0-9]{10}|[0-9]{12}') THEN 'time has not 10 or 12 digits' WHEN t IS NULL THEN 'no such time' END AS error FROM d)"""
_KIND = "CASE WHEN contains(upper(sensor_id), 'GW') THEN 'static' WHEN starts_with(sensor_id, 'DNA') THEN 'acceleration' ELSE 'unknown' END"
_DEVIATION = "pow(v - avg(v) OVER (PARTITION BY sensor_id, time), {0})"


def _noise_sql(level: str, extra: str = "") -> str:
    return f"WITH {_SERIES}{extra} SELECT sensor_id, time, round({level}, 6) AS noise_level FROM {'q' if extra else 's'} GROUP BY sensor_id, time"


SQL = {
    "static_features": f"""WITH {_FACTS} SELECT s.time, s.sensor_id, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max,
  round(max(v) - min(v), 6) AS ptp, count(*) AS data_count, any_value({_ISSUES} = '') AS is_valid FROM s JOIN f USING (sensor_id, time) GROUP BY s.time, s.sensor_id""",
    "accel_stats": f"""WITH {_SERIES}, q AS (SELECT *, {_DEVIATION.format(2)} AS d2, {_DEVIATION.format(3)} AS d3 FROM s)
SELECT sensor_id, time, round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std, round(min(v), 5) AS min, round(max(v), 5) AS max, round(median(v), 5) AS median, round(max(v) - min(v), 5) AS ptp,
  round(sqrt(avg(v * v)), 5) AS rms, round(coalesce(kurtosis_pop(v), 'nan'::DOUBLE), 5) + 0.0::DOUBLE AS kurtosis, round(coalesce(avg(d3) / nullif(pow(avg(d2), 1.5), 0), 'nan'::DOUBLE), 5) + 0.0::DOUBLE AS skewness, count(*) AS data_count
FROM q GROUP BY sensor_id, time""",
    "validate_data": f"""WITH {_FACTS} SELECT sensor_id, time, n, {_ISSUES} AS issues, concat_ws(',', CASE WHEN n > 400000 THEN 'too_many_records' WHEN n < 320000 THEN 'too_few_records' END,
  CASE WHEN gap <> 0 AND (gap < 9 OR gap > 11) THEN printf('abnormal_time_delta_%.2fms', gap) END, CASE WHEN low < -100 OR high > 100 THEN printf('out_of_range_[%.2f,%.2f]', low, high) END,
  CASE WHEN times < n THEN 'duplicate_timestamps' END) AS warnings, {_ISSUES} = '' AS is_valid FROM f""",
    "validate_file": f"""WITH {_FACTS} SELECT sensor_id, time, concat_ws(',', CASE WHEN n > 400000 THEN 'too_many_records' END, CASE WHEN n < 320000 THEN 'too_few_records' END, CASE WHEN gap = 0 THEN 'zero_time_delta' END,
  CASE WHEN gap <> 0 AND (gap < 9 OR gap > 11) THEN 'abnormal_time_delta' END, CASE WHEN NOT finite THEN 'non_finite_values' END, CASE WHEN low < -100 OR high > 100 THEN 'out_of_range' END,
  CASE WHEN NOT sorted THEN 'time_not_sorted' END) AS problems FROM f""",
    "tracking_validity": f"WITH {_FACTS} SELECT sensor_id, time, n, finite AND n < 400000 AND low > -100 AND high < 100 AS is_valid FROM f",
    "parse_file_name": f"""WITH {_NAMES} SELECT event_id, name, CASE WHEN error IS NULL THEN parts[1] END AS system, CASE WHEN error IS NULL THEN parts[2] END AS system_id,
  coalesce(CASE WHEN error IS NULL THEN try_cast(parts[2] AS INTEGER) END, -1)::INTEGER AS system_id_int, CASE WHEN error IS NULL THEN parts[3] END AS sensor_id, CASE WHEN error IS NULL THEN t END AS timestamp,
  CASE WHEN error IS NULL THEN date_trunc('hour', t)::TIMESTAMP END AS hour, error FROM z""",
    "classify_sensor": f"WITH {_NAMES} SELECT parts[3] AS sensor_id, count(*) AS files, any_value({_KIND.replace('sensor_id', 'parts[3]')}) AS kind FROM z WHERE error IS NULL GROUP BY parts[3]",
    "sensor_file_counts": f"WITH {_NAMES} SELECT parts[3] AS sensor_id, count(*) AS files FROM z WHERE error IS NULL GROUP BY parts[3] ORDER BY 1 LIMIT 10",
    "processing_time": f"""WITH {_SERIES}, q AS (SELECT sensor_id, count(*) * 7 AS files FROM s GROUP BY sensor_id), h AS (SELECT *, files / 3.0 AS seconds FROM q)
SELECT sensor_id, files, CASE WHEN seconds >= 3600 THEN floor(seconds / 3600)::INT || '시간 ' || floor((seconds - 3600 * floor(seconds / 3600)) / 60)::INT || '분' ELSE floor(seconds / 60)::INT || '분' END AS estimate FROM h""",
    "hour_titles": f"""WITH {_NAMES} SELECT parts[3] AS sensor_id, strftime(date_trunc('hour', min_by(t, name)), '%Y-%m-%d %H:00') AS start, strftime(date_trunc('hour', max_by(t, name)), '%Y-%m-%d %H:00') AS "end"
FROM z WHERE error IS NULL GROUP BY parts[3]""",
    "disk_usage": """SELECT round(sum(n_chars)::DOUBLE / 1073741824, 9) AS total_gb, round(sum(n_chars)::DOUBLE * 3.0 / 1073741824, 9) AS estimated_gb, count(n_chars) AS file_count,
  round(sum(n_chars)::DOUBLE / count(n_chars) / 1048576, 9) AS mean_mb FROM documents""",
    "ingest_statistics": f"""WITH {_SERIES}, q AS (SELECT sensor_id, time, bool_or(v <= 400) AS ok, count(*) AS bins, count(*) FILTER (v <= 400) AS good FROM s GROUP BY sensor_id, time)
SELECT count(*) AS total_zips, count(*) FILTER (ok) AS processed_zips, count(*) FILTER (NOT ok) AS failed_zips, sum(bins)::BIGINT AS total_bins, sum(good)::BIGINT AS processed_bins, (sum(bins) - sum(good))::BIGINT AS failed_bins,
  round(count(*) FILTER (ok) / count(*)::DOUBLE, 6) AS zip_success_rate, round(sum(good)::DOUBLE / sum(bins)::DOUBLE, 6) AS bin_success_rate FROM q""",
    "pending_series": f"WITH {_SERIES} SELECT sensor_id, count(*) AS rows FROM s WHERE sensor_id NOT IN (SELECT sensor_id FROM s WHERE v > 489) GROUP BY sensor_id",
    "bin_roundtrip": "SELECT event_id, epoch_us(ts) // 1000 AS t_ms, round(value::FLOAT::DOUBLE, 4) AS value FROM events",
    "fft_spectrum": f"WITH {_AMPLITUDE} SELECT vec_id, k::INT AS k, round(k * 100.0 / n, 6) AS freq, round(a, 6) AS amplitude FROM a",
    "band_filter": f"""WITH {_AMPLITUDE}, h AS (SELECT *, k * 100.0 / n AS freq FROM a) SELECT vec_id, count(*) AS bins, round(sum(a), 6) AS total, round(min(freq), 6) AS low, round(max(freq), 6) AS high
FROM h WHERE freq BETWEEN 3.125 AND 20 GROUP BY vec_id""",
    "band_argmax": f"""WITH {_AMPLITUDE}, h AS (SELECT vec_id, round(a, 9) AS a, k * 100.0::DOUBLE / n AS freq FROM a)
SELECT vec_id, coalesce(arg_max(freq, (a, -freq)) FILTER (freq BETWEEN 0.5 AND 10), 0)::DOUBLE AS mode_1, coalesce(arg_max(freq, (a, -freq)) FILTER (freq BETWEEN 10 AND 30), 0)::DOUBLE AS mode_2,
  coalesce(arg_max(freq, (a, -freq)) FILTER (freq BETWEEN 1.6 AND 3.0), 0)::DOUBLE AS mode_3 FROM h GROUP BY vec_id""",
    "interp_grid": f"WITH {_GRID} SELECT vec_id, count(*) AS points, round(sum(a), 5) AS total, round(sum(a * k) / {GRID_POINTS}, 5) AS moment FROM g GROUP BY vec_id",
    "avg_spectrum": f"""WITH {_GRID} SELECT label::VARCHAR AS sensor_id, k::INT AS k, round({GRID_LOW} + k * (({GRID_HIGH} - {GRID_LOW}) / {GRID_POINTS - 1}), 6) AS freq, round(avg(a), 6) AS mean,
  round(quantile_cont(a, 0.05), 6) AS p05, round(quantile_cont(a, 0.95), 6) AS p95 FROM g GROUP BY label, k""",
    "local_peaks": f"WITH {_CURVE} SELECT sensor_id, k, round(y, 6) AS height FROM p",
    "prominences": f"WITH {_PROMINENCE} SELECT sensor_id, k, round(prominence, 6) AS prominence, left_base, right_base FROM b",
    "half_widths": f"WITH {_HALF} SELECT sensor_id, k, round(left_pos, 6) AS left_pos, round(right_pos, 6) AS right_pos FROM c1",
    "iterative_peaks": f"WITH RECURSIVE {_PROMINENCE}, {_ADAPTED} SELECT sensor_id, round(threshold, 6) AS threshold, peaks, rounds FROM t",
    "mode_selection": f"""WITH RECURSIVE {_MODES} SELECT sensor_id, mode_no, idx, round(freq, 6) AS freq, round(amp, 6) AS amp, round(prominence, 6) AS prominence, round(left_hz, 6) AS left_hz,
  round(right_hz, 6) AS right_hz, round(low, 6) AS low, round(high, 6) AS high FROM modes""",
    "search_bins": f"WITH RECURSIVE {_MODES} SELECT sensor_id, mode_no, round(low, 6) AS low, round(high, 6) AS high FROM modes",
    "dynamic_features": f"""WITH RECURSIVE {_TRACK}, u AS (SELECT vec_id, max(v) - min(v) AS ptp, avg(v) AS mean, stddev_pop(v) AS std, sqrt(avg(v * v)) AS rms, count(*) AS n,
  bool_and(isfinite(v)) AND count(*) < 400000 AND min(v) > -100 AND max(v) < 100 AS ok FROM x GROUP BY vec_id)
SELECT time, sensor_id, round(any_value(ptp), 6) AS ptp, round(any_value(mean), 6) AS mean, round(any_value(std), 6) AS std, round(any_value(rms), 6) AS rms, NULL::DOUBLE AS noise_level, any_value(n) AS data_count,
  any_value(ok) AS is_valid, round(max(f) FILTER (mode_no = 1), 6) AS "1st_mode", round(max(f) FILTER (mode_no = 2), 6) AS "2nd_mode", round(max(f) FILTER (mode_no = 3), 6) AS "3rd_mode"
FROM v1 JOIN u USING (vec_id) GROUP BY vec_id, time, sensor_id""",
    "freq_trend": f"WITH RECURSIVE {_TRACK} SELECT sensor_id, time, mode_no, round(f, 6) AS freq, round(nullif(ref, 0), 6) AS ref_freq FROM v1 WHERE f > 0",
    "natural_freqs": """WITH e AS (SELECT vec_id // 16 AS part, vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS i FROM embeddings),
x AS (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id, i) - 1 AS j, count(*) OVER (PARTITION BY part) AS n FROM e),
a AS (SELECT part, n, k, sqrt(pow(sum(v * cos(2 * pi() * k * j / n)), 2) + pow(sum(v * sin(2 * pi() * k * j / n)), 2)) AS y
  FROM x, LATERAL (SELECT unnest(range(n // 2 + 1)) AS k) WHERE k * 100.0 / n BETWEEN 0.5 AND 20 AND n >= 1000 GROUP BY part, n, k),
b AS (SELECT *, lag(y) OVER w AS before, lead(y) OVER w AS after, max(y) OVER (PARTITION BY part) AS top FROM a WINDOW w AS (PARTITION BY part ORDER BY k)),
p AS (SELECT * FROM b WHERE y > before AND y > after),
q AS (SELECT p.part, p.n, p.k, p.y, p.top, coalesce(max(o.k) FILTER (o.k < p.k AND o.y > p.y), -1) AS lo, coalesce(min(o.k) FILTER (o.k > p.k AND o.y > p.y), 1000000) AS hi FROM p JOIN a o USING (part) GROUP BY p.part, p.n, p.k, p.y, p.top),
r AS (SELECT q.part, q.n, q.k, q.y, q.top, q.y - greatest(min(o.y) FILTER (o.k <= q.k), min(o.y) FILTER (o.k >= q.k)) AS prominence FROM q JOIN a o ON o.part = q.part AND o.k > lo AND o.k < hi GROUP BY q.part, q.n, q.k, q.y, q.top),
t AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY y DESC, k DESC) AS place FROM r WHERE prominence >= 0.1 * top)
SELECT d.part, coalesce(string_agg(printf('%.4f', t.k * 100.0::DOUBLE / t.n), ',' ORDER BY t.k), '') AS freqs FROM (SELECT DISTINCT part FROM e) d LEFT JOIN t ON t.part = d.part AND place <= 3 GROUP BY d.part""",
    "noise_full_std": _noise_sql("stddev_pop(v)"),
    "noise_snr": _noise_sql("coalesce(var_pop(v) / nullif(avg(v * v), 0), 0)"),
    "noise_static_std": _noise_sql(
        "CASE WHEN count(*) FILTER (quiet) > 10 THEN stddev_pop(v) FILTER (quiet) ELSE stddev_pop(v) END",
        f", q AS (SELECT *, coalesce(abs(lead(v) OVER (PARTITION BY sensor_id, time ORDER BY ts, event_id) - v) < {NOISE_THRESHOLD}, false) AS quiet FROM s)",
    ),
}
