import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vibralake.functions import grids, names
from vibralake.operators import decode, features, modes, peaks, spectrum, tracking, validate

SERIES = st.lists(st.integers(0, 6), min_size=1, max_size=40).map(lambda v: np.array(v, float))


def plain_peaks(y):
    """Peaks, prominences, bases and half widths by walking."""
    out, i = [], 1
    while i < len(y) - 1:
        j = i
        while j < len(y) - 1 and y[j + 1] == y[i]:
            j += 1
        if y[i - 1] < y[i] and j < len(y) - 1 and y[j + 1] < y[i]:
            p = (i + j) // 2
            bases = []
            for step in (-1, 1):
                k, best = p, p
                while 0 <= k < len(y) and y[k] <= y[p]:
                    if y[k] < y[best]:
                        best = k
                    k += step
                bases.append(best)
            height = y[p] - max(y[bases[0]], y[bases[1]])
            level, cross = y[p] - height / 2, []
            for step, base in zip((-1, 1), bases, strict=True):
                k = p
                while k != base and y[k] > level:
                    k += step
                cross.append(k - step * (level - y[k]) / (y[k - step] - y[k]) if y[k] < level else float(k))
            out.append((p, height, *bases, *cross))
        i = j + 1
    return out


@given(SERIES)
@settings(max_examples=400, deadline=None)
def test_peaks_equal_a_walk(y):
    p = peaks.local_peaks(y)
    height, left, right = peaks.prominences(y, p)
    begin, end = peaks.half_widths(y, p, height, left, right)
    wanted = plain_peaks(y)
    assert p.tolist() == [w[0] for w in wanted]
    assert np.allclose(height, [w[1] for w in wanted]) and left.tolist() == [w[2] for w in wanted] and right.tolist() == [w[3] for w in wanted]
    assert np.allclose(begin, [w[4] for w in wanted]) and np.allclose(end, [w[5] for w in wanted])


def test_distance_comes_before_prominence():
    y = np.array([0, 5, 4.9, 5.1, 0, 3, 0], float)
    assert peaks.find_peaks(y, 0.5)[0].tolist() == [3, 5]
    assert peaks.find_peaks(y, 0, 3)[0].tolist() == [3]
    with pytest.raises(ValueError):
        peaks.find_peaks(y, 0, 0)


def test_threshold_is_adapted():
    assert modes.adapt_threshold(np.array([10.0, 4, 3]), 10).rounds == 0
    raised = modes.adapt_threshold(np.linspace(1, 2, 8), 10)
    assert raised.rounds == 3 and math.isclose(raised.used, 0.5 * 1.5**3)
    lowered = modes.adapt_threshold(np.array([0.2]), 10)
    assert lowered.rounds == 3 and math.isclose(lowered.used, 0.5 * 0.7**3)
    none = modes.adapt_threshold(np.zeros(0), 0)
    assert none.rounds == 0 and none.used == 0
    stuck = modes.adapt_threshold(np.ones(9), 10)  # nine or none: nine first, none is closer
    assert stuck.rounds == 15 and (np.ones(9) >= stuck.used).sum() in (0, 9)


def test_merging_restarts_and_keeps_the_left_of_equals():
    f = np.array([1.0, 1.5, 2.0, 9.0])
    assert modes.merge_close(f, np.array([1.0, 1, 1, 1]), np.full(4, 0.6)).tolist() == [0, 2, 3]
    assert modes.merge_close(f, np.array([1.0, 3, 2, 1]), np.full(4, 0.6)).tolist() == [1, 3]
    assert modes.merge_close(f[:0], f[:0], f[:0]).tolist() == []


def test_modes_of_a_curve():
    x = np.linspace(0.5, 30, 2000)
    bump = lambda at, h: h * np.exp(-(((x - at) / 0.2) ** 2))
    two = modes.modes_of(bump(5, 1) + bump(12, 2))
    assert np.allclose(two["freq"][:2], [5, 12], atol=0.02) and two["freq"][2] == 0 and two["idx"][2] == -1 and two["low"][2] == two["high"][2] == 0
    five = modes.modes_of(sum(bump(f, 1 + f / 100) for f in (3, 8, 13, 18, 25)))
    assert np.allclose(five["freq"], [3, 8, 13], atol=0.02)
    assert modes.modes_of(np.ones(2000)) is None and modes.modes_of(np.full(2000, np.nan)) is None


def test_waveform_rules():
    t, v = np.arange(20) * 10, np.zeros(20, np.float32)
    assert validate.check_waveform(t, v) == ([], ["too_few_records"])
    assert validate.check_waveform(t[:0], v[:0]) == (["empty_data"], [])
    bad = validate.check_waveform(np.array([0, 0, 40, 30]), np.array([0, np.nan, 101, -5], np.float32))
    assert bad[0] == ["zero_time_delta", "non_finite_values", "time_not_sorted"] and "duplicate_timestamps" in bad[1]
    assert "abnormal_time_delta_20.00ms" in validate.check_waveform(t * 2, v)[1]
    assert validate.check_waveform(t, v + 100)[1] == ["too_few_records"] and not validate.tracking_valid(v + 100)
    assert validate.tracking_valid(v) and not validate.tracking_valid(v * np.nan)
    for n, name in ((320_000, None), (319_999, "too_few_records"), (400_000, None), (400_001, "too_many_records")):
        assert validate.check_waveform(np.arange(n) * 10, np.zeros(n, np.float32))[1] == ([name] if name else [])


def test_noise():
    v = np.concatenate([np.linspace(0, 0.05, 12), [5, 0, 5]])
    assert math.isclose(features.waveform_noise(v, "static_std", 0.01), np.std(v[:11]))  # eleven quiet steps
    assert math.isclose(features.waveform_noise(v[1:], "static_std", 0.01), np.std(v[1:]))  # ten are too few
    assert features.waveform_noise(np.ones(5), "snr", 0) == 0 and math.isclose(features.waveform_noise(v, "snr", 0), np.var(v) / np.mean(v * v))
    with pytest.raises(ValueError):
        features.waveform_noise(v, "other", 0)


def test_spectrum_and_bands():
    t = np.arange(2000) / 100
    v = np.sin(2 * np.pi * 7.5 * t) + 0.5 * np.sin(2 * np.pi * 3 * t)
    freq, amp = spectrum.amplitude(v)
    assert freq[np.argmax(amp)] == 7.5 and math.isclose((v**2).sum(), (amp[0] ** 2 + amp[-1] ** 2 + 2 * (amp[1:-1] ** 2).sum()) / 2000)
    assert tracking.strongest(freq, amp, 0, 0) == 0 and tracking.strongest(freq, amp, 7.5, 7.5) == 7.5 and tracking.strongest(freq, amp, 7.51, 7.54) == 0
    assert [round(f, 2) for f, _ in spectrum.natural_frequencies(v)] == [3.0, 7.5]
    assert spectrum.natural_frequencies(v[:64]) == [] and spectrum.natural_frequencies(v[:1]) == []


@given(st.lists(st.tuples(st.integers(-(10**12), 10**12), st.floats(width=32, allow_nan=False)), max_size=20), st.binary(max_size=11))
@settings(max_examples=100, deadline=None)
def test_records_round_trip(rows, tail):
    raw = decode.encode(np.array([t for t, _ in rows], np.int64), np.array([v for _, v in rows], np.float32))
    t, v = decode.decode(raw + tail)
    assert t.tolist() == [t for t, _ in rows] and v.tolist() == [np.float32(v) for _, v in rows]


def test_times_out_of_range_are_refused():
    with pytest.raises(ValueError):
        decode.decode(decode.encode(np.array([1 << 62]), np.array([0.0])))


def test_names(spark):
    wanted = {
        "x/bmaps_1_DNA22026_2024102901.zip": ("DNA22026", 1, "2024-10-29 01:00:00"),
        "bmaps_1_gcskyb01_202410251830.zip": ("gcskyb01", 1, "2024-10-25 18:00:00"),
        "bmaps_5_gnss1_0_2024102519.zip": ("gnss1", 5, "2024-10-25 19:00:00"),
        "bmaps_2_DNAGW22019_99_1_2025031704.bin": ("DNAGW22019", 2, "2025-03-17 04:00:00"),
        "a_b.bin": (None, None, "None"), "a_b_c_2024.bin": (None, None, "None"), "a_x_c_2024139901.bin": (None, None, "None"),
    }
    df = spark.createDataFrame([(p,) for p in wanted], "path string").select("path", names.parse_file_name(F.col("path")).alias("p"))
    found = {r["path"]: (r["p"]["sensor_id"], r["p"]["system_id_int"], str(r["p"]["hour"])) for r in df.collect()}
    assert found == wanted
    kinds = {"DNA22026": "acceleration", "DNAGW22019": "static", "gw01": "static", "dna1": "unknown", "gnss1": "unknown"}
    df = spark.createDataFrame([(k,) for k in kinds], "s string").select("s", names.classify_sensor(F.col("s")))
    assert dict(map(tuple, df.collect())) == kinds
    df = spark.createDataFrame([(10,), (10800,), (11000,)], "n int").select(names.processing_time(F.col("n")))
    assert [r[0] for r in df.collect()] == ["0분", "1시간 0분", "1시간 1분"]


def test_interpolation_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(n, rng.normal(size=n // 2 + 1).tolist()) for n in (1, 2, 3, 64, 1001)]
    df = spark.createDataFrame(rows, "n int, a array<double>").select("n", grids.on_grid(F.col("a"), F.col("n")).alias("g"))
    grid = np.linspace(0.5, 30, 2000)
    for n, g in map(tuple, df.collect()):
        a = dict(rows)[n]
        assert np.allclose(g, np.interp(grid, np.arange(n // 2 + 1) * 100 / n, a), atol=1e-9)


def test_long_rows_equal_waveforms(spark):
    """Built-in aggregates and array operations give the same, with a NaN and constant values among the series."""
    rng = np.random.default_rng(3)
    series = {"a": rng.normal(size=50), "b": np.ones(30), "c": np.array([1.0, np.nan, 3]), "d": np.array([2.0])}
    rows = [(s, i, float(x)) for s, v in series.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "s string, i int, v double")
    out = {r["s"]: r for r in features.series_statistics(df, ["s"], "v").collect()}
    for s, v in series.items():
        for name, value in features.waveform_statistics(v).items():
            if name in ("median",) and s == "c":
                continue
            assert np.isclose(out[s][name], value, equal_nan=True), (s, name)
    for method in features.NOISE_METHODS:
        levels = {r["s"]: r["noise_level"] for r in features.noise_level(df, ["s"], "v", ["i"], method, 0.5).collect()}
        assert all(np.isclose(levels[s], features.waveform_noise(series[s], method, 0.5)) for s in ("a", "b", "d"))
    with pytest.raises(ValueError):
        features.noise_level(df, ["s"], "v", ["i"], "other")
