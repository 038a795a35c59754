import io
import zipfile

import numpy as np
import pytest

from vibralake.operators.decode import encode
from vibralake.plans import pipeline
from vibralake.sources import archives, sinks
from vibralake.streaming import ingest

HOUR = 1704067200000


def signal(tones, n=2000, seed=0, noise=0.02):
    t = np.arange(n) / 100
    return sum(a * np.sin(2 * np.pi * f * t) for f, a in tones) + np.random.default_rng(seed).normal(0, noise, n)


def put(folder, name, members):
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, raw in members.items():
            archive.writestr(member, raw)


def raw(v, start=HOUR):
    return encode(start + np.arange(len(v)) * 10, v)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("data") / "upload"
    for h in range(4):
        name = f"20240101{h:02d}"
        put(top / "DNA1", f"b_1_DNA1_{name}.zip", {f"b_1_DNA1_{name}.bin": raw(signal([(5, 1), (12, 1)], seed=h), HOUR + h * 3600_000)})
        put(top / "DNAGW1", f"b_1_DNAGW1_{name}.zip", {f"x/b_1_DNAGW1_{name}.bin": raw(np.full(30, 20.0 + h))})
        put(top / "gnss1", f"b_1_gnss1_{name}.zip", {f"b_1_gnss1_{name}.bin": raw(np.full(50, 3.0))})
        put(top / "DNA2", f"b_1_DNA2_{name}.zip", {f"b_1_DNA2_{name}.bin": raw(np.full(50, 3.0))})
    nan = signal([(5, 1)])
    nan[7] = np.nan
    put(top / "DNA3", "b_1_DNA3_2024010100.zip", {"b_1_DNA3_2024010100.bin": raw(nan), "b_1_DNA3_2024010101.bin": raw(signal([(5, 1)]))})
    put(top / "gnss2", "b_1_gnss2_2024010100.zip", {"b_1_gnss2_2024010100.bin": raw(signal([(4, 1)])), "b_1_gnss2_202401010030.bin": raw(signal([(4, 1)], seed=1))})
    put(top / "DNA1", "b_1_DNA1_2024010105.zip", {"b_1_DNA1_2024010105.BIN": b"", "readme.txt": b""})
    put(top / "DNA1", "b_1_DNA1_2024010106.zip", {"bad_name.bin": raw(np.ones(3)), "b_1_DNA1_2024010106.bin": b"12345", "b_1_DNA1_2024010107.bin": encode(np.array([1 << 62]), np.array([1.0]))})
    (top / "DNA1" / "b_1_DNA1_2024010109.zip").write_bytes(b"not a zip")
    put(top / "analysis_results_x", "b_1_DNA9_2024010100.zip", {"b_1_DNA9_2024010100.bin": raw(np.ones(5))})
    put(top / ".hidden", "b_1_DNA8_2024010100.zip", {"b_1_DNA8_2024010100.bin": raw(np.ones(5))})
    return str(top)


def test_catalog(spark, root):
    files = archives.sensor_folders(archives.find_archives(spark, f"{root}/*", recursive=False))
    assert {r["sensor_dir"] for r in files.collect()} == {"DNA1", "DNA2", "DNA3", "DNAGW1", "gnss1", "gnss2"}
    assert archives.find_archives(spark, root).count() == files.count() + 1
    catalog = archives.file_catalog(files).collect()
    assert len(catalog) == files.count() and {r["system"] for r in catalog} == {"b"}
    usage = archives.disk_usage(files).first()
    assert usage["file_count"] == files.count() and usage["estimated_gb"] == usage["total_gb"] * 3
    assert archives.disk_usage(files.limit(0)).first()["mean_mb"] == 0
    info = {r["name"]: r for r in archives.archive_info(spark, root).collect()}
    assert info["b_1_DNAGW1_2024010100.zip"]["bin_files"] == ["x/b_1_DNAGW1_2024010100.bin"] and info["b_1_DNAGW1_2024010100.zip"]["total_uncompressed"] == 360
    assert info["b_1_DNA1_2024010105.zip"]["ratio"] is None and "b_1_DNA1_2024010109.zip" not in info
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        archives.find_archives(spark, f"{root}/none").count()


def test_members_and_status(spark, root):
    members = archives.read_members(spark, f"{root}/*", recursive=False).cache()
    status = archives.ingest_status(members)
    bad = {(r["path"].rsplit("/", 1)[1], r["member"]): r["error"] for r in status.filter("not ok").collect()}
    assert len(bad) == 5 and bad[("b_1_DNA1_2024010105.zip", None)] == "no binary members"
    assert bad[("b_1_DNA1_2024010106.zip", "bad_name.bin")] == "fewer than 4 parts" and bad[("b_1_DNA1_2024010106.zip", "b_1_DNA1_2024010106.bin")] == "no records"
    sums = archives.ingest_statistics(status).first()
    assert (sums["total_zips"], sums["failed_zips"], sums["total_bins"], sums["failed_bins"]) == (21, 3, 23, 3)
    waves = archives.waveforms(members)
    assert waves.count() == 20 and waves.filter("sensor_dir = 'gnss2'").select("hour").distinct().count() == 1
    assert archives.read_members(spark, f"{root}/*", recursive=False, max_files=3).select("path").distinct().count() == 3
    with pytest.raises(ValueError):
        archives.read_members(spark, root, mode="other")


def test_bare_files(spark, tmp_path, caplog):
    (tmp_path / "S").mkdir()
    (tmp_path / "S" / "b_1_S_2024010100.bin").write_bytes(raw(np.arange(5.0)) + b"xyz")
    path = str(tmp_path / "S")
    assert [tuple(r) for r in archives.decode_bin_file(spark, path).orderBy("seq").collect()][2] == (2, HOUR + 20, 2.0)
    rows = archives.waveforms(archives.read_members(spark, path, pattern="*.bin", bins=True)).collect()
    assert len(rows) == 1 and rows[0]["n_records"] == 5 and rows[0]["sensor_id"] == "S"
    assert archives.find_bins(spark, path).count() == 1
    with caplog.at_level("WARNING"):
        archives.decode_bin_file(spark, path, check=True)
    assert "63 bytes are no whole number of records" in caplog.text and "too_few_records" in caplog.text


def test_features_of_the_library(spark, root):
    waves = archives.waveforms(archives.read_members(spark, f"{root}/*", recursive=False))
    rows = {(r["sensor_id"], r["source_bin"]): r for r in pipeline.extract_features(waves).collect()}
    dna = rows[("DNA1", "b_1_DNA1_2024010100.bin")]
    assert np.allclose([dna["freq_1"], dna["freq_2"]], [5, 12], atol=0.06) and dna["is_valid"] and dna["data_count"] == 2000
    assert len(dna["natural_powers"]) == len(dna["natural_freqs"])
    assert rows[("DNA3", "b_1_DNA3_2024010100.bin")]["validation_issues"] == "non_finite_values"
    static = pipeline.extract_features(waves, "static").filter("sensor_id = 'DNAGW1'").first()
    assert static["noise_level"] == 0 and static["freq_1"] is None and "median" not in static
    other = pipeline.extract_features(waves, "other").first()
    assert other["mean"] is None and other["data_count"] == 0 and not other["is_valid"] and "unknown sensor type" in other["validation_issues"]


def test_whole_run_and_resume(spark, root, tmp_path):
    target = str(tmp_path / "out")
    pipeline.process(spark, root, target)
    dynamic = spark.read.parquet(f"{target}/dynamic_features")
    static = spark.read.parquet(f"{target}/static_features")
    assert {r[0] for r in dynamic.select("sensor_id").distinct().collect()} == {"DNA1", "gnss2"}
    assert {r[0] for r in static.select("sensor_id").distinct().collect()} == {"DNAGW1", "gnss1"}
    assert {r[0] for r in spark.read.parquet(f"{target}/failed_sensors").select("sensor_id").collect()} == {"DNA2", "DNA3"}
    first = dynamic.filter("sensor_id = 'DNA1'").orderBy("time").collect()
    assert len(first) == 4 and all(np.isclose(r["1st_mode"], 5, atol=0.06) and np.isclose(r["2nd_mode"], 12, atol=0.06) and r["is_valid"] and r["noise_level"] is None for r in first)
    assert dynamic.filter("sensor_id = 'gnss2'").count() == 2  # two files of an hour are two rows
    assert static.filter("sensor_id = 'DNAGW1'").orderBy("time").first()["mean"] == 20.0
    trend = spark.read.parquet(f"{target}/freq_trend")
    assert trend.filter("freq <= 0").count() == 0
    titles = {r["sensor_id"]: r for r in spark.read.parquet(f"{target}/titles").collect()}
    assert titles["DNA1"]["start"] == "2024-01-01 00:00" and titles["DNA1"]["end"] == "2024-01-01 03:00"
    status = spark.read.parquet(f"{target}/status")
    assert status.count() == 25 and status.filter("not ok").count() == 5


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_resume_keeps_what_is_finished_and_reads_only_new_files(spark, tmp_path, format):
    top, target = tmp_path / "upload", str(tmp_path / "out")
    names = ["waveforms", "status", "modes", "avg_spectrum", "freq_trend", "titles", "finished", "static_features", "dynamic_features"]

    def rows(name):
        reader = spark.read.option("header", "true").format(format if "features" in name else "parquet")
        return sorted(map(str, reader.load(f"{target}/{name}").collect()))

    def sensor(name, tones):
        for h in range(2):
            put(top / name, f"b_1_{name}_202401010{h}.zip", {f"b_1_{name}_202401010{h}.bin": raw(signal(tones, seed=h), HOUR + h * 3600_000)})

    sensor("DNA1", [(5, 1), (12, 1)])
    put(top / "GW1", "b_1_GW1_2024010100.zip", {"b_1_GW1_2024010100.bin": raw(np.full(30, 20.0))})
    put(top / "DNA9", "b_1_DNA9_2024010100.zip", {"b_1_DNA9_2024010100.bin": raw(np.full(30, 20.0))})  # fails
    pipeline.process(spark, str(top), target, format)
    first = {n: rows(n) for n in names}
    for path in (top / "DNA1").iterdir():
        path.write_bytes(b"opened again")
    sensor("DNA2", [(7, 1)])
    status = pipeline.process(spark, str(top), target, format)
    assert {r["path"].split("/")[-2] for r in status.collect()} == {"DNA2", "DNA9"} and status.filter("not ok").count() == 0
    for n in names:
        again = rows(n)
        assert set(first[n]) <= set(again), n
        if n != "static_features":
            assert len(again) > len(first[n]), n
    assert [r[0] for r in spark.read.parquet(f"{target}/failed_sensors").select("sensor_id").collect()] == ["DNA9"]
    sensor("DNA3", [(6, 1)])
    one = pipeline.process(spark, str(top), target, format, max_files=2)  # the first by path
    assert sorted(r["path"].rsplit("/", 1)[1] for r in one.collect()) == ["b_1_DNA3_2024010100.zip", "b_1_DNA3_2024010101.zip"]
    assert not any("DNA3" in r for r in rows("finished"))


def test_max_files_opens_no_other(spark, tmp_path, monkeypatch):
    for h in range(4):
        put(tmp_path / "S[1]", f"b_1_S_202401010{h}.zip", {f"b_1_S_202401010{h}.bin": raw(np.ones(3))})
    members = archives.read_members(spark, str(tmp_path), max_files=2)
    assert len(members.inputFiles()) == 2 and members.count() == 2
    assert archives.read_members(spark, str(tmp_path), pattern="*.none", recursive=False, max_files=2).count() == 0


def test_csv_sink(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 01:00:00' AS time, 'S' AS sensor_id, 1.5D AS mean, true AS is_valid")
    sinks.write_features(df, str(tmp_path / "csv"), "csv")
    lines = next((tmp_path / "csv" / "sensor_id=S").glob("*.csv")).read_text().splitlines()
    assert lines == ["time,mean,is_valid", "2024-01-01 01:00:00,1.5,True"]
    assert sinks.finished_sensors(spark, str(tmp_path / "none")).count() == 0


def test_stream_takes_only_new_archives(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for h in range(2):
        put(source / "GW", f"b_1_GW_202401010{h}.zip", {f"b_1_GW_202401010{h}.bin": raw(np.full(5, float(h)))})
        ingest.ingest_static(spark, str(source), target, state).awaitTermination()
        assert spark.read.parquet(target).count() == h + 1


def test_zip_in_memory_helpers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("a/b.bin", b"")
        archive.writestr("c.BIN", b"")
    assert archives.members_of(out.getvalue()) == ["a/b.bin"]
