"""Archives of binary waveforms, read through Spark's own file source, so from any file system.

A catalog (no bytes are read) is filtered, ordered or limited first; then one task decodes an
archive's members in memory, one row each. What fails becomes a row of the status table, and other
files go on. Archives are never extracted to disk and never deleted.
"""

from __future__ import annotations

import io
import logging
import re
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vibralake.functions.names import file_name, parse_file_name, sensor_dir
from vibralake.operators.decode import RECORD, decode
from vibralake.operators.validate import check_waveform
from vibralake.session import ship

log = logging.getLogger(__name__)

MODES = ("stream", "extract_delete", "temp_dir")


def _files(spark: SparkSession, root: str | list[str], pattern: str, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(root)


def find_archives(spark: SparkSession, root: str, pattern: str = "*.zip", recursive: bool = True) -> DataFrame:
    """path, length of archives; a recursive search takes all *.zip. A missing root is an error. Order by path where order counts."""
    return _files(spark, root, "*.zip" if recursive else pattern, recursive).select("path", "length")


def find_bins(spark: SparkSession, root: str, pattern: str = "*.bin", recursive: bool = True) -> DataFrame:
    """path, length of bare binary files."""
    return _files(spark, root, pattern, recursive).select("path", "length")


def sensor_folders(files: DataFrame) -> DataFrame:
    """Files of sensors: their folder's name doesn't start with a dot nor hold analysis_results. Adds sensor_dir."""
    named = files.withColumn("sensor_dir", sensor_dir(F.col("path")))
    return named.filter(~F.startswith("sensor_dir", F.lit(".")) & ~F.contains("sensor_dir", F.lit("analysis_results")))


def file_catalog(files: DataFrame) -> DataFrame:
    """system, system_id, sensor_id, timestamp, hour, filename, file_size, filepath of files with a valid name."""
    rows = files.select(parse_file_name(F.col("path")).alias("p"), file_name(F.col("path")).alias("filename"), F.col("length").alias("file_size"), F.col("path").alias("filepath"))
    rows = rows.filter("p.error is null")
    return rows.select("p.system", "p.system_id", "p.sensor_id", "p.timestamp", "p.hour", "filename", "file_size", "filepath")


def members_of(content: bytes) -> list[str]:
    """Names of binary members, nested ones included; the suffix is lower case."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        return [n for n in archive.namelist() if n.endswith(".bin")]


_ROW = "path string, member string, file_size bigint, ok boolean, error string, n_records bigint, t_ms array<bigint>, v array<float>"


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float32())]
    names = [x.split()[0] for x in _ROW.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _decoded(path: str, member: str, size: int, raw: bytes) -> tuple:
    try:
        t, v = decode(raw)
    except ValueError as error:
        return path, member, size, False, str(error), 0, None, None
    return path, member, size, True, None, len(v), t, v


def _from_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            path, content = path.as_py(), content.as_py()
            try:
                names = members_of(content)
            except (zipfile.BadZipFile, OSError) as error:
                yield _emit([(path, None, None, False, f"not an archive: {error}", 0, None, None)])
                continue
            if not names:
                yield _emit([(path, None, None, False, "no binary members", 0, None, None)])
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for name in names:  # one member in memory at a time
                    try:
                        raw = archive.read(name)
                    except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError) as error:
                        yield _emit([(path, name, None, False, str(error), 0, None, None)])
                        continue
                    yield _emit([_decoded(path, name, len(raw), raw)])


def _from_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield _emit([_decoded(path, file_name_of(path), len(content), content)])


def file_name_of(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def read_members(spark: SparkSession, root: str | list[str], recursive: bool = True, pattern: str = "*.zip", max_files: int | None = None, mode: str = "stream", bins: bool = False) -> DataFrame:
    """One row for each member (or failed archive): path, member, file_size, ok, error, n_records, t_ms, v.

    mode is checked and otherwise without effect: archives are always read in memory. max_files
    takes the first so many archives by path: they are chosen from the catalog, and no other is opened.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    ship(spark)
    suffix = pattern if bins or not recursive else "*.zip"
    if max_files:
        first = sensor_folders(_files(spark, root, suffix, recursive).select("path")).select("path").orderBy("path").limit(max_files)
        root = [_literal(r["path"]) for r in first.collect()]
        if not root:
            return spark.createDataFrame([], _ROW)
    files = sensor_folders(_files(spark, root, suffix, recursive)).select("path", "content")
    return files.mapInArrow(_from_bins if bins else _from_archives, _ROW)


def _literal(path: str) -> str:
    """A path whose characters stand for themselves where patterns are read."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def waveforms(members: DataFrame) -> DataFrame:
    """Decoded members with at least one record and a valid name: see schemas.WAVEFORM. The name is the member's."""
    rows = members.filter("ok and n_records > 0").withColumn("p", parse_file_name(F.col("member"))).filter("p.error is null")
    return rows.select("path", "member", "p.system", "p.system_id", sensor_dir(F.col("path")).alias("sensor_dir"), "p.sensor_id", "p.timestamp", "p.hour", "file_size", "n_records", "t_ms", "v")


def ingest_status(members: DataFrame) -> DataFrame:
    """path, member, ok, n_records, error; a member that decodes but has a bad name or no records isn't ok."""
    error = F.when(~F.col("ok"), F.col("error")).when(F.col("n_records") == 0, "no records").otherwise(parse_file_name(F.col("member"))["error"])
    return members.select("path", "member", error.isNull().alias("ok"), "n_records", error.alias("error"))


def ingest_statistics(status: DataFrame) -> DataFrame:
    """total_zips, processed_zips, failed_zips, total_bins, processed_bins, failed_bins and both success rates, as true counts."""
    zips = status.groupBy("path").agg(F.bool_or("ok").alias("ok"), F.count("member").alias("bins"), F.count_if(F.col("ok") & F.col("member").isNotNull()).alias("good"))
    sums = zips.agg(
        F.count("*").alias("total_zips"),
        F.count_if("ok").alias("processed_zips"),
        F.count_if(~F.col("ok")).alias("failed_zips"),
        F.coalesce(F.sum("bins"), F.lit(0)).alias("total_bins"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("processed_bins"),
    )
    sums = sums.withColumn("failed_bins", F.col("total_bins") - F.col("processed_bins"))
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return sums.withColumns({"zip_success_rate": rate("processed_zips", "total_zips"), "bin_success_rate": rate("processed_bins", "total_bins")})


def archive_info(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """name, size, n_bin_files, bin_files, total_uncompressed, ratio of each archive; the last two are null without binary members, bad archives are left out."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        bins = [i for i in archive.infolist() if i.filename.endswith(".bin")]
                except (zipfile.BadZipFile, OSError):
                    continue
                total = sum(i.file_size for i in bins) if bins else None
                row = (file_name_of(path), size, len(bins), [i.filename for i in bins], total)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["name", "size", "n_bin_files", "bin_files", "total_uncompressed"])

    rows = _files(spark, root, "*.zip", recursive).select("path", "length", "content").mapInArrow(run, "name string, size bigint, n_bin_files bigint, bin_files array<string>, total_uncompressed bigint")
    return rows.withColumn("ratio", F.try_divide("total_uncompressed", "size"))


def disk_usage(files: DataFrame, length: str = "length", expansion: float = 3.0) -> DataFrame:
    """total_gb, estimated_gb (extracted), file_count, mean_mb of a catalog; 0 without files."""
    total = F.coalesce(F.sum(length), F.lit(0)).cast("double")
    return files.agg(
        (total / 1024**3).alias("total_gb"),
        (total * expansion / 1024**3).alias("estimated_gb"),
        F.count(length).alias("file_count"),
        F.coalesce(F.try_divide(total, F.count(length)) / 1024**2, F.lit(0.0)).alias("mean_mb"),
    )


def decode_bin_file(spark: SparkSession, path: str, check: bool = False) -> DataFrame:
    """seq, t_ms, value of one bare file; errors are raised, a missing file is an error.

    A size that isn't a multiple of a record's is warned of in the log, and the rest is ignored.
    check=True also warns of what the validity rules find (a pass over the file of its own).
    """
    ship(spark)
    file = spark.read.format("binaryFile").load(path)
    for row in file.select("path", "length").filter(F.col("length") % RECORD.itemsize != 0).collect():  # the files named
        log.warning("%s: %d bytes are no whole number of records of %d bytes", row["path"], row["length"], RECORD.itemsize)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                t, v = decode(content)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(t))), pa.array(t), pa.array(v)], names=["seq", "t_ms", "value"])

    if check:
        for row in checked_bins(file.select("path", "content")).filter("found <> ''").collect():
            log.warning("%s: %s", row["path"], row["found"])
    return file.select("content").mapInArrow(run, "seq bigint, t_ms bigint, value float")


def checked_bins(files: DataFrame) -> DataFrame:
    """path and found, the issues and warnings of each bare file (path, content), joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [",".join(x for part in check_waveform(*decode(c)) for x in part) for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "found"])

    return files.mapInArrow(run, "path string, found string")
