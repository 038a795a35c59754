"""Incremental ingest: new archives as a stream of files, with a checkpoint instead of a check for outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vibralake.plans.pipeline import static_features
from vibralake.sources import archives
from vibralake.session import ship


def stream_members(spark: SparkSession, root: str) -> DataFrame:
    """A stream of decoded members of archives below root/<sensor>/."""
    ship(spark)
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.zip").load(f"{root.rstrip('/')}/*")
    return archives.sensor_folders(files).select("path", "content").mapInArrow(archives._from_archives, archives._ROW)


def ingest_static(spark: SparkSession, root: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append static feature rows of all archives that are new since the last call, then stop."""
    rows = static_features(archives.waveforms(stream_members(spark, root)))
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
