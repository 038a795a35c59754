"""Feature tables: partitioned by sensor, written at once, skipped where a sensor's are there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_sensors(rows: DataFrame, target: str, sort: tuple[str, ...] = ()) -> None:
    """Replace the Parquet partitions of the sensors (sensor_id) in rows; those of other sensors stay."""
    dealt = rows.repartition("sensor_id").sortWithinPartitions("sensor_id", *sort) if sort else rows
    dealt.write.mode("overwrite").partitionBy("sensor_id").option("partitionOverwriteMode", "dynamic").parquet(target)


def read_sensors(spark: SparkSession, target: str, schema: str, sensors: list[str] | None = None) -> DataFrame:
    """A table of write_sensors, with only these sensors' partitions read if they are given."""
    rows = spark.read.schema(schema).parquet(target)
    return rows if sensors is None else rows.filter(F.col("sensor_id").isin(sensors))


def finished_sensors(spark: SparkSession, target: str) -> DataFrame:
    """sensor_id of sensors that a table already has; none if there is no table."""
    try:
        done = spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "sensor_id string")
    return done.select(F.col("sensor_id").cast("string")).distinct()


def pending(rows: DataFrame, done: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Rows of sensors that aren't done."""
    return rows.join(done.select(F.col("sensor_id").alias(key)), key, "left_anti")


def write_features(rows: DataFrame, target: str, format: str = "parquet") -> None:
    """Replace the partitions of the sensors in rows, in order of time; a failed job leaves what was there.

    csv writes booleans as True and False and times to the second.
    """
    if format == "csv":
        flags = [c for c, t in rows.dtypes if t == "boolean"]
        rows = rows.withColumns({c: F.initcap(F.col(c).cast("string")) for c in flags})
    writer = rows.repartition("sensor_id").sortWithinPartitions("sensor_id", "time").write.mode("overwrite").partitionBy("sensor_id")
    writer.option("partitionOverwriteMode", "dynamic").option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").format(format).save(target)
