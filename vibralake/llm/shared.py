"""What the operators of this subpackage share: inputs, intermediate tables, row keys, text batches."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vibralake.session import ship

#: Bytes of text that a Python worker handles at once (arrays take some fifty bytes for each); one longer document is handled alone.
CHUNK_BYTES = 1 << 20
#: Spark drops shuffle files, broadcasts and plans that nothing needs any more when the driver collects
#: garbage, which a driver with few objects seldom does: after so many staged tables we ask for it.
TIDY_AFTER = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of the contracts, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read through Spark (any Hadoop file system)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; our own only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not getattr(context, "_vibralake_folder", None):
        # A folder of our own goes with the process; what is written to the cluster's folder is the cluster's to keep.
        local = context.master.startswith("local") and not context.master.startswith("local-cluster")
        if local:
            folder = tempfile.mkdtemp(prefix="vibralake-stage-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            context._vibralake_folder = f"file://{folder}"
        else:
            context._vibralake_folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    return context._vibralake_folder


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends at files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    context._vibralake_staged = [*getattr(context, "_vibralake_staged", []), path]
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    if len(context._vibralake_staged) % TIDY_AFTER == 0:
        tidy(spark)
    made = spark.read.schema(df.schema).parquet(path)
    made._vibralake_path = path
    return made


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read any more, and let Spark drop the shuffle files that led to them."""
    spark = tables[0].sparkSession
    made = spark.sparkContext._vibralake_staged
    for path in [t._vibralake_path for t in tables]:
        _delete(spark, path)
        made.remove(path)
    tidy(spark)


def tidy(spark: SparkSession) -> None:
    gc.collect()
    spark._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_staged(spark: SparkSession) -> int:
    """Delete all tables that staged() has written in this application; call it when results have been read. Returns their number."""
    made = getattr(spark.sparkContext, "_vibralake_staged", [])
    for path in made:
        _delete(spark, path)
    done = len(made)
    made.clear()
    return done


def row_keys(*columns: Column | str) -> list[Column]:
    """Two 64-bit hashes that identify a row by content: equal rows share them, so recomputation is repeatable."""
    return [F.xxhash64(*columns).alias("key_a"), F.xxhash64(F.lit(1), *reversed(columns)).alias("key_b")]


def clean_columns(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; further columns of the input, whatever their names, are left out."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by rows so that each piece holds at most limit bytes of text, or one row."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        start, size = 0, 0
        lengths = pc.binary_length(values).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, UPPER, LOWER)
