"""Session helpers: building a local session and shipping the package to executors."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


#: Bytes of an Arrow batch unless the session sets them: Spark's default of 64 MB, held by both sides
#: for each task, is much of a small executor's memory.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def local_session(cpus: int | str = "*", app: str = "vibralake", **conf: str) -> SparkSession:
    """A local session with the settings that the engine's semantics rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, whatever their working folder, and bound Arrow batches.

    The sources are zipped once per application and handed out by Spark's own file server.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_vibralake_shipped", False):
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("vibralake", os.path.relpath(path, root)))
    target = os.path.join(tempfile.mkdtemp(prefix="vibralake-"), "vibralake_src.zip")
    with open(target, "wb") as out:
        out.write(buffer.getvalue())
    context.addPyFile(target)
    context._vibralake_shipped = True
    return spark
