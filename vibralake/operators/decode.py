"""Binary records of 12 bytes: big-endian 64-bit milliseconds since 1970 and a big-endian 32-bit float."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.session import ship

RECORD = np.dtype([("t", ">i8"), ("v", ">f4")])
#: Milliseconds that fit a 64-bit count of nanoseconds.
MOST_MS = (1 << 63) // 1_000_000


def decode(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Times in milliseconds and values; trailing bytes are ignored, times out of range are an error."""
    n = len(raw) // RECORD.itemsize
    records = np.frombuffer(raw, RECORD, n)
    times = records["t"].astype(np.int64)
    if n and (times.max() >= MOST_MS or times.min() <= -MOST_MS):
        raise ValueError("time out of range")
    return times, records["v"].astype(np.float32)


def encode(times: np.ndarray, values: np.ndarray) -> bytes:
    """The inverse of decode."""
    records = np.empty(len(times), RECORD)
    records["t"], records["v"] = times, values
    return records.tobytes()


def encode_rows(df: DataFrame, time: str, value: str) -> DataFrame:
    """df's rows with `record`: the 12 bytes of a row, encoded by Arrow batch."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.column(batch.schema.get_field_index("__t")).to_numpy(zero_copy_only=False)
            v = batch.column(batch.schema.get_field_index("__v")).to_numpy(zero_copy_only=False)
            raw = encode(t, v)
            records = pa.array([raw[i : i + 12] for i in range(0, len(raw), 12)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], records], names=[*batch.schema.names[:-2], "record"])

    work = df.select("*", F.col(time).cast("bigint").alias("__t"), F.col(value).cast("float").alias("__v"))
    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return work.mapInArrow(run, f"{fields}, record binary")


def decode_rows(df: DataFrame, column: str = "record") -> DataFrame:
    """Rows (other columns, seq, t_ms, value) of every record in a binary column."""
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).to_pylist()
            made = [decode(x or b"") for x in raw]
            lengths = [len(t) for t, _ in made]
            rows = np.repeat(np.arange(len(raw)), lengths)
            if not len(rows):
                continue
            seq = np.concatenate([np.arange(n) for n in lengths])
            kept = [batch.column(i).take(pa.array(rows)) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(seq), pa.array(np.concatenate([t for t, _ in made])), pa.array(np.concatenate([v for _, v in made]))], names=[*keep, "seq", "t_ms", "value"]
            )

    kinds = dict(df.dtypes)
    fields = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return df.select(*keep, column).mapInArrow(run, f"{fields}seq bigint, t_ms bigint, value float")
