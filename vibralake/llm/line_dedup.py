"""Line deduplication with two Bloom filters.

1. Hashes (8 bytes) of the lines' keys go to shards. A shard has two growing Bloom filters: a hash
   not in the first enters it; one that is there, or was met twice already, enters the second.
   Memory is about two bytes for each hash of a shard, and shards grow in number with the shuffle.
2. The second filters hold every key that occurs twice, and few others. They are broadcast if their
   size is within a bound. Lines that aren't in them never leave their task; without the broadcast
   (beyond the bound) every line counts as suspected, which changes the cost but not the result.
3. Suspected keys are shuffled for exact confirmation: full keys, counted over distinct documents.
4. The confirmed keys, in full, are broadcast within a bound, otherwise joined by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.llm.bloom import CODES, code_batch, sharded
from vibralake.llm.shared import BLANKS, LOWER, UPPER, chunks, clean_columns, ship, staged

#: Bounds of what is broadcast: bytes of the second filters, confirmed keys and their bytes.
FILTER_BYTES, CONFIRMED_KEYS, CONFIRMED_BYTES = 32 << 20, 300_000, 24 << 20
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BLANKS = BLANKS.encode()
#: A code point has one byte that isn't a continuation; these are dropped to count code points.
_CONTINUED = bytes(range(0x80, 0xC0))


def line_keys(text: str | None) -> list[bytes]:
    """What a text's lines are compared by, in UTF-8."""
    return [line.strip(_BLANKS) for line in (text or "").encode().translate(_FOLD).split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has so many code points."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.translate(None, _CONTINUED)) >= least)


def _keys(text: str | None, least: int) -> set[bytes]:
    """Distinct keys of a text that are long enough."""
    return {k for k in line_keys(text) if long_enough(k, least)}


def _code(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def dedup_lines(
    df: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    columns: tuple[str, ...] = (),
    least_chars: int = 40,
    least_docs: int = 5,
    keep: str = "smallest",
    filter_bytes: int = FILTER_BYTES,
    confirmed_keys: int = CONFIRMED_KEYS,
) -> DataFrame:
    """One row per row of df: identifier, columns, text (what is kept), n_lines (before), n_dropped.

    A text is split at line feeds; a null or empty text is one empty line. A line's key is the line
    without ASCII white space at both ends, A-Z in lower case. Keys of least_chars code points in
    least_docs distinct identifiers lose all their lines but for those in the document with the
    smallest (or keep="largest") identifier that holds it, which keeps all its own. Rows with the
    same identifier are one document; rows without one are a document that comes last. Columns not
    named are left out, as are columns named like the results. An empty table gives an empty result.
    """
    spark = df.sparkSession
    turned = (lambda c: c) if keep == "largest" else F.bitwise_not
    columns = tuple(c for c in columns if c.lower() not in ("n_lines", "n_dropped"))
    carried = [F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(columns)]
    work = df.select(turned(F.col(f"`{identifier}`").cast("bigint")).alias("rank"), *carried, F.col(f"`{text}`").cast("string").alias("text"))
    slim = work.select("rank", "text")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            codes = np.array([_code(k) for t in batch.column(1).to_pylist() for k in _keys(t, least_chars)], np.uint64)
            codes, counts = np.unique(codes, return_counts=True)
            yield code_batch(codes, counts > 1, shards)

    known = sharded(slim.mapInArrow(hashes, CODES), True, filter_bytes, "line-filters")  # without it, every line is suspected

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ranks: list[int | None] = []
            keys: list[bytes] = []
            for rank, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = _keys(t, least_chars)
                ranks.extend([rank] * len(own))
                keys.extend(own)
            if known is not None:
                chosen = np.flatnonzero(known.value.has(np.array([_code(k) for k in keys], np.uint64))).tolist()
                ranks, keys = [ranks[i] for i in chosen], [keys[i] for i in chosen]
            yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), pa.array(keys, pa.binary())], names=["rank", "key"])

    met = slim.mapInArrow(suspects, "rank bigint, key binary").groupBy("key", "rank").agg(F.lit(1).alias("one"))
    confirmed = staged(
        met.groupBy("key").agg(F.count("*").alias("n"), F.max("rank").alias("owner")).filter(F.col("n") >= least_docs).select("key", "owner"),
        "line-keys",
    )
    kinds = dict(work.dtypes)
    schema = "rank bigint, " + "".join(f"`{c}` {kinds[c]}, " for c in work.columns if c.startswith("__")) + "text string, n_lines bigint, n_dropped bigint"

    def cut(batches: Iterator[pa.RecordBatch], owners: dict | None) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            at = batch.schema.get_field_index("text")
            drops = batch.column(at + 1).to_pylist() if owners is None else None
            texts, counts, dropped = [], [], []
            for i, (rank, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(at).to_pylist(), strict=True)):
                lines = (t or "").split("\n")
                gone = set(drops[i] or ()) if owners is None else owners
                kept = lines
                if gone:
                    kept = []
                    for line, key in zip(lines, line_keys(t), strict=True):
                        if long_enough(key, least_chars) and key in gone and (owners is None or owners[key] != rank):
                            continue
                        kept.append(line)
                texts.append("\n".join(kept))
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*batch.schema.names[:at], "text", "n_lines", "n_dropped"],
            )

    size = confirmed.agg(F.count("*").alias("keys"), F.coalesce(F.sum(F.length("key")), F.lit(0)).alias("bytes")).first()
    if size["keys"] <= confirmed_keys and size["bytes"] <= CONFIRMED_BYTES:
        owners = spark.sparkContext.broadcast({bytes(r["key"]): r["owner"] for r in confirmed.toLocalIterator()})
        out = work.mapInArrow(lambda batches: cut(batches, owners.value), schema)
    else:
        lost = (
            met.select("rank", "key")
            .join(confirmed, "key")
            .filter(~F.col("rank").eqNullSafe(F.col("owner")))
            .groupBy("rank")
            .agg(F.collect_set("key").alias("gone"))  # lines of the document itself
        )
        other = lost.withColumnRenamed("rank", "their")
        both = work.join(other, work["rank"].eqNullSafe(other["their"]), "left").select(*work.columns, "gone")
        out = both.mapInArrow(lambda batches: cut(batches, None), schema)
    named = [F.col(f"__{i}").alias(c) for i, c in enumerate(columns)]
    return out.select(turned(F.col("rank")).alias(identifier), *named, F.col("text").alias(text), "n_lines", "n_dropped")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for a table of documents."""
    found = dedup_lines(clean_columns(docs, doc_id="bigint", text="string"), keep="largest")
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def sql(documents: str = "documents") -> str:
    """Kept text of every document, in DuckDB SQL: columns rid, doc_id, n_lines, n_dropped, kept."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {documents}),
l AS (SELECT rid, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT rid, doc_id, i, lines[i] AS line, translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
o AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= 5),
m AS (SELECT k.*, o.owner IS NOT NULL AND k.doc_id IS DISTINCT FROM o.owner AS gone FROM k LEFT JOIN o USING (key))
SELECT rid, doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept
FROM m GROUP BY rid, doc_id"""


SQL = f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({sql()})"
