"""Corpus pipeline: STAGES of operators, each written as Parquet and read again as the next one's documents.

quality -> line_dedup -> near_dedup -> mix -> encode. All stages but the last return the columns of
documents (doc_id, text, lang, source, n_chars); n_chars follows the text where a stage changes it.
Columns that a table lacks are null, and further columns are left out. Null texts, empty texts and
repeated rows are handled as the operators say; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vibralake.llm import bpe, line_dedup, mixing, ngram_join, quality
from vibralake.llm.shared import staged, table

#: Documents to drop that are broadcast at most, 16 bytes each.
BROADCAST_ROWS = 1_000_000
#: Power to which the ratios of the good domains' totals are raised.
POWER = 0.7
COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, in their order."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; null texts become empty ones; clashing columns are left out."""
    docs = _documents(docs)
    judged = quality.classify(docs, table(spark, sf_dir, "labels"), columns=("lang", "source", "n_chars"))
    return _documents(judged.filter("kept"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the document with the largest doc_id."""
    cut = line_dedup.dedup_lines(_documents(docs), columns=("lang", "source", "n_chars"), keep="largest")
    return _documents(cut.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays, once.

    Texts without words are linked with nothing and stay; rows without a doc_id stay if no linked
    row has one; repeated rows of a document that stays become one row.
    """
    docs = _documents(docs)
    found = staged(ngram_join.link_components(docs, links=False).select("doc_id", "component_id"), "components")
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone"), F.lit(True).alias("out")).distinct()
    gone = staged(gone, "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)  # else the texts are shuffled
    left = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left").filter("out is null").select(*COLUMNS)
    repeats = found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    return left.dropDuplicates(list(COLUMNS)) if repeats else left  # only a repeated doc_id can repeat a row


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is used as often as its rate says: the rate's floor, and once more by a draw on doc_id.

    Good domains smaller than the largest are raised to a share of (their own)**POWER beside it, and
    the others get nothing. Documents whose likeliest domain is a good one stay, with a rate of 1 or
    more; what the classifier finds toxic or poor goes. Further columns named like the results clash
    with nothing, as they are left out; null and empty texts follow their likeliest domain beforehand.
    """
    docs = _documents(docs)
    rated = mixing.mix(docs, table(spark, sf_dir, "labels"), columns=("lang", "source", "n_chars"), aim=lambda own: mixing.raised(own, POWER), keep_wanted=True)
    used = rated.withColumn("uses", mixing.uses_of(F.col("rate"), "doc_id")).filter("uses > 0")
    return _documents(used.withColumn("use", F.explode(F.sequence(F.lit(1), "uses"))))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, encoded: doc_id, lang, source, n_tokens, ids (packed little-endian 32-bit integers).

    A null text is an empty one and has no ids; clashing columns are left out.
    """
    made = bpe.encode_documents(_documents(docs), columns=("doc_id", "lang", "source"))
    return made.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing to target weights", mix_stage),
    ("BPE encoding", encode_stage),
]

#: SQL can't express the classifiers and the encoder; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
