import math
from collections import Counter

import duckdb
import pytest

import corpus_pipeline as pipeline
from vibralake.llm import bpe, line_dedup, mixing, ngram_join, quality
from vibralake.llm.shared import staged, table
from test_dedup import brute_components, brute_lines, sha

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage, and after each."""
    docs = [staged(pipeline._documents(table(spark, SF, "documents")), "in")]
    for name, stage in pipeline.STAGES:
        docs.append(staged(stage(spark, docs[-1], SF), "stage"))
    return [d.toPandas().sort_values("doc_id").reset_index(drop=True) for d in docs]


def test_columns_and_registration(stages):
    for before in stages[:-1]:
        assert list(before.columns) == list(pipeline.COLUMNS)
    assert list(stages[-1].columns) == ["doc_id", "lang", "source", "n_tokens", "ids"]
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is pipeline.run and len(pipeline.STAGES) == 5


def test_quality_keeps_what_the_classifier_keeps(spark, stages):
    judged = quality.classify(table(spark, SF, "documents"), table(spark, SF, "labels")).toPandas()
    assert set(stages[1].doc_id) == set(judged[judged.kept].doc_id)
    labels = duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE quality = 1 AND toxic = 0").df().doc_id
    assert len(set(labels) & set(stages[1].doc_id)) >= 0.95 * len(labels)


def test_lines(stages):
    documents = stages[1]  # noqa: F841  DuckDB reads it by name
    wanted = duckdb.sql(line_dedup.sql("documents")).df().sort_values("doc_id").reset_index(drop=True)
    assert list(wanted.kept) == list(stages[2].text)
    assert (stages[2].n_chars == stages[2].text.str.len()).all()


def test_one_of_each_group_stays(stages):
    documents = stages[2]  # noqa: F841
    wanted = duckdb.sql(ngram_join.sql("documents")).df()
    assert list(stages[3].doc_id) == sorted(wanted.component_id.unique())


def test_rates_take_effect(spark, stages):
    docs = spark.createDataFrame(stages[3])
    report: dict = {}
    rated = mixing.mix(docs, table(spark, SF, "labels"), aim=lambda own: mixing.raised(own, pipeline.POWER), keep_wanted=True, report=report).toPandas()
    used = stages[4].doc_id.value_counts()
    for d, domain, rate in zip(rated.doc_id, rated.domain, rated.rate, strict=True):
        assert used.get(d, 0) in (math.floor(rate), math.ceil(rate))
        assert (used.get(d, 0) >= 1) == domain.endswith("/good")
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SF}/labels.parquet'").df()
    bad = set(labels[(labels.toxic == 1) | (labels.quality == 0)].doc_id)
    assert not bad & set(stages[4].doc_id)
    drawn = (rated.n_tokens * [used.get(d, 0) for d in rated.doc_id]).sum() / rated.n_tokens.sum()
    assert abs(drawn / sum(target for _, target, _ in report.values()) - 1) < 0.1  # few documents: the draw's own error
    assert len(set(stages[3][stages[3].doc_id.isin(set(stages[4].doc_id))].lang)) == len(set(stages[3].lang))


def test_encoding_round_trips(stages):
    with open(bpe.default_vocabulary(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    assert [vocabulary.decode(bytes(x)) for x in stages[5].ids] == list(stages[4].text)


def test_odd_rows_and_empty_tables(spark, docs, empty):
    """Repeated rows, repeated and missing identifiers, null and empty texts, clashing columns: each stage against its operator's definition."""
    rows = docs
    for i, (name, stage) in enumerate(pipeline.STAGES):
        before = rows.select("doc_id", "text").collect()
        rows = staged(stage(spark, rows, SF), "odd")
        after = rows.collect()
        if i < 4:
            assert rows.columns == list(pipeline.COLUMNS)
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
        if i == 0:  # a subset of the rows, null texts as empty ones
            left = Counter((r["doc_id"], r["text"] or "") for r in before)
            left.subtract((r["doc_id"], r["text"]) for r in after)
            assert min(left.values()) >= 0 and {r["doc_id"] for r in before if not r["text"]} <= {r["doc_id"] for r in after}
        elif i == 1:
            wanted = {(r[0], r[3]) for r in brute_lines([(r["doc_id"], r["text"]) for r in before])}
            assert {(r["doc_id"], sha(r["text"])) for r in after} == wanted and len(after) == len(before)
        elif i == 2:
            groups = {r[2] for r in brute_components([(r["doc_id"], r["text"]) for r in before]) if r[1]}
            assert groups <= {r["doc_id"] for r in after} and len(set(after)) == len(after)
        elif i == 4:
            assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
            assert all((r["n_tokens"] == 0) == (r["ids"] == b"") for r in after)
    rows = empty
    for name, stage in pipeline.STAGES:
        rows = staged(stage(spark, rows, SF), "none")
        assert rows.count() == 0
    repeated = docs.filter("text is not null").union(docs.filter("text is not null"))
    kept = pipeline.near_stage(spark, repeated, SF).toPandas()
    assert not kept.duplicated().any()
