import math

import duckdb
import pytest

import __spark_entry__ as entry
from vibralake.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = ("events", "embeddings", "documents", "labels", "conversations", "benchmark", "pages")


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, float):
        return f"{x:.5g}"
    return str(x)


def compare(spark, queries, sql, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    out = queries[name](spark, SF)
    columns = sorted(out.columns)
    wanted = con.sql(sql[name])
    assert sorted(wanted.columns) == columns
    mine = sorted([tuple(cell(r[c]) for c in columns) for r in out.collect()], key=str)
    theirs = sorted([tuple(map(cell, r)) for r in wanted.select(*[f'"{c}"' for c in columns]).fetchall()], key=str)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_equals_sql(spark, name):
    compare(spark, plans.QUERIES, plans.SQL, name)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["validate_data", "validate_file", "tracking_validity"])
def test_validation_equals_sql_on_odd_rows(spark, tmp_path, name):
    """Gaps and values halfway between two decimals, NaN beside values out of range, infinities, nulls."""
    series = {
        "down": ([0, 12_125], ["100.125", "-1000.125"]),
        "up": ([0, 12_375], ["100.375", "0"]),
        "odd": ([0, 625], ["200.625", "1e18"]),
        "near": ([0, 5], ["1.005", "1001.005"]),
        "some": ([0, 10_000, 20_000], ["nan", "-250.5", "1"]),
        "none": ([0, 10_000], ["nan", "nan"]),
        "inf": ([0, 10_000], ["inf", "-inf"]),
        "null": ([0, 0], [None, None]),
        "one": ([0], ["101"]),
    }
    flat = [(key, t, v) for key, (ts, vs) in series.items() for t, v in zip(ts, vs, strict=True)]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, event_type VARCHAR, value DOUBLE)")
    con.executemany("INSERT INTO events VALUES (?, make_timestamp(1704067200000000 + ?), ?, ?::DOUBLE)", [(i, t, key, v) for i, (key, t, v) in enumerate(flat)])
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    out = plans.QUERIES[name](spark, str(tmp_path))
    wanted = con.sql(plans.SQL[name]).select(*[f'"{c}"' for c in out.columns]).fetchall()
    assert len(wanted) == len(series)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(wanted, key=str)
