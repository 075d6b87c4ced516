"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry

def own(entries):
    """Without the optional subpackage's, which has its own tests."""
    return {k: v for k, v in entries.items() if not (k.startswith("op") or k == "pipeline")}


QUERIES, ORACLES = own(registry.queries()), own(registry.oracle_sql())


@pytest.fixture(scope="module")
def tables(small_dir):
    connection = duckdb.connect()
    for name in registry.SCHEMAS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_dir}/{name}.parquet'")
    return connection


def as_text(frame):
    frame = frame[sorted(frame.columns)]
    for name in frame.columns:
        frame = frame.assign(**{name: frame[name].map(lambda v: "" if pd.isna(v) else str(v))})
    return sorted(map(tuple, frame.itertuples(index=False)))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small_dir, tables, name):
    got = QUERIES[name](spark, small_dir).toPandas()
    want = tables.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert as_text(got) == as_text(want)
    assert len(got) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    rows = registry.entry(spark)
    assert rows.columns == ["ip", "url", "times", "window_start", "window_end"]
    assert rows.count() > 0
