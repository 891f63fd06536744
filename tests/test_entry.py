"""Driver contract: entry runs, every query has an oracle, and a sample
matches DuckDB on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from healthmart.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import digest

SAMPLE = ["star_rollup", "q2_outcome_share", "q12_wait_bucket_rate", "dedupe_keep_first", "fill_median",
          "dense_ids", "parse_timestamp", "elt_enriched_no_show", "iqr_filter", "seed_dimension"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source_name", "outcome_label", "age_group_name", "total", "avg_age", "rate"]


def test_registry_consistent():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(entry.QUERIES) == set(entry.ORACLE) and set(entry.QUERIES) <= set(q)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


@pytest.mark.parametrize("key", SAMPLE)
def test_oracle_sample(spark, con, key):
    s = entry.queries()[key](spark, SF_SMALL).toPandas()
    o = con.execute(entry.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert digest(s) == digest(o)
