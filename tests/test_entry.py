"""Driver contract: entry smoke run, and every query against its oracle at sf0.001."""

import duckdb

import __spark_entry__ as E
import sys, os
sys.path.insert(0, os.path.dirname(__file__))
from oracle_check import compare  # noqa: E402
from starloom.plans.standin import TABLES

from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["brand", "year", "month_of_year", "avg_review_rating"]
    assert df.count() > 0


def test_every_oracle_names_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


def test_queries_match_oracle_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    failures = []
    oracles = E.oracle_sql()
    for name, fn in E.queries().items():
        sdf = fn(spark, SF001).toPandas()
        if name in oracles:
            msg = compare(sdf, con.execute(oracles[name]).df())
            if msg:
                failures.append((name, msg))
    assert not failures, failures
