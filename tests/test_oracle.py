"""Registered queries against their DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from stayline import catalog
from tools.check_oracle import TABLES, digest

KEYS = sorted(catalog.oracle_sql())
SPARK_TO_SQL = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
                "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, sf_small, con, key):
    df = E.queries()[key](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    ocols, otypes = rel.columns, [str(t) for t in rel.types]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString(),
                                            f.dataType.simpleString().upper())
                   for f in df.schema.fields}
    assert spark_types == dict(zip(ocols, otypes))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_every_oracle_key_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["episode_id", "patient_id"]
    assert df.count() == 836


def test_every_key_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())
