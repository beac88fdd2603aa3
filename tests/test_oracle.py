"""Every query with an oracle gives the oracle's rows on the smallest test data."""

import math
import os

import duckdb
import pytest

from pulselake import catalogue

SF = "/root/testdata/sf0.001"


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def value(v):
        if v is None:
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return "null" if math.isnan(v) else repr(round(v, 6) + 0.0)
        return repr(float(v)) if isinstance(v, int) else str(v)

    return sorted("|".join(value(r[k]) for k in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    want = duck.sql(catalogue.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical(df.collect(), df.columns) == canonical(want.fetchall(), want.columns)


def test_entry_runs(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
