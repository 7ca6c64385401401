"""Every registered query against DuckDB, on plain and on skewed tables."""

import math

import pytest
from conftest import SMALL, database

import __spark_entry__ as contract
from basketflow.catalogue.oracle import ORACLE
from basketflow.catalogue.queries import QUERIES

NAMES = sorted(QUERIES)


def values(frame):
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].dt.strftime("%Y-%m-%d %H:%M:%S.%f")
    rows = [
        tuple(None if v is None or (isinstance(v, float) and math.isnan(v)) else v for v in row)
        for row in frame.itertuples(index=False)
    ]
    return sorted(rows, key=repr)


def check(spark, name, sf_dir):
    ours = contract.queries()[name](spark, sf_dir).toPandas()
    theirs = database(sf_dir).execute(contract.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert values(ours) == values(theirs)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items()


@pytest.mark.parametrize("name", NAMES)
def test_small_tables(spark, name):
    check(spark, name, SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables(spark, skewed_dir, name):
    check(spark, name, skewed_dir)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    first = min(rows, key=lambda r: r.supermarket_id)
    assert len(rows) == 25
    assert (first.supermarket_name, first.transactions, first.units, first.sales) == (
        "NATION_0", 34, 3451, 3136971.3)
    assert sum(r.units for r in rows) == 152257
