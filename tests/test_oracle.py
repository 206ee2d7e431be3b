"""Every checked query against its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def sortable(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def sorted_rows(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=sortable)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted_rows(df.select(columns).collect())
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = sorted_rows(relation.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert len(found) == len(expected) > 0
    assert found == expected


def test_only_the_fit_has_no_sql():
    assert set(contract.all_queries()) - set(contract.all_sql()) == {"logreg_predictions"}
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_and_fit_give_rows(spark):
    assert contract.entry(spark).count() > 0
    assert contract.queries()["logreg_predictions"](spark, SF_DIR).count() > 0
