"""The predicates of one filter, each by rows that only it removes."""

from __future__ import annotations

import datetime

import __spark_entry__ as contract

SCHEMA = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate date, o_orderpriority string"
)


def test_predicates_keep_every_order_that_fits(spark, tmp_path):
    day = datetime.date(1995, 1, 2)
    kept = [
        (1, 1, "O", 1000.0, day, "1-URGENT"),
        (2, 20, "F", 99_999.0, day, "2-HIGH"),
        (3, 30, "F", 250_000.0, day, "1-URGENT"),
        (3, 30, "F", 250_000.0, day, "1-URGENT"),
    ]
    removed = [
        (4, 1, "O", 999.99, day, "1-URGENT"),
        (5, 0, "O", 1000.0, day, "1-URGENT"),
        (6, 1, "P", 1000.0, day, "1-URGENT"),
        (7, 1, "O", 1000.0, None, "1-URGENT"),
        (8, 1, "O", 1000.0, day, "3-MEDIUM"),
        (9, None, None, None, day, None),
    ]
    spark.createDataFrame(kept + removed, SCHEMA).write.parquet(str(tmp_path / "orders.parquet"))
    found = contract.queries()["predicate_forms"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [(r[0], r[2], r[5]) for r in kept]
