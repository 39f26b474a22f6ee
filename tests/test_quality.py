from __future__ import annotations

import pytest

from forecourt.operators import ChecksFailed, checks, enforce
from tests.conftest import executed_plan

SCHEMA = "id string, make string, price double"


def report(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return checks(df, df)


def test_clean_rows_pass(spark):
    found = enforce(report(spark, [("1", "ford", 1.0), ("2", "bmw", 2.0)]))
    assert found == {
        "unique_id": 0,
        "not_null_id": 0,
        "not_null_price": 0,
        "not_null_make": 0,
        "price_positive": 0,
    }


def test_each_check_counts_its_own(spark):
    data = [
        ("1", "ford", 1.0),
        ("1", "ford", 1.0),
        ("1", "ford", 1.0),
        ("2", None, None),
        (None, "bmw", -1.0),
        (None, "bmw", 0.0),
    ]
    found = {r.check_name: r.failures for r in report(spark, data).collect()}
    assert found == {
        "unique_id": 1,
        "not_null_id": 2,
        "not_null_price": 1,
        "not_null_make": 1,
        "price_positive": 2,
    }
    with pytest.raises(ChecksFailed, match="unique_id"):
        enforce(report(spark, data))


def test_empty_input_passes(spark):
    assert set(enforce(report(spark, [])).values()) == {0}


def test_one_wide_shuffle(spark):
    """The ids are shuffled once, already folded per id; everything else is a single row."""
    plan = executed_plan(report(spark, [("1", "ford", 1.0)]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan[plan.index("Exchange hashpartitioning") :]
