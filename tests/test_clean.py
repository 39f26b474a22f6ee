from __future__ import annotations

import datetime as dt

import pytest

from forecourt import spec
from forecourt.operators import clean, gold_valid, silver_valid, staging, with_log_price
from forecourt.plans.silver import gold_input, silver
from forecourt.spec import WIRE_LAYOUT
from tests.conftest import rows

DAY = dt.datetime(2024, 5, 1)
RAW = (
    "id string, manufacturer string, model string, year string, price string, odometer string, "
    "state string, condition string, paint string, ingested_at timestamp"
)
STAGED = (
    "id string, make string, model string, year int, price double, mileage int, state string, "
    "condition string, ingested_at timestamp"
)
GOOD = ("1", "ford", "f-150", 2015, 12000.0, 80000, "CA", None, DAY)


def staged(spark, **changes):
    names = [*spec.WIRE.fieldNames(), spec.INGESTED]
    return spark.createDataFrame(
        [tuple(changes.get(n, v) for n, v in zip(names, GOOD))], STAGED
    )


def raw(spark, *data):
    return spark.createDataFrame(list(data), RAW)


ROW = ("1", "  FORD ", " F-150 ", "2015.0", "12000", "80000.7", " ca ", "good", "red", DAY)


def test_clean_rewrites_in_place_and_keeps_the_rest(spark):
    row = clean(raw(spark, ROW)).first()
    assert row.asDict() == {
        "id": "1",
        "manufacturer": "  FORD ",
        "make": "ford",
        "model": "f-150",
        "year": 2015,
        "price": 12000.0,
        "odometer": 80000,
        "state": "CA",
        "condition": "good",
        "paint": "red",
        "ingested_at": DAY,
    }


def test_staging_names_and_types(spark):
    out = staging(clean(raw(spark, ROW)))
    assert out.columns == spec.STAGING_COLUMNS
    assert dict(out.dtypes)["mileage"] == "int"
    assert tuple(out.first()) == ("1", "ford", "f-150", 2015, 12000.0, 80000, "CA", "good", DAY)


@pytest.mark.parametrize("missing", [1, 3, 4])
def test_staging_drops_rows_without_make_year_or_price(spark, missing):
    row = tuple(None if i == missing else v for i, v in enumerate(ROW))
    assert staging(raw(spark, row)).count() == 0


@pytest.mark.parametrize(
    ("change", "kept"),
    [
        ({"price": 500.0}, True),
        ({"price": 499.99}, False),
        ({"price": 200000.0}, True),
        ({"price": 200000.01}, False),
        ({"price": float("nan")}, False),
        ({"price": None}, False),
        ({"year": 1990}, True),
        ({"year": 1989}, False),
        ({"year": 2024}, True),
        ({"year": 2025}, False),
        ({"year": None}, False),
        ({"mileage": 0}, True),
        ({"mileage": -1}, False),
        ({"mileage": 500000}, True),
        ({"mileage": 500001}, False),
        ({"mileage": None}, False),
        ({"make": None}, False),
        ({"make": ""}, False),
    ],
)
def test_bounds_of_both_filters(spark, change, kept):
    row = staged(spark, **change)
    assert (silver_valid(row, WIRE_LAYOUT).count() == 1) is kept
    assert (gold_valid(row).count() == 1) is kept


@pytest.mark.parametrize("state", [None, "DC", "PR", "XX", "ca", "C", "CAL", "NONE"])
def test_only_the_fifty_states_reach_gold(spark, state):
    row = staged(spark, state=state)
    assert silver_valid(row, WIRE_LAYOUT).count() == 1
    assert gold_valid(row).count() == 0


def test_unknown_make_stops_at_gold(spark):
    row = staged(spark, make="unknown")
    assert silver_valid(row, WIRE_LAYOUT).count() == 1
    assert gold_valid(row).count() == 0


def test_fifty_distinct_states():
    assert len(spec.STATES) == len(set(spec.STATES)) == 50


def test_log_price(spark):
    assert with_log_price(staged(spark, price=0.0)).first().log_price == 0.0


def test_dedup_comes_before_the_filter(spark):
    """An invalid latest copy hides a valid earlier one."""
    later = dt.datetime(2024, 5, 2)
    invalid = (*ROW[:4], "1", *ROW[5:9], later)
    assert silver(raw(spark, ROW, invalid)).count() == 0
    assert silver(raw(spark, ROW, (*invalid[:9], DAY - dt.timedelta(days=1)))).count() == 1


def test_both_layouts_give_the_same_gold_input(spark):
    from_csv = gold_input(silver(raw(spark, ROW)))
    wire = staged(spark, condition="good")
    from_wire = gold_input(silver(wire, WIRE_LAYOUT), WIRE_LAYOUT)
    assert rows(from_csv) == rows(from_wire)
