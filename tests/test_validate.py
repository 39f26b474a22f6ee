from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.operators import accepted, classify, produce_metrics, quarantine
from tests.conftest import rows

RAW = (
    "id string, manufacturer string, model string, year string, price string, "
    "odometer string, state string, condition string"
)
GOOD = ("1", " Ford ", "F-150", "2015", "12000", "80000", "ca", "good")


def judged(spark, **changes):
    names = [part.split()[0] for part in RAW.split(", ")]
    row = [changes.get(name, value) for name, value in zip(names, GOOD)]
    return classify(spark.createDataFrame([tuple(row)], RAW))


def reason(spark, **changes):
    return judged(spark, **changes).first().error


def test_accepted_row_is_typed_and_normalised(spark):
    row = accepted(judged(spark, price="12000.005", odometer="80000.9", year="2015.0")).first()
    assert tuple(row) == ("1", "ford", "f-150", 2015, 12000.01, 80000, "ca", "good")


@pytest.mark.parametrize("price", ["0.01", "500", "12000", "199999", "500000"])
def test_price_accepted(spark, price):
    assert reason(spark, price=price) is None


@pytest.mark.parametrize(
    ("price", "expected"),
    [
        ("0", "price_not_positive"),
        ("-100", "price_not_positive"),
        ("600000", "price_too_high"),
        ("500000.01", "price_too_high"),
        ("Infinity", "price_too_high"),
        ("NaN", "price_unparsable"),
        ("12k", "price_unparsable"),
        (None, "price_unparsable"),
    ],
)
def test_price_rejected(spark, price, expected):
    assert reason(spark, price=price) == expected


@pytest.mark.parametrize("mileage", ["0", "50000", "499999", "1000000", "-0.5"])
def test_mileage_accepted(spark, mileage):
    assert reason(spark, odometer=mileage) is None


@pytest.mark.parametrize(
    ("mileage", "expected"),
    [
        ("-1", "mileage_negative"),
        ("1000001", "mileage_too_high"),
        ("3e9", "mileage_too_high"),
        ("", "mileage_unparsable"),
        (None, "mileage_unparsable"),
    ],
)
def test_mileage_rejected(spark, mileage, expected):
    assert reason(spark, odometer=mileage) == expected


def test_year_and_id(spark):
    assert reason(spark, year=None) == "year_unparsable"
    assert reason(spark, year="twenty") == "year_unparsable"
    assert reason(spark, year="1800") is None
    assert reason(spark, id=None) == "id_missing"


def test_first_broken_rule_wins(spark):
    assert reason(spark, price="-1", odometer="-1") == "price_not_positive"
    assert reason(spark, year="x", price="-1") == "year_unparsable"


def test_null_text_stays_null(spark):
    row = accepted(judged(spark, manufacturer=None, state=None, condition=None)).first()
    assert (row.make, row.state, row.condition) == (None, None, None)


def test_absent_columns_get_defaults(spark):
    df = spark.createDataFrame([(7, 2010, 900.0)], "id bigint, year int, price double")
    assert tuple(accepted(classify(df)).first()) == ("7", "", "", 2010, 900.0, 0, "", None)


def test_metrics_and_split_agree(spark):
    raw = [GOOD, (*GOOD[:4], "0", *GOOD[5:]), (*GOOD[:4], "junk", *GOOD[5:])]
    split = classify(spark.createDataFrame(raw, RAW))
    assert tuple(produce_metrics(split).first()) == (1, 2)
    assert accepted(split).count() == 1
    assert {r.error for r in quarantine(split).collect()} == {
        "price_not_positive",
        "price_unparsable",
    }


def expected_reason(price, mileage):
    if math.isnan(price):
        return "price_unparsable"
    if price <= 0:
        return "price_not_positive"
    if price > 500_000:
        return "price_too_high"
    if mileage < 0:
        return "mileage_negative"
    return "mileage_too_high" if mileage > 1_000_000 else None


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.floats(-1e6, 1e6) | st.sampled_from([0.0, 500_000.0, float("nan")]),
            st.integers(-10, 1_000_010),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_domain_rules_against_plain_python(spark, cases):
    data = [(str(i), 2000, p, m) for i, (p, m) in enumerate(cases)]
    df = spark.createDataFrame(data, "id string, year int, price double, odometer int")
    got = dict(rows(classify(df).select("id", "error")))
    assert got == {str(i): expected_reason(p, m) for i, (p, m) in enumerate(cases)}
