from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.operators import latest_per_key
from tests.conftest import executed_plan, rows

SCHEMA = "id string, ingested_at timestamp, a int, b string"
T0 = dt.datetime(2024, 1, 1)


def model(data):
    """Latest first, then a and b ascending with NULL first, one row per id."""

    def rank(row):
        _, when, a, b = row
        return (-when.timestamp(), (a is not None, a or 0), (b is not None, b or ""))

    best = {}
    for row in data:
        if row[0] not in best or rank(row) < rank(best[row[0]]):
            best[row[0]] = row
    return sorted(best.values(), key=repr)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["x", "y", "z", None]),
            st.integers(0, 2).map(lambda d: T0 + dt.timedelta(days=d)),
            st.none() | st.integers(0, 2),
            st.none() | st.sampled_from(["p", "q"]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_against_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(latest_per_key(df)) == model(data)


def test_outcome_does_not_depend_on_partitioning(spark):
    df = spark.range(4000).select(
        F.concat(F.lit("k"), F.col("id") % 300).alias("id"),
        F.lit(T0).alias("ingested_at"),
        (F.col("id") * 7919 % 4001).cast("int").alias("a"),
        F.lit("same").alias("b"),
    )
    once = rows(latest_per_key(df))
    assert len(once) == 300
    assert once == rows(latest_per_key(df.repartition(13, "a")))


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit(T0).alias("ingested_at"),
        F.col("id").cast("int").alias("a"),
        F.lit(None).cast("string").alias("b"),
    )
    best = latest_per_key(df)
    plan = executed_plan(best)
    below_shuffle = plan[plan.index("Exchange hashpartitioning(id") :]
    assert "WindowGroupLimit" in below_shuffle
    assert best.filter("id = 'hot'").first().a == 0
    assert best.count() == 20001
