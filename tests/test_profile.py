from __future__ import annotations

import math
import statistics as stats
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.operators import price_profile
from tests.conftest import executed_plan, rows


def brute(data, min_count=1):
    groups = defaultdict(list)
    for key, price in data:
        if price is not None:
            groups[key].append(price)
    return {
        key: (
            len(v),
            stats.median(v),
            stats.fmean(v),
            stats.stdev(v) if len(v) > 1 else None,
            min(v),
            max(v),
        )
        for key, v in groups.items()
        if len(v) >= min_count
    }


def same(got, expected):
    assert got.keys() == expected.keys()
    for key in expected:
        for a, b in zip(got[key], expected[key]):
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6), key


def profile(df, **options):
    return {row[0]: tuple(row)[1:] for row in price_profile(df, ["k"], **options).collect()}


prices = st.floats(500, 200_000) | st.integers(500, 520).map(float) | st.none()


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), prices), min_size=1, max_size=60),
    st.sampled_from([0.01, 1.0, 5000.0, 1e9]),
)
def test_against_brute_force(spark, data, width):
    df = spark.createDataFrame(data, "k string, price double")
    same(profile(df, width=width), brute(data))


def test_even_group_takes_the_mean_of_the_middle_two(spark):
    df = spark.createDataFrame([("a", float(p)) for p in (1, 2, 3, 4)], "k string, price double")
    assert profile(df)["a"][1] == 2.5


def test_middle_ranks_in_two_far_places(spark):
    df = spark.createDataFrame([("a", 500.0), ("a", 199_999.0)], "k string, price double")
    assert profile(df)["a"][1] == 100_249.5


def test_negative_and_equal_values(spark):
    data = [("a", -3.5), ("a", -3.5), ("b", -10.0), ("b", 4.0), ("b", -0.25)]
    df = spark.createDataFrame(data, "k string, price double")
    same(profile(df), brute(data))


def test_whole_frame_and_minimum_size(spark):
    data = [("a", float(p)) for p in range(1, 8)] + [("b", 9.0)]
    df = spark.createDataFrame(data, "k string, price double")
    assert rows(price_profile(df).select("listing_count", "median")) == [(8, 4.5)]
    assert set(profile(df, min_count=7)) == {"a"}


def test_empty_input_gives_no_row(spark):
    df = spark.createDataFrame([], "k string, price double")
    assert price_profile(df).count() == 0
    assert price_profile(df, ["k"]).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key and one price, the rest spread out."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(0, 60000, 1, 8).select(
        F.when(hot | (n % 5 == 0), F.lit("hot")).otherwise(F.concat(F.lit("k"), n % 11)).alias("k"),
        F.when(hot, F.lit(9999.0)).otherwise(F.round(500 + n * 7919 % 199500 + n % 97 / 97, 2)).alias("price"),
    )


def test_skew(spark, skewed):
    same(profile(skewed), brute([tuple(r) for r in skewed.collect()]))


@pytest.fixture(scope="module")
def stored(spark, skewed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "skewed")
    skewed.write.parquet(path)
    return spark.read.parquet(path)


def test_reads_once_and_shares_the_shuffle(stored):
    for keys in (["k"], []):
        plan = executed_plan(price_profile(stored, keys))
        assert plan.count("FileScan parquet") == 1, plan
        assert "ReusedExchange" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_many_groups_and_unrounded_prices(spark):
    n = F.col("id")
    df = spark.range(120000).select(
        (n % 60000).alias("k"), (500 + F.xxhash64("id") % 1000 / 1e5).alias("price")
    )
    built_in = df.groupBy("k").agg(F.median("price").alias("m"))
    both = price_profile(df, ["k"]).join(built_in, "k")
    assert both.filter(F.abs(F.col("median") - F.col("m")) > 1e-9).count() == 0
    assert both.count() == 60000
    narrow = df.select(F.lit(1).alias("k"), "price")
    assert math.isclose(
        price_profile(narrow, ["k"]).head()["median"], narrow.agg(F.median("price")).head()[0]
    )
