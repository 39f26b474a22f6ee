"""The four Gold marts over the valid listing set (A1-A4) and their read-time order.

Each mart reads its two to four columns of ``valid`` more than once and shuffles
little more than its own groups, so ``valid`` should be stored. ``weight`` names a column
that says for how many listings a row stands (``plans.cells``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import spec
from forecourt.operators.profile import price_profile


def _whole_units(name: str):
    return F.round(F.col(name), 0)


def price_by_make(
    valid: DataFrame, min_group: int = spec.MIN_GROUP, weight: str | None = None
) -> DataFrame:
    """Price statistics of every make with at least ``min_group`` listings."""
    return price_profile(valid, ["make"], min_count=min_group, weight=weight).select(
        "make",
        "listing_count",
        _whole_units("median").alias("median_price"),
        _whole_units("mean").alias("avg_price"),
        _whole_units("stddev").alias("price_stddev"),
        _whole_units("minimum").alias("min_price"),
        _whole_units("maximum").alias("max_price"),
    )


def price_by_state(valid: DataFrame, weight: str | None = None) -> DataFrame:
    """Price statistics per state (A2). Gold input has the 50 states only."""
    return price_profile(valid, ["state"], weight=weight).select(
        "state",
        "listing_count",
        _whole_units("median").alias("median_price"),
        _whole_units("mean").alias("avg_price"),
    )


def make_counts(
    valid: DataFrame, min_group: int = spec.MIN_GROUP, weight: str | None = None
) -> DataFrame:
    """The ``make, listing_count`` part of the make mart, for callers that have no such table."""
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    counts = valid.groupBy("make").agg(rows.alias("listing_count"))
    return counts.filter(F.col("listing_count") >= min_group)


def largest_makes(by_make: DataFrame, top: int = spec.TOP_MAKES) -> DataFrame:
    """Makes with most listings; equal counts are decided by name (O3)."""
    return by_make.orderBy(F.desc("listing_count"), "make").limit(top).select("make")


def price_by_year(
    valid: DataFrame,
    by_make: DataFrame | None = None,
    top: int = spec.TOP_MAKES,
    weight: str | None = None,
) -> DataFrame:
    """Depreciation curve: make and year for the ``top`` largest makes.

    ``by_make`` is the make mart when it already exists as a table; without it the
    counts are taken from ``valid``. Few groups: ``top`` makes times the years in bounds.
    """
    if by_make is None:
        by_make = make_counts(valid, weight=weight)
    leaders = largest_makes(by_make, top)
    of_leaders = valid.join(F.broadcast(leaders), "make", "left_semi")
    return price_profile(of_leaders, ["make", "year"], weight=weight).select(
        "make",
        "year",
        "listing_count",
        _whole_units("median").alias("median_price"),
    )


def listings_summary(valid: DataFrame, weight: str | None = None) -> DataFrame:
    """One KPI row.

    The distinct counts run over one row per make and state, not over the listings,
    so their expansion is tiny. Both halves have one row; they are folded by a union,
    which also yields the single row of an empty input.
    """
    prices = price_profile(valid, weight=weight).select(
        F.col("listing_count").alias("total_listings"),
        _whole_units("median").alias("overall_median_price"),
        _whole_units("mean").alias("overall_avg_price"),
    )
    coverage = (
        valid.groupBy("make", "state")
        .agg(F.min("year").alias("oldest"), F.max("year").alias("newest"))
        .agg(
            F.count_distinct("make").alias("unique_makes"),
            F.count_distinct("state").alias("states_covered"),
            F.min("oldest").alias("oldest_year"),
            F.max("newest").alias("newest_year"),
        )
    )
    halves = prices.unionByName(coverage, allowMissingColumns=True)
    return halves.agg(
        F.coalesce(F.max("total_listings"), F.lit(0)).alias("total_listings"),
        F.max("unique_makes").alias("unique_makes"),
        F.max("states_covered").alias("states_covered"),
        F.max("overall_median_price").alias("overall_median_price"),
        F.max("overall_avg_price").alias("overall_avg_price"),
        F.min("oldest_year").alias("oldest_year"),
        F.max("newest_year").alias("newest_year"),
    )


# --- read-time order (O1, O2): a stored table has none ----------------------


def by_price(mart: DataFrame, key: str) -> DataFrame:
    return mart.orderBy(F.desc("median_price"), key)


def by_make_and_year(mart: DataFrame) -> DataFrame:
    return mart.orderBy("make", "year")
