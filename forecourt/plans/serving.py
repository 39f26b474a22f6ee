"""Queries behind the dashboard (R1-R4). All of them read small marts, never listings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from forecourt import spec
from forecourt.plans.gold import by_make_and_year, by_price


def kpi_tiles(summary: DataFrame) -> DataFrame:
    return summary.select(
        "total_listings", "unique_makes", "states_covered", "overall_median_price"
    )


def top_makes(by_make: DataFrame, top: int = spec.TOP_TILES) -> DataFrame:
    """The ``top`` makes by median price."""
    return by_price(by_make, "make").limit(top).select("make", "median_price", "listing_count")


def depreciation_curve(by_year: DataFrame) -> DataFrame:
    return by_make_and_year(by_year).select("make", "year", "median_price")


def state_map(by_state: DataFrame) -> DataFrame:
    return by_price(by_state, "state").select("state", "median_price")
