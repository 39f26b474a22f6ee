"""Listing-shaped view over the generic order tables used for tests and benchmarks.

One listing per order line. The view is built to exercise every rule: padded and
upper-case text, missing and unknown makes, states outside the 50, odometers
above the limit, and ids that repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import spec

# Columns that make the order of copies of one id total.
TIEBREAK = ["l_partkey", "l_suppkey", "l_extendedprice"]

RAW_COLUMNS = ["id", "manufacturer", "model", "year", "price", "odometer", "state", "condition"]

# States the rules must drop.
OUTSIDE_STATES = ["DC", "PR", "none", "XX"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _listing_id():
    return F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``L``: CSV-shaped listings, plus ``ingested_at`` and the tie-break columns.

    Join strategies are left to Spark: at scale both joins shuffle on their key and
    adaptive execution splits a hot part or order; small sides are broadcast by size.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    states = [F.lit(f"{code.lower()} ") for code in [*spec.STATES, *OUTSIDE_STATES]]
    pick = (F.col("o_custkey") % len(states) + 1).cast("int")
    return joined.select(
        _listing_id().alias("id"),
        F.when(F.col("l_suppkey") % 37 == 0, F.lit(None))
        .when(F.col("l_suppkey") % 41 == 0, F.lit("unknown"))
        .otherwise(F.concat(F.lit(" "), F.upper("p_brand"), F.lit(" ")))
        .alias("manufacturer"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("model"),
        F.year("l_shipdate").alias("year"),
        F.col("o_totalprice").alias("price"),
        (F.col("l_quantity") * 15000).alias("odometer"),
        F.element_at(F.array(*states), pick).alias("state"),
        F.col("l_returnflag").alias("condition"),
        F.col("l_shipdate").alias(spec.INGESTED),
        *TIEBREAK,
    )


def domain_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``L`` with prices and odometers pushed over the row-level domain limits."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    line, total = F.col("l_linenumber"), F.col("o_totalprice")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        _listing_id().alias("id"),
        F.concat(F.lit(" Supplier "), F.col("l_suppkey")).alias("manufacturer"),
        F.concat(F.lit("Part "), F.col("l_partkey")).alias("model"),
        F.year("l_shipdate").alias("year"),
        F.when(line == 7, -total).when(line == 6, total * 1.25).otherwise(total).alias("price"),
        F.when(line == 5, F.col("l_quantity") * -15000)
        .otherwise(F.col("l_quantity") * 25000)
        .alias("odometer"),
        F.lit("CA").alias("state"),
        F.col("l_returnflag").alias("condition"),
    )
