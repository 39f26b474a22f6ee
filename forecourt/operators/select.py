"""Exact medians of arbitrary doubles, without a group or a range in one task.

``profile.price_profile`` counts on values in a known range that repeat, such as prices in
cents: what falls into one price range is ranked by one task. Here nothing is known of the
values. All of a group may be distinct and lie close together, or be spread over many
orders of magnitude. The middle is found by splitting:

1. Rows are folded to cells ``(group, value) -> n`` and stored.
2. Cells of a group that still has more than ``BOUND`` are split at quantiles of its distinct
   values, which Spark's mergeable quantile summary gives in bounded memory. Counts per part,
   folded map-side, tell which part holds the middle rank; only its cells go on.
3. When no group has more than ``BOUND`` cells left, a window ranks them.

A level leaves about one part in ``PARTS`` of a group's cells whatever their distribution, so
a trillion distinct values take six levels or so. Joins with the table of groups are salted by
value, so a hot group is dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt import scratch

BOUND = 10_000
PARTS = 64
ACCURACY = 1_000
SALTS = 64


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch.new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_medians(
    df: DataFrame, keys: Sequence[str] = (), value: str = "price", bound: int = BOUND
) -> DataFrame:
    """``keys``, ``n`` and the exact ``median`` of a double column.

    NULL values are left out; a group without any other has no row. NaN counts as larger
    than any number. A NULL key is a key. Runs jobs when called, one or two a level.
    """
    group = F.struct(F.lit(0).alias("all"), *keys).alias("group")
    rows = df.filter(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("v"))
    cells = _stored(rows.groupBy("group", "v").agg(F.count(F.lit(1)).alias("n")), "cells")
    sizes = _stored(cells.groupBy("group").agg(F.sum("n").alias("total")), "sizes")
    ranks = sizes.select(
        "group",
        F.explode(F.array_distinct(F.array(F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1))).alias("rank"),
        F.lit(0).cast("long").alias("before"),
    )
    part = _of_groups(cells, ranks, ["group"])
    while True:
        cuts = _stored(_cuts(part, bound), "cuts")
        if cuts.isEmpty():
            break
        part = _stored(_narrowed(part, cuts), "middle")
    upto = F.col("before") + F.sum("n").over(
        Window.partitionBy("group", "rank").orderBy("v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    at_rank = part.withColumn("upto", upto).filter(
        (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))
    )
    middle = at_rank.groupBy("group").agg(((F.min("v") + F.max("v")) / 2).alias("median"))
    return sizes.join(middle, "group").select(
        *(F.col(f"group.{key}").alias(key) for key in keys), F.col("total").alias("n"), "median"
    )


def _of_groups(cells: DataFrame, few: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a table of few rows a group; a hot group is dealt to SALTS parts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (
        cells.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        .join(few.withColumn("salt", salts), [*on, "salt"], how)
        .drop("salt")
    )


def _cuts(part: DataFrame, bound: int) -> DataFrame:
    """Where to split the groups that have more than ``bound`` cells."""
    at = [i / PARTS for i in range(1, PARTS)]
    return (
        part.groupBy("group", "rank", "before")
        .agg(
            F.count(F.lit(1)).alias("cells"),
            F.array_distinct(F.percentile_approx("v", at, ACCURACY)).alias("cuts"),
        )
        .filter(F.col("cells") > bound)
        .drop("cells")
    )


def _narrowed(part: DataFrame, cuts: DataFrame) -> DataFrame:
    """The cells of the part that holds the rank; groups without cuts stay as they are."""
    split = _of_groups(part, cuts, ["group", "rank", "before"], "left").withColumn(
        "part", F.size(F.filter("cuts", lambda cut: cut < F.col("v")))
    )
    crowded = split.filter(F.col("cuts").isNotNull())
    sums = crowded.groupBy("group", "rank", "before", "part").agg(F.sum("n").alias("n"))
    upto = F.col("before") + F.sum("n").over(
        Window.partitionBy("group", "rank").orderBy("part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    holds = (
        sums.withColumn("upto", upto)
        .filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        .select("group", "rank", "part", (F.col("upto") - F.col("n")).alias("start"))
    )
    chosen = _of_groups(crowded.drop("before"), holds, ["group", "rank", "part"])
    rest = split.filter(F.col("cuts").isNull())
    columns = ["group", "v", "n", "rank", "before"]
    return chosen.withColumnRenamed("start", "before").select(columns).unionByName(rest.select(columns))
