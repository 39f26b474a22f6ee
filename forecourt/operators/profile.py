"""Exact price statistics per group without ever holding a group in one task (A5-A10).

Spark's ``median`` is exact, but it merges every distinct value of a group into
one in-memory map on one reducer. Where one make, or the whole table, owns most
of the rows that map does not fit, and an approximate percentile gives another
answer. ``price_profile`` finds the same median by counting:

1. *histogram*: rows are folded per *place*, which is a group and a value range of
   fixed width, with map-side combine. A group has at most ``(max - min) / width``
   places (about 4,000 for Gold input) however many rows it has, and a hot group or
   a hot value leaves each map task as single rows.
2. *middle*: a window over the places of a group tells which one, or which two,
   hold the middle ranks. Count, mean, deviation, minimum and maximum come along.
3. *select*: the cells of the middle places, ``value -> n``, are ranked, which reads
   off the one or two middle values. Prices are in cents, so a place has at most
   100 x ``width`` of them.

All rows are folded to cells ``(place, value) -> n`` first, in one pass that feeds both
the histogram and, by a shuffled join, the selection. There is one plan for every size;
nothing is collected, broadcast by order, capped or approximated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_WIDTH = 50.0

STATS = ["listing_count", "median", "mean", "stddev", "minimum", "maximum"]

# What step 2 finds out about a group and step 3 still needs.
_FOUND = ["before", "low_rank", "high_rank", *(s for s in STATS if s != "median")]


def price_profile(
    df: DataFrame,
    keys: Sequence[str] = (),
    value: str = "price",
    min_count: int = 1,
    width: float = BUCKET_WIDTH,
    weight: str | None = None,
) -> DataFrame:
    """``keys`` plus ``STATS`` for every group with at least ``min_count`` rows.

    ``df`` is read once. ``width`` trades the places per group against the values
    per place and does not change the result. It suits values in a known range, as
    prices are: a group has at most (maximum - minimum) / width places. NaN counts
    as larger than any number.

    ``weight`` names a column that says how many rows a row stands for. Values that are not
    in a known range, or hardly repeat within one, are for ``select.exact_medians``.

    Rows whose ``value`` is NULL are left out, as aggregates do. A NULL key is a key.
    Without ``keys`` the whole frame is one group, and an empty frame gives no row.
    """
    counted = _cells(_placed(df, keys, value, width, weight), value)
    middle = _middle_places(_histogram(counted, value, width), keys, min_count)
    cells = counted.join(middle, "place")
    return _read_off(cells, keys, value).select(*keys, *STATS)


def _placed(
    df: DataFrame, keys: Sequence[str], value: str, width: float, weight: str | None
) -> DataFrame:
    # One struct, never NULL: joins on it need no NULL filter, which would make the
    # two sides of the shuffled join differ and keep Spark from sharing their shuffle.
    place = F.struct(*keys, F.floor(F.col(value) / width).alias("bucket")).alias("place")
    return df.filter(F.col(value).isNotNull()).select(
        place, value, (F.col(weight) if weight else F.lit(1)).alias("n")
    )


def _cells(rows: DataFrame, value: str) -> DataFrame:
    counted = rows.groupBy("place", value).agg(F.sum("n").alias("n"))
    # Explicit, so that histogram and ranking both find the cells already in place.
    return counted.repartition("place")


def _histogram(rows: DataFrame, value: str, width: float) -> DataFrame:
    # Moments are taken from the lower edge of the place: small numbers, no cancellation.
    edge = F.col("place.bucket") * F.lit(width)
    above = F.col(value) - edge
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    moments = rows.groupBy("place").agg(
        F.sum(n).alias("n"),
        F.sum(n * above).alias("s1"),
        F.sum(n * above * above).alias("s2"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
    )
    return moments.select(
        "place",
        "n",
        "lowest",
        "highest",
        (edge + s1 / n).alias("centre"),
        (s2 - s1 * s1 / n).alias("scatter"),
    )


def _middle_places(hist: DataFrame, keys: Sequence[str], min_count: int) -> DataFrame:
    # Plain columns: all windows then share one shuffle and one sort.
    hist = hist.select("*", "place.*")
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n, total, before = F.col("n"), F.col("listing_count"), F.col("before")
    gap = F.col("centre") - F.col("mean")

    ranked = hist.withColumns(
        {
            "upto": F.sum(n).over(so_far),
            "listing_count": F.sum(n).over(whole),
            "mean": F.sum(n * F.col("centre")).over(whole) / F.sum(n).over(whole),
            "minimum": F.min("lowest").over(whole),
            "maximum": F.max("highest").over(whole),
        }
    ).filter(total >= min_count)
    ranked = ranked.withColumns(
        {
            "spread": F.sum(F.col("scatter") + n * gap * gap).over(whole),
            "before": F.col("upto") - n,
            "low_rank": F.floor((total + 1) / 2),
            "high_rank": F.floor(total / 2) + 1,
        }
    )
    deviation = F.when(total > 1, F.sqrt(F.col("spread") / (total - 1)))
    holds_middle = (before < F.col("high_rank")) & (F.col("upto") >= F.col("low_rank"))
    return ranked.filter(holds_middle).withColumn("stddev", deviation).select("place", *_FOUND)


def _read_off(cells: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    in_place = (
        Window.partitionBy("place")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("upto")

    def at(rank: str) -> Column:
        covers = (upto - F.col("n") < F.col(rank)) & (upto >= F.col(rank))
        return F.max(F.when(covers, F.col(value)))

    ranked = cells.withColumn("upto", F.col("before") + F.sum("n").over(in_place))
    # The middle ranks lie in one place or in two: fold both to the group.
    folded = (
        ranked.select("*", "place.*")
        .groupBy(*keys)
        .agg(
            ((at("low_rank") + at("high_rank")) / 2).alias("median"),
            *[F.max(name).alias(name) for name in STATS if name != "median"],
        )
    )
    # Without keys the fold gives a row even for no input.
    return folded.filter(F.col("listing_count").isNotNull())
