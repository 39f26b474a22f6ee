"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt import spec


def latest_per_key(
    df: DataFrame,
    key: str = "id",
    latest: str = spec.INGESTED,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``latest`` per key; ``tiebreak`` columns decide ties.

    Without ``tiebreak`` all remaining columns decide, in frame order, so the
    outcome never depends on row order or partitioning and a re-run after a lost
    executor keeps the same rows.

    ``row_number() = 1`` is planned with a partial group limit below the exchange:
    each map task ships at most one row per key, so a key holding a third of all
    rows reaches its reducer as one row per map task. There is exactly one
    shuffle, and its hash(key) partitioning is reused by the uniqueness check.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in (key, latest)]
    best_first = Window.partitionBy(key).orderBy(F.desc_nulls_last(latest), *map(F.asc, tiebreak))
    return (
        df.withColumn("_nth", F.row_number().over(best_first)).filter("_nth = 1").drop("_nth")
    )
