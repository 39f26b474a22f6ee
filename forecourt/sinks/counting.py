"""Row counts without a second pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Write = Callable[[DataFrame], None]


def observed(df: DataFrame, write: Write, **metrics: Column) -> dict[str, int]:
    """Run ``write`` on ``df`` and return aggregates of the rows that went by."""
    seen = Observation()
    write(df.observe(seen, *[metric.alias(name) for name, metric in metrics.items()]))
    return seen.get


def counted(df: DataFrame, write: Write) -> int:
    return observed(df, write, rows=F.count(F.lit(1)))["rows"]
