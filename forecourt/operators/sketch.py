"""Distinct counts that can be united: sketches beside the exact counts of A6.

An exact distinct count of a stream reads all rows again. A sketch of a batch is a few kilobytes
whatever the batch holds, and the sketches of all batches unite to that of all rows.
Up to some hundred distinct values the estimate is exact, beyond that its standard error
is ``ERROR``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_SIZE = 12
ERROR = 1.04 / 2 ** (LG_SIZE / 2)


def distinct_sketches(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: a sketch of each column's values. NULL is no value."""
    return rows.agg(
        *(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_SIZE)).alias(c) for c in columns)
    )


def distinct_estimates(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the estimated distinct count of each column over all sketches."""
    return sketches.agg(
        *(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in columns)
    )
