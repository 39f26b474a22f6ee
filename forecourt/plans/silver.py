"""Bronze to Silver to Gold input as compositions of operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from forecourt.operators.clean import clean, gold_valid, silver_valid, staging, with_log_price
from forecourt.operators.dedup import latest_per_key
from forecourt.spec import CSV_LAYOUT, Layout


def deduped(
    bronze: DataFrame, layout: Layout = CSV_LAYOUT, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    return latest_per_key(clean(bronze, layout), tiebreak=tiebreak)


def silver(
    bronze: DataFrame, layout: Layout = CSV_LAYOUT, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Clean, keep one row per id, then filter: a valid copy never revives an invalid latest one."""
    return with_log_price(silver_valid(deduped(bronze, layout, tiebreak), layout))


def gold_input(silver_rows: DataFrame, layout: Layout = CSV_LAYOUT) -> DataFrame:
    return gold_valid(staging(silver_rows, layout))
