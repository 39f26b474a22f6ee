"""Upsert by key as a relational expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """Source rows replace target rows with the same key; all other rows stay.

    ``source`` must be unique on ``key``. Its rows are never shuffled.
    """
    return unmatched(target, source, key).unionByName(source, allowMissingColumns=True)


def unmatched(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """Target rows that an upsert of ``source`` leaves alone.

    Only the source *keys* take part in the join. When Spark finds them small
    enough (statistics, or the measured size at run time) they are broadcast and
    the target is not shuffled; otherwise both sides are shuffled on the key and
    adaptive skew handling may split the target.

    NULL never equals NULL, so target rows without a key can match nothing. They
    bypass the join; left in it, all of them would hash to one task.
    """
    has_key = F.col(key).isNotNull()
    replaced = source.select(key).filter(has_key)
    kept = target.filter(has_key).join(replaced, key, "left_anti").select(target.columns)
    return kept.unionByName(target.filter(~has_key))
