"""Bronze and Silver locations (K1, K2, K4). Each write returns its row count.

Every write is one commit (``forecourt.commits``): readers see the rows before or after
it, a writer that dies half-way changes nothing, and two writers do not lose each other's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forecourt import commits
from forecourt.sinks.counting import counted
from forecourt.sources.files import existing_schema


def overwrite_bronze(df: DataFrame, path: str) -> int:
    """Replace the content; columns the location already had stay, as NULL (K1).

    A column that would change its type is refused, as it would make older copies
    of the layer unreadable together with this one. ``df`` may read ``path``.
    """
    return _overwrite(df, path, existing_schema(df.sparkSession, path))


def append_bronze(df: DataFrame, path: str) -> int:
    """Add rows, possibly with new columns (K2).

    A column that would change its type is refused before anything is written.
    """
    spark = df.sparkSession
    if commits.latest(spark, path) is None and existing_schema(spark, path) is not None:
        raise ValueError(f"{path} holds files that no commit lists")
    write = _Counting()
    commits.add(df, path, write)
    return write.rows


def overwrite_silver(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> int:
    """Replace the content (K4).

    With ``cluster_by`` rows with equal values lie together: they are dealt out by these columns,
    large values to several tasks, and sorted by them within a file, so that the statistics
    of files and row groups let a filter on them skip the rest. That costs one more shuffle.
    """
    if cluster_by:
        df = df.hint("rebalance", *cluster_by).sortWithinPartitions(*cluster_by)
    return _overwrite(df, path)


class _Counting:
    def __init__(self):
        self.rows = 0

    def __call__(self, df: DataFrame, path: str) -> None:
        self.rows = counted(df, lambda rows: rows.write.parquet(path))


def _overwrite(df: DataFrame, path: str, earlier: T.StructType | None = None) -> int:
    if earlier:
        commits.widened(earlier, df.schema)  # refuse before writing
    write = _Counting()
    commits.overwrite(df, path, write, earlier=earlier)
    return write.rows
