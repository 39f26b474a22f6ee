"""Marts that follow an upsert without reading the table again (A1-A4, K8).

All that the four marts need of a listing is its make, state, year and price. A *cell* is
such a combination with the number of listings that have it. An upsert of Silver lists new
folders and drops others (``forecourt.commits``); the listings in the new ones count plus
one, those in the dropped ones minus one, and rows that were only copied cancel out. The
folded difference is added to the stored cells as one commit that records the Silver version
it leads to. So a refresh reads changed folders and cells, never the rest of Silver, and one
that dies or runs twice counts nothing twice.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import commits
from forecourt.commits import WHOLE, Snapshot
from forecourt.operators.clean import gold_valid, staging
from forecourt.spec import CSV_LAYOUT, Layout

CELL = ["make", "state", "year", "price"]
COUNT = "listings"
SCHEMA = T.StructType(
    [
        T.StructField("make", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField(COUNT, T.LongType()),
    ]
)
MARK = "version of Silver"
# Differences kept side by side before they are folded into one.
MOST_FOLDERS = 8


def _signed(listings: DataFrame, sign: int, layout: Layout) -> DataFrame:
    return gold_valid(staging(listings, layout)).select(
        *CELL, F.lit(sign).cast("long").alias(COUNT)
    )


def _folded(cells: DataFrame) -> DataFrame:
    summed = cells.groupBy(*CELL).agg(F.sum(COUNT).alias(COUNT))
    return summed.filter(F.col(COUNT) != 0).select(*SCHEMA.fieldNames())


def refresh_cells(
    spark: SparkSession, silver: str, root: str, layout: Layout = CSV_LAYOUT
) -> list[str]:
    """Bring the cells under ``root`` up to the newest version of ``silver``.

    Returns the folders of Silver it has read. If the version the cells were at has
    expired, they are counted anew from all of Silver.
    """
    now = commits.latest(spark, silver)
    if now is None:
        raise ValueError(f"{silver} has no commit")
    while True:
        have = commits.latest(spark, root)
        reached = have.marks[MARK] if have else 0
        if have and reached >= now.version:
            return []
        before = commits.at_version(spark, silver, reached) if have else None
        old = set(before.folders()) if before else set()
        plus = [x for x in now.folders() if x not in old]
        minus = sorted(old - set(now.folders()))
        changed = [
            _signed(commits.read_folders(spark, silver, folders, snapshot.schema), sign, layout)
            for folders, snapshot, sign in ((plus, now, 1), (minus, before, -1))
            if folders
        ] or [spark.createDataFrame([], SCHEMA)]
        difference = changed[0] if len(changed) == 1 else changed[0].unionByName(changed[1])
        if _store(spark, root, _folded(difference), have, now.version, anew=before is None):
            return plus + minus


def _store(
    spark: SparkSession, root: str, cells: DataFrame, have: Snapshot | None, version: int, anew: bool
) -> bool:
    """Commit a difference on top of the version it was made for; False if that has changed."""
    own = commits.new_write()
    folders = [] if anew or have is None else have.parts[WHOLE]
    if len(folders) + 1 > MOST_FOLDERS:
        cells = _folded(cells.unionByName(commits.read(spark, root, have)))
        folders = []
    cells.write.parquet(f"{root.rstrip('/')}/data/{own}")
    overtaken = []

    def change(newest: Snapshot | None) -> Snapshot | None:
        if (newest.version if newest else 0) != (have.version if have else 0):
            overtaken.append(newest)
            return None
        marks = {MARK: version}
        return replace(Snapshot(0, SCHEMA), parts={WHOLE: [*folders, own]}, marks=marks)

    commits.commit(spark, root, change)
    return not overtaken


def stored_cells(spark: SparkSession, root: str) -> DataFrame:
    """Cells with at least one listing, for the marts of ``plans.gold`` with ``weight=COUNT``."""
    return _folded(commits.read(spark, root))
