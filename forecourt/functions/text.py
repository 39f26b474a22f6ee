"""String normalisation as Column expressions (stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(c: Column) -> Column:
    """Make and model spelling (P1, P2). ``trim`` drops spaces only, as SQL does."""
    return F.lower(F.trim(c))


def upper_trim(c: Column) -> Column:
    """State spelling."""
    return F.upper(F.trim(c))


def clean_string(c: Column) -> Column:
    """Keep ASCII letters, digits and spaces, then trim and lower-case (P10)."""
    return lower_trim(F.regexp_replace(c, "[^a-zA-Z0-9 ]", ""))
