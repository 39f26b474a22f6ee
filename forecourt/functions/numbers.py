"""Lenient numeric columns.

ANSI casts raise on bad text and ``try_cast('12.0' AS INT)`` is NULL, so text goes
to an integer through double: ``'2010.0'`` is 2010, ``'12.7'`` is 12 and anything
that is not a number is NULL. The value is the same whether a column arrives as
text or as an already inferred number.

A column that has the wanted type is left as it is. That is more than a shortcut:
a bare column in a filter can be pushed into a parquet scan, a cast one cannot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_int(c: Column) -> Column:
    return to_double(c).try_cast("int")


def to_long(c: Column) -> Column:
    return to_double(c).try_cast("bigint")


def double_column(df: DataFrame, name: str) -> Column:
    stored = df.schema[name].dataType
    return F.col(name) if isinstance(stored, T.DoubleType) else to_double(F.col(name))


def int_column(df: DataFrame, name: str) -> Column:
    stored = df.schema[name].dataType
    return F.col(name) if isinstance(stored, T.IntegerType) else to_int(F.col(name))
