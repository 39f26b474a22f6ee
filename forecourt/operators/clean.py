"""Normalising projections and row filters between Bronze and Gold.

All of these are narrow: no shuffle, and every predicate is a plain comparison
that Catalyst can push into a parquet scan when the frame comes from one.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import spec
from forecourt.functions import double_column, int_column, lower_trim, upper_trim
from forecourt.spec import CSV_LAYOUT, SILVER_BOUNDS, Bounds, Layout


def clean(df: DataFrame, layout: Layout = CSV_LAYOUT) -> DataFrame:
    """Normalise spelling and types in place; columns not named here pass through."""
    return df.withColumns(
        {
            "make": lower_trim(F.col(layout.make)),
            "model": lower_trim(F.col("model")),
            "state": upper_trim(F.col("state")),
            "price": double_column(df, "price"),
            layout.mileage: int_column(df, layout.mileage),
            "year": int_column(df, "year"),
        }
    )


def with_log_price(df: DataFrame) -> DataFrame:
    """``ln(1 + price)``.

    Applied after dedup and filter: it depends on nothing they change, and adding
    it earlier would only widen the rows that the dedup shuffles.
    """
    return df.withColumn("log_price", F.log1p("price"))


def _in_bounds(bounds: Bounds, mileage: str) -> Column:
    return (
        F.col("price").between(*bounds.price)
        & F.col("year").between(*bounds.year)
        & F.col(mileage).between(*bounds.mileage)
    )


def silver_valid(
    df: DataFrame, layout: Layout = CSV_LAYOUT, bounds: Bounds = SILVER_BOUNDS
) -> DataFrame:
    """Business-rule filter of the Silver layer (F1 on CSV layout, F2 on wire layout)."""
    return df.filter(
        _in_bounds(bounds, layout.mileage) & F.col("make").isNotNull() & (F.col("make") != "")
    )


def staging(silver: DataFrame, layout: Layout = CSV_LAYOUT) -> DataFrame:
    """Nine typed columns with the final names, rows without price, year or make dropped.

    A frame that has been cleaned already carries ``make``; starting from that instead of
    the raw spelling means one column less to shuffle or scan, with the same outcome.
    """
    if "make" in silver.columns:
        layout = replace(layout, make="make")
    typed = clean(silver.dropna(subset=["price", "year", layout.make]), layout)
    renamed = {"mileage": layout.mileage}
    return typed.select(*[F.col(renamed.get(c, c)).alias(c) for c in spec.STAGING_COLUMNS])


def staging_sql(table: str, schema: T.StructType, layout: Layout = CSV_LAYOUT) -> str:
    """The text of ``staging`` over a stored table, for a view that outlives the session."""
    names = schema.fieldNames()
    layout = replace(layout, make="make") if "make" in names else layout

    def number(name: str, kind: T.DataType) -> str:
        text = f"try_cast(`{name}` AS DOUBLE)"
        if schema[name].dataType == kind:
            return f"`{name}`"
        return text if isinstance(kind, T.DoubleType) else f"try_cast({text} AS INT)"

    def present(name: str) -> str:
        floating = isinstance(schema[name].dataType, (T.DoubleType, T.FloatType))
        return f"`{name}` IS NOT NULL" + (f" AND NOT isnan(`{name}`)" if floating else "")

    expressions = {
        "make": f"lower(trim(`{layout.make}`))",
        "model": "lower(trim(`model`))",
        "state": "upper(trim(`state`))",
        "price": number("price", T.DoubleType()),
        "mileage": number(layout.mileage, T.IntegerType()),
        "year": number("year", T.IntegerType()),
    }
    shown = ", ".join(f"{expressions.get(c, f'`{c}`')} AS `{c}`" for c in spec.STAGING_COLUMNS)
    kept = " AND ".join(present(c) for c in ("price", "year", layout.make))
    return f"SELECT {shown} FROM {table} WHERE {kept}"


def gold_valid(stg: DataFrame, bounds: Bounds = SILVER_BOUNDS) -> DataFrame:
    """Rows that may enter the marts: in bounds, a known make, one of the 50 states."""
    state = F.col("state")
    return stg.filter(
        _in_bounds(bounds, "mileage")
        & ~F.col("make").isin(spec.UNKNOWN_MAKES)
        & state.isNotNull()
        & (F.length(state) == 2)
        & state.isin(spec.STATES)
    )
