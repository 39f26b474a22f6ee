"""Expressions over one listing record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import spec


def wire_struct() -> Column:
    """The flat eight-field record."""
    return F.struct(*spec.WIRE.fieldNames())


def wire_json() -> Column:
    """The record as JSON text; NULL fields are written, not dropped (P20)."""
    return F.to_json(wire_struct(), {"ignoreNullFields": "false"})


def price_per_mile(price: Column, mileage: Column) -> Column:
    """Four decimals, NULL for a mileage of zero."""
    return F.when(mileage != 0, F.round(price / mileage, 4))


def plausible_year(year: Column) -> Column:
    return year.between(*spec.PLAUSIBLE_YEARS)


def price_label(price: Column) -> Column:
    """``USD 12,000.00``."""
    return F.concat(F.lit("USD "), F.format_number(price, 2))
