"""Row-level accept or reject of raw listings before they are published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import spec
from forecourt.functions import double_column, int_column, lower_trim, to_long
from forecourt.spec import CSV_LAYOUT, Layout

REASON = "error"


def _column_or(df: DataFrame, name: str, default: str | int) -> Column:
    return F.col(name) if name in df.columns else F.lit(default)


def classify(df: DataFrame, layout: Layout = CSV_LAYOUT) -> DataFrame:
    """Coerce to the wire schema and name the first rule each row breaks.

    ``error`` is NULL for an accepted row. A missing or unparsable year, price or
    mileage is a rejection; a mileage *column* that does not exist counts as 0.
    NULL make, model and state stay NULL. Pure projection: one pass, no shuffle.
    With the corrupt-record column of ``read_checked_csv`` a row that has its text there is
    rejected before any other rule, and the column is kept.
    """
    year = int_column(df, "year")
    price = double_column(df, "price")
    # Judged as bigint so that an absurd odometer is "too high", not "unparsable".
    mileage = to_long(_column_or(df, layout.mileage, 0))

    malformed = {"row_malformed": F.col(spec.CORRUPT).isNotNull()} if spec.CORRUPT in df.columns else {}
    rules = malformed | {
        "id_missing": F.col("id").isNull(),
        "year_unparsable": year.isNull(),
        "price_unparsable": price.isNull() | F.isnan(price),
        "price_not_positive": price <= 0,
        "price_too_high": price > spec.MAX_DOMAIN_PRICE,
        "mileage_unparsable": mileage.isNull(),
        "mileage_negative": mileage < 0,
        "mileage_too_high": mileage > spec.MAX_DOMAIN_MILEAGE,
    }
    first_broken = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])

    return df.select(
        F.col("id").cast("string").alias("id"),
        lower_trim(_column_or(df, layout.make, "")).alias("make"),
        lower_trim(_column_or(df, "model", "")).alias("model"),
        year.alias("year"),
        F.round(price, 2).alias("price"),
        mileage.try_cast("int").alias("mileage"),
        _column_or(df, "state", "").cast("string").alias("state"),
        (F.col("condition") if "condition" in df.columns else F.lit(None))
        .cast("string")
        .alias("condition"),
        first_broken.alias(REASON),
        *([spec.CORRUPT] if malformed else []),
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNull()).drop(REASON, spec.CORRUPT)


def quarantine(classified: DataFrame) -> DataFrame:
    """The rejected rows themselves, with the reason, rather than only their number."""
    return classified.filter(F.col(REASON).isNotNull())


def produce_metrics(classified: DataFrame) -> DataFrame:
    """One row ``(produced, failed)`` (A12); columns behind ``error`` are all the scan reads."""
    return classified.agg(
        F.count_if(F.col(REASON).isNull()).alias("produced"),
        F.count_if(F.col(REASON).isNotNull()).alias("failed"),
    )
