"""Schemas, bounds and fixed values shared by every stage.

Everything a stage compares against lives here once, so that the Silver filter
and the Gold-input filter cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- schemas ---------------------------------------------------------------

# JSON record on the wire; also the stream Bronze columns.
WIRE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("make", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("mileage", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("condition", T.StringType()),
    ]
)

CORRUPT = "_corrupt_record"
INGESTED = "ingested_at"

STAGING_COLUMNS = [*WIRE.fieldNames(), INGESTED]


@dataclass(frozen=True)
class Layout:
    """Where a listing frame keeps its make and its mileage.

    CSV-shaped frames call them ``manufacturer`` and ``odometer``, wire-shaped
    frames ``make`` and ``mileage``. All other columns are named alike.
    """

    make: str
    mileage: str


CSV_LAYOUT = Layout(make="manufacturer", mileage="odometer")
WIRE_LAYOUT = Layout(make="make", mileage="mileage")

# --- bounds (inclusive at both ends) ---------------------------------------


@dataclass(frozen=True)
class Bounds:
    price: tuple[float, float] = (500.0, 200_000.0)
    year: tuple[int, int] = (1990, 2024)
    mileage: tuple[int, int] = (0, 500_000)


SILVER_BOUNDS = Bounds()

# Row-level domain limits applied before publishing.
MAX_DOMAIN_PRICE = 500_000.0
MAX_DOMAIN_MILEAGE = 1_000_000
PLAUSIBLE_YEARS = (1900, 2025)

# --- Gold parameters -------------------------------------------------------

MIN_GROUP = 50
TOP_MAKES = 10
TOP_TILES = 20

# Makes that do not count as a make.
UNKNOWN_MAKES = ["", "unknown"]

# The 50 US state codes, ordered by state name.
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]

# --- stream ----------------------------------------------------------------

TOPIC = "car_listings_raw"
REJECTED_TOPIC = "car_listings_rejected"
