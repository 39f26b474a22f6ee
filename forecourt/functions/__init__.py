from forecourt.functions.numbers import double_column, int_column, to_double, to_int, to_long
from forecourt.functions.record import (
    plausible_year,
    price_label,
    price_per_mile,
    wire_json,
    wire_struct,
)
from forecourt.functions.text import clean_string, lower_trim, upper_trim

__all__ = [
    "clean_string",
    "double_column",
    "int_column",
    "lower_trim",
    "plausible_year",
    "price_label",
    "price_per_mile",
    "to_double",
    "to_int",
    "to_long",
    "upper_trim",
    "wire_json",
    "wire_struct",
]
