"""Typed reading of text fields; bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wayline import constants as K
from wayline.functions.text import clean_text


def safe_decimal(c: Column, precision: int = 13, scale: int = 10) -> Column:
    return clean_text(c).try_cast(f"decimal({precision},{scale})")


def safe_int(c: Column, data_type: str = "bigint") -> Column:
    """Digits only: no sign, point or exponent."""
    text = clean_text(c)
    return F.when(text.rlike("^[0-9]+$"), text.try_cast(data_type))


def parse_datetime14(c: Column) -> Column:
    """`yyyyMMddHHmmss` from the first 14 characters, padded right with zeros.

    Built from its digits, so neither the session zone nor its clock changes
    touch the value.
    """
    digits = F.rpad(F.substring(clean_text(c), 1, 14), 14, "0")
    year, month, day, hour, minute, second = (
        F.substring(digits, start, length).try_cast("int")
        for start, length in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))
    )
    usable = digits.rlike("^[0-9]{14}$") & (year >= 1) & (second < 60)
    return F.when(usable, F.try_make_timestamp_ntz(year, month, day, hour, minute, second))


def in_range(c: Column, low, high) -> Column:
    """The value where it lies within the inclusive bounds, else NULL."""
    return F.when(c.between(F.lit(low), F.lit(high)), c)


def run_date(c: Column, zone: str = K.LOCAL_ZONE) -> Column:
    """Local calendar date of a UTC wall-clock timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), c.cast("timestamp_ntz")))
