"""Numbers that arrive as text. What cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerant_decimal(value: Column, precision: int = 18, scale: int = 2) -> Column:
    """Decimal rounded half up; NULL for junk and for values that do not fit."""
    return value.try_cast(f"decimal({precision},{scale})")


def tolerant_int(value: Column) -> Column:
    """Integer part of a whole or decimal number; NULL for anything else.

    The fraction is cut from the text before the cast (``5.999`` is 5, ``.5`` is
    0), never rounded, and exponents are not numbers here.
    """
    whole = F.regexp_replace(
        value.cast("string"), r"^[\x00-\x20]*([+-]?)([0-9]*)[.][0-9]*[\x00-\x20]*$", "$10$2"
    )
    return whole.try_cast("int")


def share_of(part: Column, total: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``total``, rounded half up."""
    return F.round(part * F.lit(100.0) / total, digits)
