"""Spelling standardisers: many spellings in, one canonical value out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.fixed_values import CURRENCIES, PROVINCES, TRANSACTION_TYPES


def canonical(folded: Column, spellings: Mapping[str, Sequence[str]], unknown: Column) -> Column:
    """Look ``folded`` up among ``spellings``; unlisted values give ``unknown``.

    The spelling table is one constant map, so the lookup stays inside
    generated code and needs no join.
    """
    pairs = [F.lit(text) for name, listed in spellings.items() for spelling in listed for text in (spelling, name)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), folded), unknown)


def _upper_trimmed(value: Column) -> Column:
    return F.upper(F.trim(value.cast("string")))


def transaction_type(value: Column) -> Column:
    """CREDIT, DEBIT, FEE or REVERSAL; unlisted values come back upper-trimmed."""
    folded = _upper_trimmed(value)
    return canonical(folded, TRANSACTION_TYPES, folded)


def province(value: Column) -> Column:
    """Province name; unlisted values come back trimmed but otherwise untouched."""
    text = value.cast("string")
    # Few texts have anything but single spaces; the others are spared the pattern.
    uneven = reduce(Column.__or__, [text.contains(F.lit(blank)) for blank in ("_", "  ", *"\t\n\x0b\f\r")])
    folded = _upper_trimmed(F.when(uneven, F.regexp_replace(text, r"[\s_]+", " ")).otherwise(text))
    return canonical(folded, PROVINCES, F.trim(text))


def currency(value: Column) -> Column:
    """ZAR for every home-currency spelling; unlisted values come back upper-trimmed."""
    folded = _upper_trimmed(value)
    return canonical(folded, CURRENCIES, folded)
