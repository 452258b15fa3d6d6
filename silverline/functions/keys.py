"""Natural and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: surrogate keys lie in [0, 2^63 - 2].
KEY_MODULUS = 2**63 - 1


def trimmed_key(value: Column) -> Column:
    """Key text without surrounding spaces, so that ' C1 ' and 'C1' are one key."""
    return F.trim(value.cast("string"))


def is_present(key: Column) -> Column:
    """True for keys that are not blank, NULL for NULL keys: ``where`` keeps the former."""
    return F.trim(key.cast("string")) != F.lit("")


def surrogate_key(*parts: Column) -> Column:
    """Non-negative bigint from a 64-bit hash of ``parts``; NULL counts as ''.

    The key depends on the values alone, so it is the same in every run and can
    be computed on either side of a join without a lookup. Uniqueness is not
    guaranteed by a hash: the duplicate-key check on the gold keys stays.
    """
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.pmod(F.xxhash64(*texts), F.lit(KEY_MODULUS)).cast("bigint")
