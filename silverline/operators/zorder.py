"""One sort key over several columns, so that files and row groups are narrow ranges of each of them.

Every column becomes a rank of ``BITS`` bits, equal shares of the rows by its approximate quantiles;
the key interleaves the bits of the ranks, highest first. A filter on any of the columns then
leaves a share of the row groups instead of all of them (or, on the leading column of a plain sort, of few).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 10
# Accuracy of the quantiles: ranks are off by at most this share of the rows.
ACCURACY = 1 / (1 << (BITS + 2))
# Bytes of a text, after what all texts of the column begin with, that decide its rank.
TEXT_BYTES = 7


def _shared_prefix(low: str, high: str) -> int:
    """Bytes that the least and the greatest text begin with, and so every text between them."""
    pairs = zip(low.encode(), high.encode(), strict=False)
    return next((i for i, (a, b) in enumerate(pairs) if a != b), min(len(low.encode()), len(high.encode())))


def _codes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column as a number in the same order, NULL for NULL. Texts take one aggregate of their bounds."""
    types = {c: df.schema[c].dataType for c in columns}
    texts = [c for c in columns if isinstance(types[c], T.StringType)]
    bounds = {}
    if texts:
        row = df.agg(*[f(F.col(c)) for c in texts for f in (F.min, F.max)]).first()
        bounds = {c: row[2 * i : 2 * i + 2] for i, c in enumerate(texts)}

    def code(name: str) -> Column:
        column, kind = F.col(name), types[name]
        if isinstance(kind, T.StringType):
            low, high = bounds[name]
            begin = 0 if low is None else _shared_prefix(low, high)
            part = F.hex(F.substring(F.encode(column, "UTF-8"), begin + 1, TEXT_BYTES))
            return F.conv(F.rpad(part, 2 * TEXT_BYTES, "0"), 16, 10).cast("long")
        if isinstance(kind, T.DateType):
            return F.unix_date(column).cast("long")
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(column)
        if isinstance(kind, T.NumericType | T.BooleanType):
            return column.cast("double") if isinstance(kind, T.FractionalType) else column.cast("long")
        raise TypeError(f"{name}: {kind.simpleString()} has no order to cluster by")

    return [code(c) for c in columns]


def with_zorder(df: DataFrame, columns: Sequence[str], name: str, bits: int = BITS) -> DataFrame:
    """``df`` with the interleaved key ``name`` (long), to sort or range-partition by.

    Numbers, dates, timestamps, booleans and texts (by their bytes) may be clustered by, up to six columns of ten bits. NULLs
    come first. The bounds are found by one pass over these columns, two if any is a text; the driver holds
    ``2 ** bits`` of them for each column, whatever the table. A rank is the number of bounds that a value exceeds, found
    by halving; every halving is a projection of its own, so that nothing is evaluated twice.
    """
    if not columns or not 1 <= bits <= BITS or bits * len(columns) > 62:
        raise ValueError("1 to 62 bits of key, and at most ten for a column")
    codes = [code.alias(f"c{i}") for i, code in enumerate(_codes(df, columns))]
    shares = ", ".join(f"{i / (1 << bits)!r}D" for i in range(1, 1 << bits))
    bounds = df.select(*codes).agg(
        *[F.expr(f"percentile_approx(c{i}, array({shares}), {round(1 / ACCURACY)})") for i in range(len(codes))]
    )
    bounds = [F.lit(np.array(found or [], dtype=float if any(isinstance(b, float) for b in found or []) else int))
              for found in bounds.first()]

    code, at = ([f"{name}_{kind}{i}" for i in range(len(columns))] for kind in ("code", "at"))
    ranked = df.withColumns({**dict(zip(code, codes, strict=True)), **dict.fromkeys(at, F.lit(0))})
    for step in (1 << bit for bit in reversed(range(bits))):
        exceeds = [F.get(known, F.col(a) + (step - 1)) < F.col(c) for known, a, c in zip(bounds, at, code, strict=True)]
        ranked = ranked.withColumns(
            {a: F.col(a) + F.when(more, step).otherwise(0) for a, more in zip(at, exceeds, strict=True)}
        )
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for place, a in enumerate(reversed(at)):
            one = F.shiftright(F.col(a), bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(at) + place))
    return ranked.withColumn(name, key).drop(*code, *at)


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions by its interleaved key, sorted within them: one shuffle.

    Rows of one key are told apart by a hash of the row, so values that a third of all rows share
    are still divided among tasks; a retried task deals them alike. Rows equal in every column stay together.
    """
    key, tie = "_zorder", "_tie"
    while any(c.lower().startswith((key, tie)) for c in df.columns):
        key, tie = "_" + key, "_" + tie
    plain = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    keyed = with_zorder(df, columns, key).withColumn(tie, F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in plain]))
    order = [F.col(key), F.col(tie)]
    dealt = keyed.repartitionByRange(*order) if partitions is None else keyed.repartitionByRange(partitions, *order)
    return dealt.sortWithinPartitions(*order).drop(key, tie)


def _has_map(kind: T.DataType) -> bool:
    """Whether values have a part that cannot be hashed."""
    return any(word in kind.simpleString() for word in ("map<", "variant"))
