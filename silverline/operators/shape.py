"""Column names, column sets and column types."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalise_name(name: str) -> str:
    """Lower-case name in which blanks, dashes, dots and slashes are single underscores."""
    return re.sub("_{2,}", "_", re.sub(r"[ \-./]", "_", name.strip().lower()))


def select_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give column *i* the name ``names[i]``; of columns sharing a name the first stays.

    Columns are addressed by position, so names that are repeated or contain
    dots cannot become ambiguous.
    """
    if list(names) == df.columns and len(set(names)) == len(names):
        return df
    slots = [f"_c{i}" for i in range(len(names))]
    first_slot: dict[str, str] = {}
    for name, slot in zip(names, slots, strict=True):
        first_slot.setdefault(name, slot)
    return df.toDF(*slots).select(*[F.col(slot).alias(name) for name, slot in first_slot.items()])


def normalise_columns(df: DataFrame) -> DataFrame:
    """Normalise top-level names; columns that end up with one name keep the first."""
    return select_by_position(df, [normalise_name(name) for name in df.columns])


def distinct_columns(df: DataFrame) -> DataFrame:
    """Strip names and keep the first column of each."""
    return select_by_position(df, [name.strip() for name in df.columns])


def alias_names(names: Sequence[str], aliases: Mapping[str, Sequence[str]]) -> list[str]:
    """The names, the best present alias of every target that is not present itself renamed."""
    names = list(names)
    for target, candidates in aliases.items():
        if target not in names:
            present = [c for c in candidates if c in names]
            if present:
                names[names.index(present[0])] = target
    return names


def rename_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the best present alias of every target that is not present itself."""
    names = alias_names(df.columns, aliases)
    return df if names == df.columns else df.toDF(*names)


def shared_spelling(
    names: Sequence[str], spelling: dict[str, str], aliases: Mapping[str, Sequence[str]]
) -> list[str]:
    """``names``, each as its column was first spelt: names that normalise alike or are aliases of one target are one column.

    ``spelling`` has the first spelling by meaning and takes what is new. Of columns of one
    meaning the first gets that spelling; the others stay apart under a numbered name.
    """
    out: list[str] = []
    for name, meaning in zip(names, alias_names([normalise_name(n) for n in names], aliases), strict=True):
        wanted = spelling.setdefault(meaning, name)
        taken = {n.lower() for n in out}
        number, free = 2, wanted
        while free.lower() in taken:
            number, free = number + 1, f"{wanted}_{number}"
        out.append(free)
    return out


def require_columns(df: DataFrame, required: Iterable[str], table: str) -> DataFrame:
    """Return ``df`` unchanged, or raise while the plan is being built."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"{table} has no column {missing}; columns are {df.columns}")
    return df


def column_or_null(df: DataFrame, name: str, data_type: T.DataType | str) -> Column:
    """The column cast tolerantly, or a typed NULL if the table lacks it."""
    wanted = data_type if isinstance(data_type, str) else data_type.simpleString()
    if name not in df.columns:
        return F.lit(None).cast(wanted).alias(name)
    if df.schema[name].dataType.simpleString() == wanted:
        return F.col(name)
    return F.col(name).try_cast(wanted).alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type; missing ones are NULL."""
    return df.select(*[column_or_null(df, f.name, f.dataType) for f in schema.fields])


def nested_text(df: DataFrame, struct: str, field: str) -> Column:
    """``struct.field`` as text; NULL when the column is no struct or lacks the field."""
    data_type = df.schema[struct].dataType
    if isinstance(data_type, T.StructType) and field in data_type.names:
        return F.col(struct).getField(field).cast("string")
    return F.lit(None).cast("string")


def add_load_metadata(df: DataFrame, source: str, ingested_at: datetime | None = None) -> DataFrame:
    """Add the source label and the load time (one value for the whole load)."""
    loaded = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return df.withColumns({"source_system": F.lit(source), "ingestion_timestamp": loaded.cast("timestamp")})
