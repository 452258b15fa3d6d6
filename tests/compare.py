"""Runs a registered query and its SQL on one folder and compares everything."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _type(name: str) -> str:
    return {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "string": "VARCHAR",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
    }.get(name, name)


def spark_result(df: DataFrame) -> tuple[dict[str, str], Counter]:
    names = sorted(df.columns)
    types = {f.name: _type(f.dataType.simpleString()) for f in df.schema.fields}
    return types, Counter(tuple(row[n] for n in names) for row in df.collect())


def sql_result(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], Counter]:
    relation = con.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    names = sorted(relation.columns)
    places = [relation.columns.index(n) for n in names]

    def plain(value):
        return float(value) if isinstance(value, Decimal) else value

    return types, Counter(tuple(plain(row[i]) for i in places) for row in relation.fetchall())
