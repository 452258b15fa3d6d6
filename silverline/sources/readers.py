"""Readers. All of them are lazy Spark scans."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.operators.shape import shared_spelling


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """The files below ``path`` by their first line, both in order of the file names; empty files are left out.

    Every split is a task of its own that stops after one line, so the files are not read
    for this. The driver gets a line per file, as it has a name per file from listing them.
    """

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            return

    # Settings of a session of its own: no two splits in a task, one row in a batch.
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = apart.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    found = lines.mapInArrow(first_line, lines.schema).where("start = 0").select("file", "value").collect()
    groups: dict[str, list[str]] = {}
    for file, line in sorted((r["file"], r["value"]) for r in found):
        groups.setdefault(line.removeprefix("\ufeff").rstrip("\r"), []).append(file)
    return groups


def _as_path(uri: str) -> str:
    """A file's URI as a path for a reader, which would take some characters for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _csv(reader: DataFrameReader, path: str | list[str], corrupt: str | None) -> DataFrame:
    plain = reader.csv(path)
    if corrupt is None or not plain.columns:
        return plain
    schema = T.StructType([*plain.schema.fields, T.StructField(corrupt, T.StringType())])
    # Rows are judged by all their fields, whichever of them are asked for.
    return reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False).schema(schema).csv(path)


def read_csv_text(
    spark: SparkSession,
    path: str | Sequence[str],
    aliases: Mapping[str, Sequence[str]] | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """CSV with a header; every column stays text.

    The files of a folder may differ in their headers: files of one header are read together, and the
    groups are united by name, so a column may have another place in each file, or be in some of them only (NULL
    elsewhere). Names that normalise alike, or are ``aliases`` of one column, are one column under its first spelling.
    Files of one header take one scan, as a single file does. With ``corrupt``, a column of that name
    has the whole line of records whose number of fields is not the header's, NULL for all others.
    """
    where = path if isinstance(path, str) else list(path)
    reader = lambda: spark.read.option("header", True).option("inferSchema", False)
    several = len(spark.read.text(where).inputFiles()) > 1
    groups = csv_headers(spark, where) if several else {}
    if len(groups) <= 1:
        return _csv(reader(), where, corrupt)
    spelling: dict[str, str] = {}
    frames = []
    for files in groups.values():
        own = reader()
        if isinstance(path, str) and not re.search(r"[\[\]{}*?]", path):
            own = own.option("basePath", path)  # keeps columns that are in the names of folders
        frame = _csv(own, [_as_path(f) for f in files], corrupt)
        frames.append(frame.toDF(*shared_spelling(frame.columns, spelling, aliases or {})))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, corrupt: str | None = None
) -> DataFrame:
    """One JSON object per line; every leaf stays text, structs are kept.

    Without a schema the field names are found by an extra pass over the files,
    which is what lets renamed columns through. Give a schema to save that pass. With ``corrupt``,
    a column of that name has every line that is no JSON object, NULL for all others.
    """
    reader = spark.read.option("multiLine", False).option("primitivesAsString", True)
    if corrupt is None:
        return (reader if schema is None else reader.schema(schema)).json(path)
    reader = reader.option("columnNameOfCorruptRecord", corrupt)
    if schema is None:
        schema = reader.json(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if corrupt not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return reader.schema(schema).json(path)


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines in one scan, whatever their fields: ``line`` as it came, and ``record``, its value as a variant.

    Nothing is inferred, so no pass over the files goes before. ``record`` is NULL where a line is no
    JSON object; blank lines are left out. ``line`` keeps the spelling of numbers, which a variant does not.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", "line")
    record = F.try_parse_json("line")
    return lines.withColumn("record", F.when(F.schema_of_variant(record).startswith("OBJECT"), record))


def json_fields(records: DataFrame, wanted: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Text columns from the ``record`` of :func:`read_json_records`: for each name the first of its paths that a record has.

    A path is a field, or fields joined by dots. What is no object on the way, and JSON's null, is NULL. Each record is
    judged by itself, so a field that is renamed in the middle of a file loses no value. ``keep`` names columns to keep.
    """

    def at(path: str) -> Column:
        place = "$" + "".join(f"['{part}']" for part in path.split("."))
        return F.try_variant_get("record", place, "string")

    columns = [F.coalesce(*map(at, paths)).alias(name) for name, paths in wanted.items()]
    return records.select(*keep, *columns)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def open_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame | None]:
    """Tables by name; ``None`` where nothing readable is found, on any file system."""

    def attempt(path: str) -> DataFrame | None:
        try:
            return read_table(spark, path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    return {name: attempt(path) for name, path in paths.items()}
