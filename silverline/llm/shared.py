"""Helpers of the operators: free column names, cutting lineage, byte tables."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from silverline.sources import scratch_folder

# Lower-cases A-Z and leaves every other byte alone.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, whose place an operator's own columns take."""
    mine = {n.lower() for n in names}
    return df.select(*[df[c] for c in df.columns if c.lower() not in mine])


def checkpoint_ready(spark: SparkSession) -> None:
    """Make sure that reliable checkpoints have a folder: the session's, else one of our own."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(
            spark.conf.get("spark.checkpoint.dir", None) or scratch_folder(spark, "checkpoint")
        )


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, free of its lineage."""
    checkpoint_ready(df.sparkSession)
    return df.checkpoint()


ROOT = Path(__file__).resolve().parents[2]
_SENT: set[str] = set()


def workers_find_us(spark: SparkSession) -> None:
    """Let the workers of a local session import this package wherever the session was started.

    On a cluster the package is installed or given with ``--py-files``.
    """
    context = spark.sparkContext
    known = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p} | {Path.cwd()}
    if ROOT in known or context.applicationId in _SENT or not context.master.startswith("local"):
        return
    folder = tempfile.mkdtemp(prefix="package-")
    context.addPyFile(shutil.make_archive(f"{folder}/silverline", "zip", ROOT, "silverline"))
    _SENT.add(context.applicationId)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """``df.mapInArrow`` with workers that can import this package."""
    workers_find_us(df.sparkSession)
    return df.mapInArrow(function, schema)
