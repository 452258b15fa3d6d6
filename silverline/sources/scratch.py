"""A fresh folder for tables that are written to be read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder,
    which on a cluster other machines could not see.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a new scratch folder and read from there: computed once, free of its lineage."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path, mode="overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(path)
