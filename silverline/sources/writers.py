"""Writers. The work is done by the executors; nothing passes the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation

from silverline.operators.zorder import clustered
from silverline.sources.scratch import materialised


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    figures: Mapping[str, Column] | None = None,
    cluster_by: Sequence[str] = (),
    row_group_bytes: int | None = None,
) -> dict[str, object] | None:
    """Write parquet, optionally laid out by the values of some columns; returns ``figures``, if any are given.

    Figures are aggregates that are observed on the rows as they are written, behind the last shuffle, where a task
    counts once however often it is tried.

    A partitioned layout is rebalanced first: rows of one value meet in few
    files, and Spark splits a value too large for one task. A clustered layout orders the rows by several
    columns at once (:func:`silverline.operators.zorder.clustered`), so that row groups are skipped by any of them.
    """
    if partition_by and cluster_by:
        raise ValueError("lay a table out by values or cluster it, not both")
    if cluster_by:
        # Bounds, ranks and the shuffle's sample are passes over the rows, which are computed for the first only.
        df = clustered(materialised(df, "to-cluster"), cluster_by)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    observation = None
    if figures:
        observation = Observation()
        df = df.observe(observation, *[figure.alias(name) for name, figure in figures.items()])
    writer = df.write.mode(mode)
    if compression is not None:
        writer = writer.option("compression", compression)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return None if observation is None else dict(observation.get)


def write_json(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None, lines_per_file: int | None = None
) -> None:
    """Write JSON lines, keeping NULL fields.

    Files packed by most kinds of ``compression`` are read by one task each: ``lines_per_file`` bounds them.
    """
    writer = df.write.mode(mode).option("ignoreNullFields", False)
    if compression is not None:
        writer = writer.option("compression", compression)
    if lines_per_file is not None:
        writer = writer.option("maxRecordsPerFile", lines_per_file)
    writer.json(path)
