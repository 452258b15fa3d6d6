"""Token files: documents as Simple-8b frames in order of their id, written and read by Spark.

A file is Parquet whose rows are frames of whole consecutive documents. A row holds the
number of the file, how many ids precede the frame in it, the documents' ids and lengths, and
the coded ids (see :mod:`silverline.llm.simple8b`). Spark's committer writes them, so a lost
executor leaves no half file and any file system that Spark knows will do. Documents are
ordered over the files by range; an index beside the frames has one row per file, how
many ids precede it. Reading joins the frames with the index and moves no ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverline.llm import simple8b
from silverline.llm.shared import map_batches
from silverline.llm.tokens import encoder

# Ids after which a frame is closed. A document is never divided between frames.
FRAME_IDS = 131_072
FRAMES = "file int, in_file long, n_ids long, doc_ids array<long>, lengths array<long>, coded binary"
INDEX = "file int, n_ids long, start long"


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    frame_ids: int = FRAME_IDS,
) -> None:
    """Encode every text, append ``end_id``, and write token files in ascending order of ``key``.

    NULL texts are empty and give the end id alone; NULL keys come first; documents of the same
    key are ordered by their text and all written. An empty table gives a folder without frames.
    Other columns are not written.
    """
    ordered = (
        docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("file", pa.int32()), ("in_file", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
             ("lengths", pa.list_(pa.int64())), ("coded", pa.binary())]
        )
        file, in_file = TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        names: list = []
        parts: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            row = [[file], [in_file], [len(ids)], [names], [[len(p) // 4 for p in parts]], [simple8b.encode(ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, schema.types, strict=True)], schema=schema)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = (x.as_py() for x in batch.column(1))
            for name, ids in zip(keys, encoder(tokenizer).encode(texts), strict=True):
                names.append(name)
                parts.append(ids + end)
                size += len(parts[-1]) // 4
                if size >= frame_ids:
                    yield close()
                    in_file, names, parts, size = in_file + size, [], [], 0
        if parts:
            yield close()

    map_batches(ordered, frames, FRAMES).write.parquet(f"{path}/frames")
    written = ordered.sparkSession.read.schema(FRAMES).parquet(f"{path}/frames")
    # One row per file, from two columns of the frames.
    files = written.groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).write.parquet(f"{path}/index")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all earlier documents), ``n_tokens`` and ``ids`` (binary, unsigned 32 bits)."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index").select("file", "start")
    placed = (
        spark.read.schema(FRAMES)
        .parquet(f"{path}/frames")
        .join(index, "file")
        .select((F.col("start") + F.col("in_file")).alias("start"), "doc_ids", "lengths", "coded")
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, names, lengths, coded in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = simple8b.decode(coded).astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(starts + start, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return map_batches(placed, documents, "doc_id long, start long, n_tokens long, ids binary")
