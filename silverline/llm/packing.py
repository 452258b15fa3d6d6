"""Packing documents into sequences: vector best-fit under three capacities.

A document is its ids and an end id. What is longer than a sequence is cut into full pieces,
the first of which takes the remainder. Full pieces are sequences as they are. All others
have a demand in three dimensions: tokens, documents, and attention cost (the square of the
length); an open sequence has a residual in each. Pieces are taken by falling length, and
of the sequences that have room in every dimension the one is chosen with the smallest
weighted residual norm after the piece, or the largest weighted dot product of piece and
residual.

Every task packs what it reads, ``GROUP`` pieces at a time, and no source or group of copies meets in
one place. The result is written; pieces of its loose sequences, those with ``LOOSE`` of their tokens free or
more, are dealt by a hash into whole groups and packed again, so that the partitions of the input
hardly matter. Only these pieces are shuffled: of full groups a few, of many small partitions most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.shared import map_batches
from silverline.llm.tokens import encoder
from silverline.sources import materialised

GROUP = 8192  # pieces that one group packs together
# What stays after the first packing is full to less than this share: the most that partitions can cost.
LOOSE = 1 / 512
# Tasks of the second packing; beyond as many groups a task packs several.
TASKS = 20_000
PACKED = "doc_id long, piece int, start long, ids binary, sequence_id long, offset long"
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loose", pa.bool_())]
)


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and what a dimension weighs in the choice of a sequence."""

    tokens: int = 1024
    documents: int | None = None  # None: as many as there are tokens
    attention: int | None = None  # None: the cost of one full document
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"  # or "dot"

    def vector(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        if self.tokens < 1 or documents < 1 or attention < self.tokens**2 or self.score not in ("norm", "dot"):
            raise ValueError("a full piece must fit into an empty sequence")
        return np.array([self.tokens, documents, attention], dtype=np.int64)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece; all lengths fit a sequence."""
    room = capacity.vector()
    scale = 1.0 / room
    weights = np.array(capacity.weights)
    n = len(lengths)
    chosen, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    left = np.empty((3, max(n, 1)), dtype=np.int64)  # residuals of the open sequences, one column each
    number = np.empty(max(n, 1), dtype=np.int64)
    opened = still = 0
    order = np.argsort(-lengths, kind="stable")
    shortest = int(lengths.min()) if n else 0
    for i in order.tolist():
        length = int(lengths[i])
        demand = (length, 1, length * length)
        r0, r1, r2 = left[0, :still], left[1, :still], left[2, :still]
        fits = np.flatnonzero((r0 >= demand[0]) & (r1 >= 1) & (r2 >= demand[2]))
        if len(fits):
            rest = left[:, fits]
            if capacity.score == "norm":
                after = (rest - np.array(demand)[:, None]) * scale[:, None]
                best = int(np.argmin(weights @ (after * after)))
            else:
                best = int(np.argmax((weights * scale * scale * demand) @ rest))
            k = int(fits[best])
        else:
            k = still
            left[:, k], number[k] = room, opened
            still, opened = still + 1, opened + 1
        chosen[i], offset[i] = number[k], room[0] - left[0, k]
        left[:, k] -= demand
        if left[0, k] < shortest or left[1, k] < 1:  # nothing fits any more
            still -= 1
            left[:, k], number[k] = left[:, still], number[still]
    return chosen, offset


class Packer:
    """Packs lists of pieces (key, piece, start, ids) into sequences that are numbered from ``number``."""

    def __init__(self, capacity: Capacity, number: int):
        self.capacity, self.number = capacity, number

    def _batch(self, rows: list, sequences: np.ndarray, offsets: np.ndarray, loose: np.ndarray) -> pa.RecordBatch:
        columns = [*zip(*rows, strict=True), sequences + self.number, offsets, loose]
        self.number += int(sequences.max()) + 1
        arrays = [pa.array(c, t) for c, t in zip(columns, SCHEMA.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=SCHEMA)

    def packed(self, rows: list) -> pa.RecordBatch:
        lengths = np.array([len(r[3]) // 4 for r in rows])
        chosen, offsets = best_fit(lengths, self.capacity)
        filled = np.bincount(chosen, weights=lengths)
        loose = self.capacity.tokens - filled >= LOOSE * self.capacity.tokens
        return self._batch(rows, chosen, offsets, loose[chosen])

    def alone(self, rows: list) -> pa.RecordBatch:
        nothing = np.zeros(len(rows), dtype=np.int64)
        return self._batch(rows, np.arange(len(rows)), nothing, nothing.astype(bool))


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: Capacity | None = None,
    key: str = "doc_id",
    text: str = "text",
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``ids``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers; pieces of a sequence
    lie side by side from offset 0. NULL texts are empty and give the end id alone; NULL and
    repeated keys are kept as they are; an empty table gives no rows; other columns are dropped.
    Sequence numbers are unique and depend on the input's partitions. The first packing is
    written to the shared folder, so a text is encoded once.
    """
    capacity = capacity or Capacity()
    size = int(capacity.vector()[0])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4").tobytes()
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        open_, full = [], []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = (x.as_py() for x in batch.column(1))
            for name, ids in zip(keys, encoder(tokenizer).encode(texts), strict=True):
                ids += end
                first = (len(ids) // 4) % size or size
                for piece, begin in enumerate([0, *range(first, len(ids) // 4, size)]):
                    stop = first if piece == 0 else begin + size
                    row = (name, piece, begin, ids[4 * begin : 4 * stop])
                    (full if stop - begin == size else open_).append(row)
                if len(full) >= 1024:
                    yield packer.alone(full)
                    full = []
                if len(open_) >= group:
                    yield packer.packed(open_)
                    open_ = []
        if full:
            yield packer.alone(full)
        if open_:
            yield packer.packed(open_)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbers above those of every task of the first packing.
        packer = Packer(capacity, (1 << 61) + (TaskContext.get().partitionId() << 40))
        rows: list = []
        for batch in batches:
            rows += zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            while len(rows) >= group:
                yield packer.packed(rows[:group])
                rows = rows[group:]
        if rows:
            yield packer.packed(rows)

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    once = materialised(map_batches(narrow, pieces, PACKED + ", loose boolean"), "packed")
    loose = once.where("loose").drop("loose")
    # A little less than a group for each task, so that none is left with a small second one.
    tasks = max(1, min(TASKS, math.ceil(loose.count() / (0.9 * group))))
    dealt = loose.repartition(tasks, F.xxhash64("sequence_id", "offset")).sortWithinPartitions("sequence_id", "offset")
    twice = map_batches(dealt, again, PACKED + ", loose boolean")
    return once.where("not loose").unionByName(twice).drop("loose")
