"""Periodic runs of words: a loop of words that repeats at least three times.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbour
extends. They are found by uniting suffix classes in the order of falling LCP:

* The suffixes of a text's words are sorted by prefix doubling; neighbours in that order have
  a longest common prefix (LCP), and those LCPs, largest first, are the edges of a Kruskal forest.
* A class is an ordered set of positions. At an edge of LCP l two classes are united, small into
  large; two positions that become neighbours there agree in exactly l words. At a distance
  d <= l they seed a run of period d that ends after d + l words. No position lies between
  them, so d is the smallest period; the start of the run seeds it too, so the least position of
  equal end and period is where it begins, and no extension is needed.

Only edges that can give a run of the wanted length are taken: without long repeats a text has
none, and after a few rounds of sorting nothing is left to do. Each text is worked on whole, in
its own row; nothing is shuffled. Work is O(n log n) to O(n log² n) in the words of a text.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.shared import map_batches, without

LENGTH, REPEATS = 24, 3
# Words of the texts whose suffixes are sorted together; a longer text is sorted alone.
TOGETHER = 400_000
COLUMNS = ("n_words", "runs", "strongest", "collapsed")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SQL_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _doubled(ids: np.ndarray, least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions that may share ``least`` words with another, in suffix order, and ranks by the first 1, 2, 4 ... words.

    The rank of a position is how many positions are smaller by so many words. Positions that
    are alone in their rank are sorted already and leave the rounds. ``ids`` must end with an
    id that occurs once.
    """
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    new = np.concatenate([[True], ids[order][1:] != ids[order][:-1]])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    levels, width = [rank], 1
    repeated = order[~(new & np.append(new[1:], True))]
    long = repeated
    while len(repeated):
        first, second = rank[repeated], rank[repeated + width]
        order = np.lexsort((second, first))
        repeated, first, second = repeated[order], first[order], second[order]
        fresh = np.concatenate([[True], first[1:] != first[:-1]])
        new = fresh | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(repeated))
        group = np.maximum.accumulate(np.where(fresh, at, 0))
        rank = rank.copy()
        rank[repeated] = first + np.maximum.accumulate(np.where(new, at, 0)) - group
        levels.append(rank)
        width *= 2
        repeated = repeated[~(new & np.append(new[1:], True))]
        if width <= least:
            long = repeated
    return long[np.argsort(rank[long], kind="stable")], levels


def _agreement(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words the suffixes at ``a`` and ``b`` have in common, from the ranks."""
    common = np.zeros(len(a), dtype=np.int64)
    a, b = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a] == levels[k][b]
        step = same.astype(np.int64) << k
        common += step
        a += step
        b += step
    return common


def find_runs(ids: np.ndarray, length: int = LENGTH, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``length`` words and ``repeats`` periods, by start and period.

    ``ids`` must end with an id that occurs once; runs never hold it. Several texts may be given one after another
    if they share no ids.
    """
    if repeats < 2:
        raise ValueError("two periods at least make a run")
    # A run of period d has an edge of length - d words, and of (repeats - 1) * d: at least this many.
    least = max(1, length - length // repeats)
    order, levels = _doubled(ids, least)
    if len(order) < 2:
        return []
    common = _agreement(order[:-1], order[1:], levels)
    del levels
    edges = np.flatnonzero(common >= least)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    positions = order.tolist()
    label = {p: i for i, p in enumerate(positions)}
    classes: list[list[int] | None] = [[p] for p in positions]
    starts: dict[tuple[int, int], int] = {}  # the least start by (end, period)

    def seed(a: int, b: int, common: int) -> None:
        period = b - a
        if period <= common and period + common >= length and period + common >= repeats * period:
            place = (b + common, period)
            if a < starts.get(place, len(ids)):
                starts[place] = a

    for edge, agree in zip(edges.tolist(), common[edges].tolist(), strict=True):
        into, other = label[positions[edge]], label[positions[edge + 1]]
        if len(classes[into]) < len(classes[other]):
            into, other = other, into
        large, small = classes[into], classes[other]
        if 8 * len(small) < len(large):
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()  # two ordered sets: one merge
        for p in small:
            k = bisect_left(large, p)
            if k and label[large[k - 1]] == into:
                seed(large[k - 1], p, agree)
            if k + 1 < len(large) and label[large[k + 1]] == into:
                seed(p, large[k + 1], agree)
        for p in small:
            label[p] = into
        classes[other] = None
    return sorted((start, end - start, period) for (end, period), start in starts.items())


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when of every run only the first period is kept."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def periodic_runs(docs: DataFrame, text: str = "text", length: int = LENGTH, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (structs of start, length and period in words, by start, then period),
    ``strongest`` (the run of most repeats, NULL without runs) and ``collapsed`` (words that stay, joined by a blank).

    Words are separated by ASCII white space. NULL, empty and blank texts have no words, no runs and an empty
    ``collapsed``. Rows are independent of each other, so repeated rows and ids stay; existing columns of the four
    names are replaced; an empty table gives no rows.
    """
    docs = without(docs, *COLUMNS)
    at = docs.columns.index(text)
    result = docs.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(f"array<{_SQL_RUN}>").alias("runs"),
        F.lit(None).cast(_SQL_RUN).alias("strongest"),
        F.lit("").alias("collapsed"),
    ).schema

    def found(batch: pa.RecordBatch, texts: list[list[bytes]], numbers: list[np.ndarray], begin: int) -> pa.RecordBatch:
        """The rows from ``begin`` on whose words are given."""
        bounds = np.cumsum([0, *map(len, numbers)])
        per_text: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        runs = find_runs(np.concatenate(numbers), length, repeats)
        owners = np.searchsorted(bounds, [r[0] for r in runs], side="right") - 1
        for owner, (start, size, period) in zip(owners.tolist(), runs, strict=True):
            per_text[owner].append((start - int(bounds[owner]), size, period))
        collapsed = []
        for words, own in zip(texts, per_text, strict=True):
            if own:
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), own)).tolist()]
            collapsed.append(b" ".join(words))
        as_dict = lambda run: run and dict(zip(("start", "length", "period"), run, strict=True))
        columns = [
            *[column.slice(begin, len(texts)) for column in batch.columns],
            pa.array(map(len, texts), pa.int64()),
            pa.array([list(map(as_dict, own)) for own in per_text], pa.list_(_RUN)),
            pa.array([as_dict(strongest(own)) for own in per_text], _RUN),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *COLUMNS])

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[list[bytes]] = []
            numbers: list[np.ndarray] = []
            begin = used = size = 0
            for value in batch.column(at):
                words = (value.as_py() or "").encode().split()
                known = dict(zip(dict.fromkeys(words), range(used, used + len(words)), strict=False))
                used += len(known) + 1
                # The last number ends the text: it occurs nowhere else.
                own = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                numbers.append(np.append(own, used - 1))
                texts.append(words)
                size += len(words)
                if size >= TOGETHER:
                    yield found(batch, texts, numbers, begin)
                    begin, used, size, texts, numbers = begin + len(texts), 0, 0, [], []
            if texts:
                yield found(batch, texts, numbers, begin)

    return map_batches(docs, computed, result)
