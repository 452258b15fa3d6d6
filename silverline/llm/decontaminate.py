"""Benchmark passages in documents: one Aho-Corasick automaton, one scan of every text.

Items and documents are normalised alike: A-Z lower-cased, and words are runs of ASCII
letters, digits and all characters beyond ASCII. The patterns are the items' windows of ten
words. Every window that occurs anywhere in a document is found, its words are marked as
hit, and the marked runs are mapped back to places in the original text.

The benchmark is the small, stated side: its words go to the executors with the task, at
most ``AUTOMATON_BYTES`` of text at a time. A larger benchmark is divided into groups of
items, and the documents are scanned once per group, with the same result. Documents are
never shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.shared import cut, free_names, map_batches, without

WINDOW = 10
AUTOMATON_BYTES = 16 << 20  # of benchmark text in one automaton
# Bytes of UTF-8 that stay: digits, a-z and what is beyond ASCII; A-Z become a-z, others a blank.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
COLUMNS = ("n_words", "n_hit", "n_items", "item_ids", "spans", "contaminated")


def words(text: str | None) -> list[bytes]:
    """The words of a text as normalised UTF-8."""
    return (text or "").encode().translate(_NORMAL).split()


@functools.lru_cache(maxsize=1)
def _automaton(items: tuple[tuple[str, str], ...], window: int):
    """The automaton of a group's windows; a value is the window's words and the items that have it."""
    import ahocorasick

    patterns: dict[str, tuple[int, set[str]]] = {}
    for name, text in items:
        own = words(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1) if own else ():
            key = b" %b " % b" ".join(own[i : i + size])
            patterns.setdefault(key.decode("latin-1"), (size, set()))[1].add(name)
    if not patterns:
        return None
    automaton = ahocorasick.Automaton()
    for key, value in patterns.items():
        automaton.add_word(key, value)
    automaton.make_automaton()
    return automaton


def scan(automaton, own: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Runs of hit words as (first, end), and the items found."""
    runs: list[tuple[int, int]] = []
    found: set[str] = set()
    if automaton is None or not own:
        return runs, found
    text = (b" %b " % b" ".join(own)).decode("latin-1")
    at = word = 0  # words that begin before the place ``at``
    for end, (size, names) in automaton.iter(text):
        word += text.count(" ", at, end)
        at = end
        found |= names
        first = word - size
        while runs and runs[-1][1] >= first:
            first = min(first, runs.pop()[0])
        runs.append((first, word))
    return runs, found


def spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The places of runs of words in the original text, in characters."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    solid = np.frombuffer(text.encode().translate(_NORMAL), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    character = np.append(np.cumsum((raw & 0xC0) != 0x80) - 1, len(text))
    return [(int(character[edge[2 * a]]), int(character[edge[2 * b - 1]])) for a, b in runs]


def _groups(benchmark: DataFrame, key: str, text: str, limit: int) -> list[tuple[tuple[str, str], ...]]:
    """The items in groups of at most ``limit`` bytes (or one item), read from Spark one after another."""
    groups, now, size = [], [], 0
    rows = benchmark.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")), text
    ).distinct().orderBy(F.lit(1), F.lit(2))
    for name, body in rows.toLocalIterator():
        bytes_ = len(body.encode())
        if now and size + bytes_ > limit:
            groups.append(tuple(now))
            now, size = [], 0
        now.append((name, body))
        size += bytes_
    return [*groups, tuple(now)]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items`` (long), ``item_ids`` (sorted strings),
    ``spans`` (begin and end of hit runs in characters of the text) and ``contaminated``.

    * An item of fewer words than a window, but not none, is one window; NULL and empty items
      have none. Rows of the same item id are one item; a NULL id counts as the empty string.
    * NULL and empty texts have no words and are clean. Rows are independent of each other, so
      repeated rows and ids stay. Existing columns of the six names are replaced. Empty tables
      give no rows, an empty benchmark leaves every document clean.
    """
    docs = without(docs, *COLUMNS)
    names = list(docs.columns)
    runs, items = free_names(docs, "_runs", "_items")
    state = docs.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<array<int>>").alias(runs),
        F.array().cast("array<string>").alias(items),
    )
    result = docs.select(
        "*",
        *[F.lit(0).cast("long").alias(c) for c in COLUMNS[:3]],
        F.array().cast("array<string>").alias("item_ids"),
        F.array().cast("array<struct<begin:int,end:int>>").alias("spans"),
        F.lit(False).alias("contaminated"),
    ).schema
    *earlier, last = _groups(benchmark, item, item_text, automaton_bytes)
    for group in earlier:  # cut, so that one automaton at a time is in memory
        state = cut(map_batches(state, _scanner(group, window, names.index(text), False), state.schema))
    return map_batches(state, _scanner(last, window, names.index(text), True), result)


def _scanner(group: tuple[tuple[str, str], ...], window: int, at: int, last: bool):
    """Adds a group's hits to those of the groups before it; the last finds their places in the text."""
    place = pa.struct([("begin", pa.int32()), ("end", pa.int32())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(group, window)
        for batch in batches:
            *given, _, runs_before, items_before = batch.columns
            counts, all_runs, all_items, places = [], [], [], []
            for body, before, items in zip(batch.column(at), runs_before, items_before, strict=True):
                body = body.as_py()
                own = words(body)
                runs, found = scan(automaton, own)
                runs = _joined([*map(tuple, before.as_py()), *runs])
                counts.append(len(own))
                all_runs.append(runs)
                all_items.append(sorted({*items.as_py(), *found}))
                if last:
                    places.append([{"begin": a, "end": b} for a, b in spans(body, runs)] if runs else [])
            items = pa.array(all_items, pa.list_(pa.string()))
            columns = [*given, pa.array(counts, pa.int64())]
            if last:
                hits = [sum(b - a for a, b in runs) for runs in all_runs]
                columns += [pa.array(hits, pa.int64()), pa.array(map(len, all_items), pa.int64()), items,
                            pa.array(places, pa.list_(place)), pa.array([h > 0 for h in hits], pa.bool_())]
                columns_names = [*batch.schema.names[: len(given)], *COLUMNS]
            else:
                columns += [pa.array([[list(r) for r in runs] for runs in all_runs], pa.list_(pa.list_(pa.int32()))), items]
                columns_names = batch.schema.names
            yield pa.RecordBatch.from_arrays(columns, names=columns_names)

    return scanned


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs in order, those that meet made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and out[-1][1] >= a:
            a, b = out[-1][0], max(out.pop()[1], b)
        out.append((a, b))
    return out
