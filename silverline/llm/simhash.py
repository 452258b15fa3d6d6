"""Near-duplicates by SimHash: pivot distance tables over fingerprints that may be close.

Fingerprints are 64 bits over the XXH64 hashes of three-word shingles; two link when at most
``DISTANCE`` bits differ. Only distinct fingerprints are compared. Two of them that link
agree in at least three of six parts of their bits, so every fingerprint is sent to a bucket
for each choice of three parts; this decides where pairs meet, never whether they link. In
a bucket each fingerprint has a table of its Hamming distances to ``PIVOTS`` reference
fingerprints. Members are taken in the order of the first distance, a pair is discarded
when any coordinate of the tables differs by more than ``DISTANCE`` (the triangle inequality
rules it out), and what survives is verified bit by bit.

A bucket gives the links that join its members, not all pairs of them. Buckets of more than
``CELL`` members are divided into chunks, of which every two meet in a cell of their own,
so no task holds a bucket whatever its size and no pair is missed. Components are found by
passing on least labels and jumping along them; every round is cut by a checkpoint, and
hubs and labels of many nodes are split. Pivots discard pairs; it is the buckets that bring
pairs together, since differences of coordinates give Spark no key to join by.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.shared import LOWER, cut, free_names, map_batches, without
from silverline.operators.joins import hot_keys, lookup_join

DISTANCE = 3
PIVOTS = 32
SHINGLE, SEED = 3, 42
CELL = 2048
HUB = 256  # rows of one key beyond which a lookup splits them; repeats at most a 256th as many rows
# Six parts of the bits, of which three are equal in any two fingerprints that link.
_PARTS = [((1 << w) - 1) << a for a, w in zip((0, 11, 22, 33, 44, 54), (11, 11, 11, 11, 10, 10), strict=True)]
MASKS = [sum(c) for c in combinations(_PARTS, len(_PARTS) - DISTANCE)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None) -> int:
    """The fingerprint of a text, unsigned; 0 without words."""
    import xxhash

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
        total = len(words) - SHINGLE + 1
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    for begin in range(0, total, 65_536):
        size = min(65_536, total - begin)
        hashes = np.fromiter((digest(s, SEED) for _, s in zip(range(size), shingles)), dtype="<u8", count=size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed long; a column of that name is replaced."""
    docs = without(docs, name)
    at, width = docs.columns.index(text), len(docs.columns)

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py()) for x in batch.column(at)], dtype=np.uint64)
            columns = [*batch.columns[:width], pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:width], name])

    return map_batches(docs, computed, docs.withColumn(name, F.lit(0).cast("long")).schema)


def hex_fingerprint(column: str = "fingerprint") -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: a fixed series of well-mixed numbers (splitmix64)."""
    with np.errstate(over="ignore"):
        z = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def linked_pairs(
    group: np.ndarray, values: np.ndarray, references: np.ndarray, distance: int = DISTANCE
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places that join what links within each group; equal ``group`` numbers lie together.

    Pairs that links found before already join are skipped: the result connects exactly what
    all links connect, with far fewer of them.
    """
    table = np.bitwise_count(values[:, None] ^ references).astype(np.int8)
    order = np.lexsort((table[:, 0], group))
    group, values, table = group[order], values[order], table[order]
    label = np.arange(len(values))
    found: list[np.ndarray] = []
    first = np.arange(len(values))
    step = 0
    while len(first):
        step += 1
        first = first[first + step < len(values)]
        second = first + step
        # Sorted by the first coordinate: beyond the distance, no later member can link either.
        near = (group[first] == group[second]) & (table[second, 0] - table[first, 0] <= distance)
        first, second = first[near], second[near]
        apart = label[first] != label[second]
        a, b = first[apart], second[apart]
        for some in range(0, table.shape[1], 8):
            if not len(a):
                break
            close = np.abs(table[a, some : some + 8] - table[b, some : some + 8]).max(axis=1) <= distance
            a, b = a[close], b[close]
        linked = np.bitwise_count(values[a] ^ values[b]) <= distance
        a, b = a[linked], b[linked]
        if len(a):
            found.append(np.stack([order[a], order[b]]))
            while True:
                least = np.minimum(label[a], label[b])
                if (label[a] == least).all() and (label[b] == least).all():
                    break
                roots = label.copy()
                np.minimum.at(roots, label[a], least)
                np.minimum.at(roots, label[b], least)
                while (roots[roots] != roots).any():
                    roots = roots[roots]
                label = roots[label]
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
    return pairs[0], pairs[1]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, cell, fingerprint), a cell's rows together: the pairs that link its members."""
    references = pivots()
    kept: list[np.ndarray] = []

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        changes = np.append(True, (np.diff(rows[:, :3], axis=0) != 0).any(axis=1))
        values = rows[:, 3].copy().view(np.uint64)
        a, b = linked_pairs(np.cumsum(changes), values, references)
        if len(a):
            ends = np.sort(np.stack([rows[a, 3], rows[b, 3]]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1])], names=["a", "b"])

    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        if not len(rows):
            continue
        rows = np.concatenate([*kept, rows])
        changes = np.flatnonzero((np.diff(rows[:, :3], axis=0) != 0).any(axis=1)) + 1
        if not len(changes):
            kept = [rows]
            continue
        yield from pairs(rows[: changes[-1]])
        kept = [rows[changes[-1] :]]
    if kept:
        yield from pairs(np.concatenate(kept))


def links(distinct: DataFrame, cell: int = CELL) -> DataFrame:
    """Pairs (``a`` < ``b``) that connect exactly the fingerprints which links connect.

    ``distinct``: one column ``fingerprint`` without repeats.
    """
    keyed = distinct.select(
        "fingerprint",
        F.explode(
            F.array(*[F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(_signed(m))) for i, m in enumerate(MASKS)])
        ).alias("bucket"),
    )
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    chunks = F.ceil(F.col("members") / cell).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    meeting = (
        keyed.join(shared, "bucket")
        .select("bucket", "fingerprint", own.alias("own"), other.alias("other"))
        .select(
            "bucket",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "fingerprint",
        )
    )
    together = meeting.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return map_batches(together, _compare, "a long, b long").distinct()


def _hot(rows: DataFrame, key: str) -> DataFrame:
    """Keys of many ``rows``, written once, with the parts they are split into; see ``hot_keys`` for their bound."""
    return cut(hot_keys(rows, key, rows_per_task=HUB))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node of an edge (a, b).

    Nodes with many edges and labels with many nodes are split in both lookups, so neither a hub
    nor a component of a third of all nodes is one task's work. No edges give no rows.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    hubs = _hot(both, "b")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        seen = lookup_join(both, labels.withColumnRenamed("node", "b"), "b", hot=hubs, spread_by="a")
        around = seen.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(around, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        nearer = cut(nearer)
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = lookup_join(nearer, jump, "label", hot=_hot(nearer, "label"), spread_by="node")
        jumped = cut(jumped.select("node", F.col("next").alias("label"), "was"))
        changed = jumped.where("label <> was").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels


def fingerprint_groups(distinct: DataFrame, cell: int = CELL) -> DataFrame:
    """Every row of ``distinct``, which has one row per ``fingerprint``, with ``group``: the fingerprint that
    stands for its component."""
    found = components(links(distinct.select("fingerprint"), cell)).withColumnRenamed("node", "fingerprint")
    linked = distinct.join(found, "fingerprint", "left")
    return linked.select(*distinct.columns, F.coalesce("label", "fingerprint").alias("group"))


def duplicate_groups(printed: DataFrame, key: str = "doc_id", cell: int = CELL) -> DataFrame:
    """One row per distinct ``fingerprint`` of ``printed``: ``group`` (a fingerprint that stands for
    the component) and ``component_id``, the least key of the component.

    NULL keys take part in links but are no component's least key; a component of NULL keys alone
    has NULL. No rows give no rows.
    """
    firsts = cut(printed.groupBy("fingerprint").agg(F.min(key).alias("first")))
    linked = cut(fingerprint_groups(firsts, cell))
    roots = linked.groupBy("group").agg(F.min("first").alias("component_id"))
    whole = lookup_join(linked, roots, "group", hot=_hot(linked, "group"), spread_by="fingerprint")
    return cut(whole.select("fingerprint", "group", "component_id"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id`` of every row of ``docs``.

    Texts are compared whole; NULL and empty texts have the fingerprint 0, which links like any
    other. Repeated rows and keys stay, and rows of one fingerprint, however many, are split.
    Other columns do not matter.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    printed = cut(fingerprints(named).drop("text").withColumn("row", F.monotonically_increasing_id()))
    groups = duplicate_groups(printed, "key").drop("group")
    found = lookup_join(printed, groups, "fingerprint", hot=_hot(printed, "fingerprint"), spread_by="row")
    return found.select(F.col("key").alias(key), "fingerprint", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` of which each component keeps one: the least key, then the least text hash.

    NULL keys come last; of rows with equal key and text any one stays. All columns stay. Texts are
    fingerprinted once. What stays is decided on narrow rows, reduced per fingerprint before they move;
    whole rows are then found by two hashes of key and text, repeated ones left out before they move.
    """
    own = (F.col(key).isNull(), F.col(key), F.col(text))
    stamps = [F.xxhash64(F.lit(i), *own) for i in range(2)]
    named = docs.select(
        F.struct(own[0].alias("none"), own[1].alias("key"), F.xxhash64(text).alias("hash"), *[s.alias(f"s{i}") for i, s in enumerate(stamps)]).alias("first"),
        F.col(text).alias("text"),
    )
    firsts = cut(fingerprints(named).groupBy("fingerprint").agg(F.min("first").alias("first")))
    kept = fingerprint_groups(firsts).groupBy("group").agg(F.min("first").alias("first"))
    names = free_names(docs, "_stamp", "_second_stamp", "_rank")
    *marks, rank = names
    kept = cut(kept.select(*[F.col(f"first.s{i}").alias(m) for i, m in enumerate(marks)]))
    one = Window.partitionBy(*marks).orderBy(F.lit(0))
    stamped = docs.withColumns(dict(zip(marks, stamps, strict=True)))
    alone = stamped.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1)
    return alone.join(kept, marks, "left_semi").select(*docs.columns)
