"""Phrases whose words come together more often than their parts would have it, per group.

1. Words are counted per group. A word's id is a hash of group and word, cut to about twice as
   many bits as the vocabulary's size has, and the hash's seed is raised until no two words of
   the whole vocabulary share an id: ids need no table in the tasks and are still unique.
2. Every task counts its n-grams in counting quotient filters (:mod:`silverline.llm.quotient`),
   sorted and divided into shards by the first bits of the quotient. Shards are even whatever
   the text: a phrase that is everywhere is one entry of each block. Blocks of a shard are
   merged; the permutation is undone, and what occurs often enough keeps its ids. Words that are
   surely rarer than a candidate has to be end a piece: a bit for each of 2^24 values of an id's
   last bits says whether any frequent word has it, 2 MB whatever the vocabulary.
3. Parts are looked up among the frequent words and phrases: a phrase is no more frequent
   than its parts, so they are all there. Words that are part of very many phrases are split
   in that join. Everything from here on is SQL functions with exact decimals.

The number of shards follows from the number of words, so that a task merges about
``SHARD_WORDS`` entries at any size.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import quotient
from silverline.llm.shared import cut, map_batches
from silverline.operators.joins import hot_keys, lookup_join

LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
SCALE = 1_000_000
UNKNOWN = "und"
# Words that a task counts together, entries that a merging task gets about, and the least number of shards (as bits).
BUFFER, SHARD_WORDS, SHARD_BITS = 1_000_000, 2_000_000, 6
# Bits of an id that the map of frequent words goes by.
MAP_BITS = 24
# Parts that the ranking of a group is first made in.
RANK_PARTS = 64
# Distinct words of a task's table of ids, or of a task's counts, before it starts anew.
TABLE = 500_000
END_OF_PIECE, NO_WORD = b"\n", np.uint64(2**64 - 1)
RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
# A-Z become a-z, the marks that end a piece a line end, a tab a blank.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)


def pieces(text: str | None) -> list[list[bytes]]:
    """The words of every piece of a text that has any."""
    lines = (text or "").encode().translate(_NORMAL).split(END_OF_PIECE)
    return [words for words in map(bytes.split, lines) if words]


def word_id(word: bytes, group: str, attempt: int, bits: int) -> int:
    """What :func:`id_column` gives: XXH64 of the number of the attempt, the group and the word, one seeding the next."""
    return _Ids(group, attempt, bits)[word]


def id_column(attempt: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(attempt).cast("long"), F.col("lang"), F.col("word")), 64 - bits)


class _Ids(dict):
    """Ids by word, worked out when first asked for."""

    def __init__(self, group: str, attempt: int, bits: int):
        import xxhash

        super().__init__({END_OF_PIECE: NO_WORD})
        self._digest, self._shift = xxhash.xxh64_intdigest, 64 - bits
        self._seed = xxhash.xxh64_intdigest(group.encode(), xxhash.xxh64_intdigest(struct.pack("<q", attempt), 42))

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self._digest(word, self._seed) >> self._shift
        return found


def _grouped(docs: DataFrame, text: str, group: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(group).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").alias("text")
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word`` and ``f``, how often the word occurs, for rows of ``lang`` and ``text``."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, own in counts.items() for _ in own]
        words = pa.array([w for own in counts.values() for w in own], pa.binary()).cast(pa.string())
        f = pa.array([f for own in counts.values() for f in own.values()], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), words, f], names=["lang", "word", "f"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = counts.setdefault(lang, Counter())
                for words in pieces(text.as_py()):
                    own.update(words)
                if len(own) > TABLE:
                    yield rows({lang: counts.pop(lang)})
            if len(counts) > 1 and sum(map(len, counts.values())) > TABLE:
                yield rows(counts)
                counts = {}
        yield rows(counts)

    found = map_batches(docs, counted, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def with_ids(words: DataFrame) -> tuple[DataFrame, int, int]:
    """The vocabulary with an ``id`` that no two of its rows share, and the attempt and bits that gave it."""
    bits = min(62, max(32, 2 * words.count().bit_length() + 4))
    attempt = 0
    while True:
        numbered = words.withColumn("id", id_column(attempt, bits))
        if numbered.groupBy("id").count().where("count > 1").isEmpty():
            return numbered, attempt, bits
        attempt += 1


def frequency_map(numbered: DataFrame, least: int) -> np.ndarray:
    """For every value of an id's last bits, whether a word that occurs ``least`` times may have it."""
    slot = F.col("id").bitwiseAND((1 << MAP_BITS) - 1) + 1  # bitmaps number their bits from 1
    rows = (
        numbered.where(F.col("f") >= least)
        .select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    each = 1 << 15  # bits of one bitmap
    whole = np.zeros(1 << MAP_BITS, dtype=bool)
    for row in rows:
        begin = (row["bucket"] - 1) * each
        whole[begin : begin + each] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
    return np.packbits(whole)


def frequent_phrases(
    docs: DataFrame,
    attempt: int,
    bits: int,
    words: int,
    longest: int = LONGEST,
    least: int = LEAST,
    frequent: np.ndarray | None = None,
) -> DataFrame:
    """``ids`` and ``f`` of all phrases of 2 to ``longest`` words that occur ``least`` times.

    ``words``: how many all texts have, about; ``frequent``: a :func:`frequency_map`.
    """
    low = np.uint64((1 << MAP_BITS) - 1)
    shard_bits = max(SHARD_BITS, (words // SHARD_WORDS).bit_length())

    def blocks_of(ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if frequent is not None:
            ids = np.where(np.unpackbits(frequent)[ids & low], ids, NO_WORD)
        for size in range(2, longest + 1):
            columns = [ids[i : len(ids) - size + 1 + i] for i in range(size)]
            whole = np.logical_and.reduce([c != NO_WORD for c in columns])
            width = quotient.shape(size, bits)[1]
            lanes = quotient.permute(quotient.pack([c[whole] for c in columns], bits), width)
            lanes, counts = quotient.summed(lanes, np.ones(len(lanes[0]), dtype=np.int64))
            bounds = quotient.shard_bounds(lanes, width, shard_bits)
            shards = np.flatnonzero(np.diff(bounds))
            blocks = [
                quotient.encode([lane[a:b] for lane in lanes], counts[a:b], width, shard_bits)
                for a, b in zip(bounds[shards].tolist(), bounds[shards + 1].tolist(), strict=True)
            ]
            sizes = pa.array(np.full(len(shards), size, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [sizes, pa.array(shards, pa.int64()), pa.array(blocks, pa.binary())], names=["size", "shard", "block"]
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, _Ids] = {}
        waiting: list[np.ndarray] = []
        total = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in tables or len(tables[lang]) > TABLE:
                    if len(tables) > 1 and sum(map(len, tables.values())) > TABLE:
                        tables.clear()
                    tables[lang] = _Ids(lang, attempt, bits)
                found: list[bytes] = []
                for own in pieces(text.as_py()):
                    if len(own) > 1:
                        found += own
                        found.append(END_OF_PIECE)
                waiting.append(np.fromiter(map(tables[lang].__getitem__, found), dtype=np.uint64, count=len(found)))
                total += len(found)
                if total >= BUFFER:
                    yield from blocks_of(np.concatenate(waiting))
                    waiting, total = [], 0
        if total:
            yield from blocks_of(np.concatenate(waiting))

    def merged(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        size, shard = (k.as_py() for k in key)
        lanes, width = quotient.shape(size, bits)
        entries, counts = quotient.merge(group.column("block").to_pylist(), lanes, width, shard, shard_bits)
        often = counts >= least
        own = quotient.unpack(quotient.restore([lane[often] for lane in entries], width), size, bits)
        flat = np.column_stack(own).astype(np.int64).ravel()
        ids = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size), pa.int32()), pa.array(flat))
        return pa.Table.from_arrays([ids, pa.array(counts[often])], names=["ids", "f"])

    blocks = map_batches(docs, counted, "size int, shard long, block binary")
    return blocks.groupBy("size", "shard").applyInArrow(merged, "ids array<bigint>, f long")


def _parts(longest: int) -> dict[int, list[tuple[int, int]]]:
    """The parts (first word, words) that a phrase of so many words needs: both sides of each cut, and every word."""
    return {
        m: sorted({(0, k) for k in range(1, m)} | {(k, m - k) for k in range(1, m)} | {(k, 1) for k in range(m)})
        for m in range(2, longest + 1)
    }


def _scored(phrases: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """``ids``, ``a``, ``lang``, ``phrase``, ``l``, ``r``, ``score`` and ``longer``, the count of the most frequent longer phrase around."""
    parts = _parts(longest)
    lookup = phrases.select(
        F.col("ids").alias("part"), "f", F.lit(None).cast("string").alias("word"), F.lit(None).cast("string").alias("lang")
    ).unionByName(words.select(F.array("id").alias("part"), "f", "word", "lang"))
    wanted = reduce(
        lambda rest, m: F.when(F.size("ids") == m[0], F.array(*[F.struct(F.lit(a).alias("at"), F.lit(k).alias("k")) for a, k in m[1]])).otherwise(rest),
        parts.items(),
        F.array().cast("array<struct<at:int,k:int>>"),
    )
    asked = phrases.select("ids", F.col("f").alias("a"), F.explode(wanted).alias("p")).select(
        "ids", "a", "p.at", "p.k", F.slice("ids", F.col("p.at") + 1, F.col("p.k")).alias("part")
    )
    asked = asked.withColumn("spread", F.xxhash64("ids"))
    found = lookup_join(asked, lookup, "part", hot=hot_keys(asked, "part"), spread_by="spread").drop("part", "spread")
    # A phrase inside a longer one is inside one that is longer by a word and no rarer.
    inner = phrases.where(F.size("ids") > 2).select(
        F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"),
        F.col("f").alias("longer"),
    )
    every = sorted({p for own in parts.values() for p in own})
    at = lambda a, k: (F.col("at") == a) & (F.col("k") == k)
    together = found.unionByName(inner, allowMissingColumns=True).groupBy("ids").agg(
        F.max("a").alias("a"),
        F.max("lang").alias("lang"),
        F.max("longer").alias("longer"),
        *[F.max(F.when(at(a, k), F.col("f"))).alias(f"f_{a}_{k}") for a, k in every],
        *[F.max(F.when(at(i, 1), F.col("word"))).alias(f"w_{i}") for i in range(longest)],
    )
    whole = "cast({} as decimal(15,0))"
    cuts = []
    for m in range(2, longest + 1):
        for k in range(1, m):
            left, right = f"f_0_{k}", f"f_{k}_{m - k}"
            score = f"({whole.format('a')} * {whole.format('a')} * {SCALE}BD) div ({whole.format(left)} * {whole.format(right)})"
            cuts.append(
                f"if(size(ids) = {m}, struct({score} AS score, {k} AS k, {left} AS l, {right} AS r), NULL)"
            )
    best = F.least(*[F.expr(c) for c in cuts]) if len(cuts) > 1 else F.expr(cuts[0])
    return together.withColumn("cut", best).select(
        "a", "lang", "longer", F.concat_ws(" ", *[f"w_{i}" for i in range(longest)]).alias("phrase"), "cut.l", "cut.r", "cut.score"
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
) -> DataFrame:
    """The ``top`` phrases of each group by falling score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A text is lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs.
    Candidates are phrases of 2 to ``longest`` words that occur ``a >= least`` times within pieces of a group. The cut of a
    candidate into parts that occur ``l`` and ``r`` times with the lowest ``floor(1,000,000 a² / (l r))`` gives its score (ties: the
    shortest first part). A candidate is dropped when a longer one around it occurs at least ``share`` percent as often. Ties of
    the score go to the greater ``a``, then the lesser phrase in byte order. ``n``: all words of the group. NULL groups are
    ``und``; NULL and empty texts have no words; repeated rows count each time; tables without words give no rows; other
    columns do not matter.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words at least and occur")
    spark = docs.sparkSession
    docs = _grouped(docs, text, group)
    vocabulary = cut(word_counts(docs))
    n = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    total = vocabulary.agg(F.sum("f")).first()[0]
    if not total:
        return spark.createDataFrame([], RESULT)
    numbered, attempt, bits = with_ids(vocabulary)
    frequent = frequency_map(numbered, least)
    phrases = cut(frequent_phrases(docs, attempt, bits, total, longest, least, frequent))
    scored = _scored(phrases, numbered.where(F.col("f") >= least), longest)
    kept = scored.where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    # The best of each part of a group, then the best of those: no task gets a whole group.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    for by in (["lang", part], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        kept = kept.withColumn("rank", place).where(F.col("rank") <= top)
    ranked = kept
    schema = T.StructType.fromDDL(RESULT)
    return ranked.join(n, "lang").select(*[F.col(f.name).cast(f.dataType) for f in schema])
