"""Document quality by co-training two views, the text and the metadata of a document.

Each view has a logistic classifier on hashed features: the words and a few proportions of
the text, or source, language and size. Both start from labelled documents. In every round
each scores all unlabelled documents and gives those of every language and source of which it is
most certain to the other as pseudo-labelled examples, in the proportion of good and bad among
the labels, and both learn anew. Each is then calibrated on labelled documents held out from learning, and the
calibrated log-odds are added, less the prior they share.

Features of all documents are computed once for learning. Only fitting uses a sample: at most about
``LABELLED`` labelled documents, by a hash of the key, and what the views hand over, of which the
feature numbers (not the texts) come to the driver. Every document is scored, whole, in its
own row and without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.decontaminate import words
from silverline.llm.shared import cut, map_batches, without
from silverline.operators.joins import hot_keys, lookup_join

BUCKETS = 1 << 15
LABELLED = 8000
STRATA, POOL = 64, 8  # classes of language and source; documents of one that a view hands over in a round
ROUNDS = 2
SPLIT = 64  # parts in which the documents of a stratum are ranked
EPOCHS, RATE, DECAY = 100, 1.0, 1e-3
EVIDENCE = 20.0  # squared standard deviations from chance at which a feature counts a quarter
COLUMNS = ("text_score", "meta_score", "score", "keep")
META = ("lang", "source", "n_chars")


def _bucket(token: bytes) -> int:
    return zlib.crc32(token) % BUCKETS


def _size(n: float) -> int:
    return int(n).bit_length()


def text_features(text: str | None) -> np.ndarray:
    """Buckets of the distinct words of the whole text, and of proportions in steps of a factor of two."""
    body = text or ""
    own = words(body)
    tokens = set(own)
    per_mille = lambda k: _size(1000 * k / max(1, len(body)))
    symbols = sum(body.count(c) for c in "#*$%&|<>")
    lines = body.split("\n")
    tokens |= {
        b"\x01symbols%d" % per_mille(symbols),
        b"\x01digits%d" % per_mille(sum(body.count(c) for c in "0123456789")),
        b"\x01lines%d" % per_mille(len(lines) - len(set(lines))),
        b"\x01distinct%d" % (10 * len(set(own)) // max(1, len(own))),
        b"\x01words%d" % _size(len(own)),
    }
    return np.unique(np.fromiter(map(_bucket, tokens), dtype=np.int32, count=len(tokens)))


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Buckets of the metadata: each column, and language with size; NULL is a value of its own."""
    size = b"none" if n_chars is None else b"%d" % _size(max(0, n_chars))
    lang_, source_ = (b"\x00" if v is None else str(v).encode() for v in (lang, source))
    tokens = {b"l" + lang_, b"s" + source_, b"n" + size, b"b", b"ln" + lang_ + b"|" + size}
    return np.unique(np.fromiter(map(_bucket, tokens), dtype=np.int32, count=len(tokens)))


class Rows:
    """Binary features of many documents, each row scaled by its size to the power -1/4."""

    def __init__(self, rows: list[np.ndarray]):
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        self.of = np.repeat(np.arange(len(rows)), sizes)
        self.bucket = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
        self.value = np.maximum(1, sizes) ** -0.25
        self.count = len(rows)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, weights[self.bucket], self.count) * self.value

    def spread(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.bucket, (errors * self.value)[self.of], BUCKETS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def evidence(rows: Rows, target: np.ndarray, used: np.ndarray) -> np.ndarray:
    """How much each feature counts, from 0 to 1, by how far its good rows are from what chance would give.

    No share of all rows is asked for: a mark of few documents, as of a small language, counts if
    they are nearly all of one kind, and one seen once or twice counts next to nothing.
    """
    n = max(1.0, float(used.sum()))
    share = float((used * target).sum()) / n
    rows_with = np.bincount(rows.bucket, used[rows.of], BUCKETS)
    good_with = np.bincount(rows.bucket, (used * target)[rows.of], BUCKETS)
    variance = rows_with * share * (1 - share) * (1 - rows_with / (n + 1))
    squared = (good_with - rows_with * share) ** 2 / np.maximum(variance, 1e-9) * (rows_with > 0)
    return (squared / (squared + EVIDENCE)) ** 2


def fit(rows: Rows, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier, by adaptive gradient steps over all rows.

    Features are scaled by their evidence, so that words of few rows cannot be learned by heart.
    """
    w, bias = np.zeros(BUCKETS), 0.0
    scale = evidence(rows, target, weight > 0)
    seen, seen_bias = np.full(BUCKETS, 1e-8), 1e-8
    total = max(1.0, weight.sum())
    for _ in range(EPOCHS):
        error = (_sigmoid(rows.dot(w * scale) + bias) - target) * weight / total
        step, step_bias = rows.spread(error) * scale + DECAY * w / total, float(error.sum())
        seen += step**2
        seen_bias += step_bias**2
        w -= RATE * step / np.sqrt(seen)
        bias -= RATE * step_bias / np.sqrt(seen_bias)
    return w * scale, bias


def calibrate(scores: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into log-odds (Newton steps, with a weak prior on both)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * scores + b)
        v = p * (1 - p)
        gradient = np.array([((p - target) * scores).sum() + 0.1 * (a - 1), (p - target).sum() + 0.1 * b])
        hessian = np.array([[(v * scores**2).sum() + 0.1, (v * scores).sum()], [(v * scores).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass(frozen=True)
class Model:
    """Two calibrated views and the prior log-odds; ``views`` is empty where nothing could be learned."""

    views: tuple[tuple[np.ndarray, float, float, float], ...] = ()
    prior: float = 0.0

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[float, float, float]:
        if not self.views:
            return 0.5, 0.5, 0.5
        odds = []
        for (weights, bias, slope, offset), own in zip(self.views, (text, meta), strict=True):
            raw = weights[own].sum() * max(1, len(own)) ** -0.25 + bias
            odds.append(slope * raw + offset)
        both = np.array([odds[0], odds[1], odds[0] + odds[1] - self.prior])
        first, second, joint = _sigmoid(both).tolist()
        return first, second, joint


@dataclass(frozen=True)
class Example:
    """Features of both views, what is known of the document (1 good, 0 bad) and its mark."""

    text: np.ndarray
    meta: np.ndarray
    good: float
    mark: int = 0


Weights = list[tuple[np.ndarray, float]]


def co_train(
    labelled: list[Example], held: list[Example], hand_over: Callable[[Weights, list[set[int]]], list[list[Example]]], rounds: int = ROUNDS
) -> Model:
    """A model from labelled examples, those ``held`` for calibration only, and pseudo-labelled ones.

    ``hand_over(views, known)`` gives the examples that each view has for the other; ``known`` are the
    marks of those that a view has already been handed.
    """
    if len({e.good for e in labelled}) < 2:
        return Model()
    handed: list[list[Example]] = [[], []]
    columns = (lambda e: e.text, lambda e: e.meta)

    def fitted() -> Weights:
        result = []
        for column, more in zip(columns, handed, strict=True):
            own = [*labelled, *more]
            result.append(fit(Rows(list(map(column, own))), np.array([e.good for e in own]), np.ones(len(own))))
        return result

    views = fitted()
    for _ in range(rounds):
        found = hand_over(views, [{e.mark for e in more} for more in handed])
        if not any(found):
            break
        for mine, examples in enumerate(found):
            handed[1 - mine] += examples
        views = fitted()
    test = held or labelled
    target = np.array([e.good for e in test])
    result = []
    for column, (w, bias) in zip(columns, views, strict=True):
        slope, offset = calibrate(Rows(list(map(column, test))).dot(w) + bias, target)
        result.append((w, bias, slope, offset))
    prior = min(max(float(target.mean()), 0.01), 0.99)
    return Model(tuple(result), float(np.log(prior / (1 - prior))))


def _buckets(value: bytes) -> np.ndarray:
    return np.frombuffer(value, dtype="<u2")


def _featured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``part``, ``stratum``, the features ``own`` and ``meta`` and their ``mark``, a hash, of every row."""
    rows = docs.select(
        F.col(key).alias("key"),
        F.pmod(F.xxhash64(F.lit("held"), F.col(key)), F.lit(4)).alias("part"),
        F.pmod(F.xxhash64(F.lit("stratum"), "lang", "source"), F.lit(STRATA)).alias("stratum"),
        F.col(text).alias("text"),
        *[F.col(m).alias(f"meta_{m}") for m in META],
    )
    empty = F.lit(b"")
    schema = rows.select("key", "part", "stratum", empty.alias("own"), empty.alias("meta")).schema

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns[:4]
            metas = zip(*(c.to_pylist() for c in batch.columns[4:]), strict=True)
            views = ([text_features(x.as_py()) for x in texts], [meta_features(*m) for m in metas])
            lists = [pa.array([x.astype("<u2").tobytes() for x in v], pa.binary()) for v in views]
            yield pa.RecordBatch.from_arrays([*kept, *lists], names=schema.names)

    return map_batches(rows, featured, schema).withColumn("mark", F.xxhash64("own", "meta"))


def _most_certain(
    featured: DataFrame, labelled: DataFrame, hot: DataFrame, views: Weights, known: list[set[int]], good: float, pool: int
) -> list[list[Example]]:
    """What each view hands over: its most certain documents without a label, up to ``pool`` of a stratum.

    Every unlabelled row is scored. Of equal documents one is a candidate. What reaches the driver
    is at most ``2 * STRATA * pool`` rows of two bytes per feature, whatever the corpus.
    """
    shared = featured.sparkSession.sparkContext.broadcast((views, known))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, seen = shared.value
        taken = [np.array(sorted(s), dtype=np.int64) for s in seen]
        for batch in batches:
            key, stratum, mark, *features = batch.columns
            columns = [key, stratum, mark]
            for mine, (column, (w, bias)) in enumerate(zip(features, models, strict=True)):
                odds = Rows([_buckets(x.as_py()) for x in column]).dot(w) + bias
                odds[np.isin(mark.to_numpy(), taken[1 - mine])] = 0.0  # the other view has it already
                columns.append(pa.array(odds))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "stratum", "mark", "odds0", "odds1"])

    narrow = featured.select("key", "stratum", "mark", "own", "meta")
    schema = narrow.select("key", "stratum", "mark", F.lit(0.0).alias("odds0"), F.lit(0.0).alias("odds1")).schema
    odds = map_batches(narrow, scored, schema)
    marked = labelled.select("key", F.lit(True).alias("labelled"))
    with_key = lookup_join(odds.where("key IS NOT NULL"), marked, "key", "left", hot=hot, spread_by="mark")
    free = with_key.where("labelled IS NULL").drop("labelled").unionByName(odds.where("key IS NULL"))
    each = free.groupBy("stratum", "mark").agg(F.first("odds0").alias("odds0"), F.first("odds1").alias("odds1"))
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("view"), F.col(f"odds{i}").alias("odds")) for i in (0, 1)]))
    # Only where the view is sure: on the right side of even odds.
    sides = each.select("stratum", "mark", sides.alias("side")).select("stratum", "mark", "side.*").where("odds <> 0")
    # Ranked in parts first, so that the last ranking gets at most SPLIT * pool rows a group from any number of tasks.
    group, order = ("view", "stratum", F.col("odds") > 0), (F.abs("odds").desc(), "mark")
    within = Window.partitionBy(*group, F.pmod("mark", F.lit(SPLIT))).orderBy(*order)
    sides = sides.withColumn("place", F.row_number().over(within)).where(F.col("place") <= pool)
    best = Window.partitionBy(*group).orderBy(*order)
    share = F.when(F.col("odds") > 0, max(1, round(good * pool))).otherwise(max(1, round((1 - good) * pool)))
    picked = sides.withColumn("place", F.row_number().over(best)).where(F.col("place") <= pool).where(F.col("place") <= share)
    picked = cut(picked.select("stratum", "mark", "view", (F.col("odds") > 0).cast("double").alias("good")))
    whole = featured.select("stratum", "mark", "own", "meta").join(F.broadcast(picked), ["stratum", "mark"])
    rows = whole.groupBy("view", "stratum", "mark").agg(*[F.first(c).alias(c) for c in ("good", "own", "meta")])
    found: list[list[Example]] = [[], []]
    for r in rows.orderBy("view", "stratum", "mark").collect():
        found[r["view"]].append(Example(_buckets(r["own"]), _buckets(r["meta"]), r["good"], r["mark"]))
    return found


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", labelled: int = LABELLED, pool: int = POOL
) -> Model:
    """A model of ``docs`` and ``labels`` (``quality``, ``toxic``): good is quality 1 and not toxic.

    Several labels of a document count as the worst of them; NULL labels and keys are not used.
    Of several rows with one key, that with the least hash of its features is learned. In each round
    all rows without a label are candidates, and a view hands over at most ``pool`` of a stratum
    (language and source, in ``STRATA`` classes), so rare ones take part, in the labels' proportion
    of good and bad. Without labels of both kinds every document scores one half and is kept.
    """
    marks = (
        labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("double").alias("good"))
    )
    featured = cut(_featured(docs, key, text))
    present = cut(featured.select("key").distinct().join(marks, "key"))
    draw = F.pmod(F.xxhash64(F.lit("cotraining"), F.col("key")), F.lit(1 << 30)) / (1 << 30)
    # Keys of the sample: at most about ``labelled`` rows, which is the bound of the broadcast.
    chosen = present.where(draw < labelled / max(1, present.count()))
    least = F.min(F.struct("mark", "part", "good", "own", "meta")).alias("least")
    rows = featured.join(F.broadcast(chosen), "key").groupBy("key").agg(least).select("least.*")
    parts: tuple[list[Example], list[Example]] = ([], [])
    for r in rows.orderBy("mark", "part").collect():
        parts[r["part"] == 0].append(Example(_buckets(r["own"]), _buckets(r["meta"]), r["good"], r["mark"]))
    if not parts[0]:
        return Model()
    good = float(np.mean([e.good for e in parts[0]]))
    hot = cut(hot_keys(featured, "key"))
    return co_train(*parts, lambda views, known: _most_certain(featured, present, hot, views, known, good, pool))


def score(docs: DataFrame, model: Model, text: str = "text", cutoff: float = 0.5) -> DataFrame:
    """``docs`` with ``text_score``, ``meta_score``, ``score`` (0 to 1) and ``keep`` (score at least ``cutoff``).

    NULL and empty texts have the proportions of an empty text and no words. Rows are scored one
    by one, so repeated rows and keys stay. Existing columns of the four names are replaced; an
    empty table gives no rows.
    """
    docs = without(docs, *COLUMNS)
    names = docs.columns
    at, meta = names.index(text), [names.index(c) for c in META]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two weights per bucket, whatever the corpus

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            metas = zip(*(batch.column(i).to_pylist() for i in meta), strict=True)
            found = [
                known.scores(text_features(x.as_py()), meta_features(*m)) for x, m in zip(batch.column(at), metas, strict=True)
            ]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in range(3)]
            kept = pa.array([f[2] >= cutoff for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, kept], names=[*names, *COLUMNS])

    schema = docs.select("*", *[F.lit(0.0).alias(c) for c in COLUMNS[:3]], F.lit(True).alias(COLUMNS[3])).schema
    return map_batches(docs, scored, schema)
