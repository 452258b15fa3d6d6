"""Language identification by error-correcting output codes.

Every language gets a codeword of ``BITS`` bits, drawn from a hash of its name. For each bit
a binary classifier is learned on hashed n-grams of bytes: naive Bayes between the languages
whose codeword has the bit and the others. The weights of a text's n-grams sum to a margin
per bit; a text belongs to the codeword with the least logistic loss over the margins, and
is ambiguous when the next codeword is nearly as close. A language more costs one codeword;
the classifiers stay as many as there are bits.

Learning takes a bounded sample of labelled rows, at most about ``PER_LANGUAGE`` whole texts
of a language, chosen by a hash of the key. Their n-gram counts are added up by Spark and
have a fixed size. Every text is then predicted whole, in its own row, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.shared import LOWER, map_batches, without

BITS = 24
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
GRAMS = (2, 3, 4)
PER_LANGUAGE = 2000
LANGUAGES = 1000
# A codeword's score falls by e for each 1 / SHARPNESS of mean loss per bit; below AMBIGUOUS the best is not clear.
SHARPNESS, AMBIGUOUS = 8.0, 0.5
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# Bytes that are no ASCII letters or beyond ASCII separate words.
_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in LOWER)
CHUNK = 1 << 20  # bytes of a text that are weighed at a time


def has_letter(text: str) -> bool:
    """Whether a character is a letter, of category L; numeric signs such as '½' are words' characters, too, but no letters."""
    return any(found.group().isalpha() for found in LETTER.finditer(text))


def grams(data: np.ndarray) -> Iterator[np.ndarray]:
    """Hashed n-grams of normalised bytes: every place, each length, but for those that span two words."""
    wide = data.astype(np.uint32)
    blank = data == 32
    code = np.zeros(len(data), dtype=np.uint32)
    inner = np.zeros(len(data), dtype=bool)
    for n in range(1, max(GRAMS) + 1):
        if len(data) < n:
            return
        code = code[: len(data) - n + 1] * np.uint32(0x01000193) + wide[n - 1 :] + np.uint32(n)
        # A blank may stand at an end, where it marks a word's beginning or end, and nowhere else.
        inner = inner[: len(code)] | blank[n - 2 : len(data) - 1] if n > 2 else inner[: len(code)]
        if n in GRAMS:
            usable = ~(inner | (blank[: len(code)] & blank[n - 1 :]))
            mixed = code[usable] * np.uint32(0x9E3779B1)
            yield (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


def counts(text: str) -> np.ndarray:
    """How often each bucket of n-grams occurs in the whole text."""
    data = np.frombuffer(b" " + text.encode().translate(_TABLE) + b" ", dtype=np.uint8)
    total = np.zeros(BUCKETS, dtype=np.int64)
    overlap = max(GRAMS) - 1
    for begin in range(0, len(data), CHUNK):
        # Overlapping chunks see a few n-grams twice; that is no matter for texts of a megabyte.
        for bucket in grams(data[begin : begin + CHUNK + overlap]):
            total += np.bincount(bucket, minlength=BUCKETS)
    return total


def codeword(name: str, bits: int = BITS) -> np.ndarray:
    """A language's bits, from a hash of its name."""
    import xxhash

    digest = xxhash.xxh64_intdigest(name.encode(), seed=bits)
    digest |= xxhash.xxh64_intdigest(name.encode(), seed=bits + 1) << 64
    return np.array([digest >> b & 1 for b in range(bits)], dtype=np.int8)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    words: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # buckets x bits
    ambiguous: float = AMBIGUOUS

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the second codeword is nearly as close."""
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0, True
        seen = counts(text)
        used = np.flatnonzero(seen)
        if not len(used):
            return UNKNOWN, 0.0, True
        strength = np.sqrt(seen[used])
        margins = (strength @ self.weights[used]) / strength.sum()
        loss = np.logaddexp(0.0, -self.words * margins).mean(axis=1)
        order = np.argsort(loss, kind="stable")
        odds = np.exp(-SHARPNESS * (loss - loss[order[0]]))
        score = float(odds[order[0]] / odds.sum())
        return self.languages[order[0]], score, bool(len(order) > 1 and score < self.ambiguous)


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; NULL for a NULL key."""
    return F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(5))


def learn(
    rows: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
    bits: int = BITS,
    languages: int = LANGUAGES,
) -> Model:
    """A model of the labelled ``rows``; rows without a key, a text or a language are not used.

    At most about ``per_language`` rows of a language are taken, by a hash of the key, of the ``languages`` with
    the most rows: the model is that large, whatever free text may be in ``lang``. Without usable rows every prediction is ``und``.
    """
    usable = rows.where(F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(lang).isNotNull())
    usable = usable.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(languages)
    draw = F.pmod(F.xxhash64(F.lit("langid"), "key"), F.lit(1 << 30)) / (1 << 30)
    # ``sizes`` has at most ``languages`` rows, as the model will.
    sample = usable.join(F.broadcast(sizes), "lang").where(draw < F.lit(per_language) / F.col("rows")).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1), strict=True):
                own = total.setdefault(name.as_py(), np.zeros(BUCKETS))
                seen = counts(body.as_py())
                own += np.sqrt(seen)
        for name, values in total.items():
            used = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(values[used])],
                names=["lang", "bucket", "weight"],
            )

    # One row per language and bucket, added up before and after the shuffle: a table of fixed size.
    summed = (
        map_batches(sample.repartition(8), counted, "lang string, bucket int, weight double")
        .groupBy("lang", "bucket")
        .agg(F.sum("weight").alias("weight"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "weight")).alias("weights"))
        .orderBy("lang")
    )
    names, table = [], []
    for name, weights in summed.toLocalIterator():
        row = np.zeros(BUCKETS)
        row[[w[0] for w in weights]] = [w[1] for w in weights]
        names.append(name)
        table.append(row)
    if not names:
        return Model([], np.zeros((0, bits)), np.zeros((BUCKETS, bits), dtype=np.float32))
    shares = np.stack([row / row.sum() for row in table])
    words = np.stack([codeword(name, bits) for name in names]).astype(np.int64)
    # A bit that all languages share tells nothing; languages that no bit tells apart get one of their own.
    useful = words.min(axis=0) != words.max(axis=0)
    words = words[:, useful]
    if len(names) > 1 and len(np.unique(words, axis=0)) < len(names):
        width = max(1, (len(names) - 1).bit_length())
        numbers = (np.arange(len(names))[:, None] >> np.arange(width)) & 1
        words = np.concatenate([words, numbers], axis=1)
    smooth = 1e-6
    weights = np.zeros((BUCKETS, words.shape[1]), dtype=np.float32)
    for bit in range(words.shape[1]):
        yes, no = shares[words[:, bit] == 1], shares[words[:, bit] == 0]
        if len(yes) and len(no):
            weights[:, bit] = np.log(yes.mean(axis=0) + smooth) - np.log(no.mean(axis=0) + smooth)
    return Model(names, 2 * words - 1, weights)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``.

    NULL texts and texts without a letter are ``und`` with score 0. Nothing but the text is
    read, so repeated rows, keys and labels do not matter; columns of the three names are
    replaced; an empty table gives no rows.
    """
    names = ("lang_pred", "score", "ambiguous")
    docs = without(docs, *names)
    at, width = docs.columns.index(text), len(docs.columns)
    # The model has buckets x bits weights, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(x.as_py()) for x in batch.column(at)]
            columns = [
                *batch.columns[:width],
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:width], *names])

    schema = docs.select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(True).alias(names[2])).schema
    return map_batches(docs, predicted, schema)
