"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained with follow-the-regularised-leader and elastic-net penalties, then
calibrated with one temperature.

Features are the character 1- to 3-grams of the lower-cased letters (every run of other
characters is one boundary mark), hashed into ``2 ** bits`` columns; a value is
``(1 + log count) * idf``, scaled to unit length.  Document frequencies are counted over
every learnable document.  The weights are fitted on a bounded sample: of each language
the ``per_language`` learnable documents with the smallest id hashes.  One fifth of that
sample is kept for the temperature.

What reaches the driver is bounded by ``2 ** bits`` (document frequencies, summed in two
steps) and by ``per_language`` feature rows a language; documents never do.

Defined results
    * null text, or text without a letter: ``und`` with score 0;
    * if nothing is learnable (empty table, no labels): every row is ``und``, score 0;
    * only one learnable language: every text with letters gets it, score 1;
    * a null id is never learned from and counts as held out;
    * texts of any length are read whole; repeated rows and other columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, hash_fraction, ship

RESULT = "doc_id long, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Whether each code point is a letter (made once per process)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngram_counts(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Columns and counts of a text's n-grams; None if it has no letter."""
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.where(_letter_table()[c], c, np.uint32(32))
    mark = c == 32
    if mark.all():
        return None
    keep = np.ones(len(c), bool)
    keep[1:] = ~(mark[1:] & mark[:-1])          # one mark for a run of other characters
    c = np.concatenate([[32], c[keep], [32]]).astype(np.uint32)
    m1, m2, m3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
    shift = np.uint32(32 - bits)
    one = c * m1
    two = (one[:-1] ^ (c[1:] * m2)) * m3
    three = (two[:-1] ^ (c[2:] * m2)) * m1
    counts = np.bincount(np.concatenate([one, two, three]) >> shift, minlength=1 << bits)
    at = np.flatnonzero(counts)
    return at, counts[at]


def tfidf(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1.0 + np.log(counts)) * idf[at]
    return v / np.sqrt(v @ v)


@dataclass
class Ftrl:
    """Follow-the-regularised-leader (proximal) for a multinomial logistic model."""
    columns: int
    classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    def __post_init__(self):
        self.z = np.zeros((self.columns, self.classes))
        self.n = np.zeros((self.columns, self.classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0,
                        shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(v @ w)
        error[label] -= 1.0
        g = v[:, None] * error[None, :]
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least mean log loss, from a fine logarithmic grid.

    Targets are smoothed by one imagined row per class, so a calibration sample without
    errors does not ask for endless confidence.
    """
    n, k = logits.shape
    spread = 1.0 / (n + k)

    def loss(t):
        log_p = np.log(np.maximum(softmax(logits / t), 1e-300))
        own = log_p[np.arange(n), labels].mean()
        return -((1.0 - k * spread) * own + spread * log_p.sum(axis=1).mean())
    return float(min(np.geomspace(0.02, 20, 200), key=loss))


@dataclass
class LanguageModel:
    languages: list[str]
    bits: int
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        found = ngram_counts(text, self.bits)
        if found is None or not self.languages:
            return UNKNOWN, 0.0
        at, counts = found
        p = softmax(tfidf(at, counts, self.idf) @ self.weights[at] / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def document_frequencies(texts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """In how many texts each column occurs, and the number of texts with letters.

    Each task sums its texts, then about sqrt(tasks) tasks sum those, so neither a task
    nor the driver receives more than a few hundred such rows at a time.
    """
    size = 1 << bits

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total = np.zeros(size + 1, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                found = ngram_counts(t, bits)
                if found is not None:
                    total[found[0]] += 1
                    total[size] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["df"])

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total = np.zeros(size + 1, np.int64)
        for b in batches:
            for row in b.column(0).to_pylist():
                total += np.frombuffer(row, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["df"])

    parts = texts.mapInArrow(count, "df binary")
    tasks = texts.rdd.getNumPartitions()
    summed = parts.repartition(max(1, round(tasks ** 0.5))).mapInArrow(add, "df binary")
    total = np.zeros(size + 1, np.int64)
    for r in summed.toLocalIterator():
        total += np.frombuffer(r["df"], np.int64)
    return total[:size], int(total[size])


def sample_features(learn: DataFrame, bits: int, per_language: int) -> list[tuple]:
    """(language, columns, counts) of the sample: per language the documents with the
    smallest id hashes, found by ids alone (map-side limit) before any text is read."""
    # so few of a language's documents pass the first filter that ranking them is cheap
    counts = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lang"))     # a row a language
    few = (learn.select("doc_id", "lang").join(F.broadcast(counts), "lang")
           .where(hash_fraction("doc_id") * F.col("n_lang") < 2 * per_language + 1000))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (few.withColumn("r", F.row_number().over(order))
           .where(F.col("r") <= per_language).select("doc_id").distinct())
    chosen = learn.join(F.broadcast(ids), "doc_id", "left_semi")   # per_language rows a language

    def features(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            out = []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = ngram_counts(text, bits)
                if found is not None:
                    out.append({"lang": lang, "at": found[0].astype("<u4").tobytes(),
                                "n": found[1].astype("<u4").tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("lang", pa.string()), ("at", pa.binary()), ("n", pa.binary())]))

    rows = chosen.select("lang", "text").mapInArrow(features, "lang string, at binary, n binary")
    return sorted((r["lang"], r["at"], r["n"]) for r in rows.collect())


def fit(learn: DataFrame, bits: int = 15, per_language: int = 600, epochs: int = 3,
        seed: int = 7) -> LanguageModel:
    """Fit on documents ``(doc_id, text, lang)`` that may be learned from."""
    df, n = document_frequencies(learn.select("text"), bits)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    rows = sample_features(learn, bits, per_language)
    languages = sorted({r[0] for r in rows})
    rng = np.random.default_rng(seed)
    data = []
    for lang, at, counts in rows:
        at = np.frombuffer(at, "<u4").astype(np.int64)
        data.append((at, tfidf(at, np.frombuffer(counts, "<u4"), idf), languages.index(lang)))
    order = rng.permutation(len(data))
    held = order[: len(data) // 5]
    model = Ftrl(1 << bits, max(1, len(languages)))
    for _ in range(epochs):
        for k in rng.permutation(order[len(data) // 5:]):
            model.learn(*data[k])
    w = model.weights()
    temperature = 1.0
    if len(held) and len(languages) > 1:
        temperature = best_temperature(np.array([data[k][1] @ w[data[k][0]] for k in held]),
                                       np.array([data[k][2] for k in held]))
    return LanguageModel(languages, bits, idf, w, temperature)


def score(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, text, held_out)`` to predictions; a narrow map over the scan."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)   # 2 ** bits rows at most

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = shared.value
        for b in batches:
            found = [m.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(2),
                 pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, RESULT)


def with_fold(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Only what the operator uses, with ``held_out`` (crc32 of the id, modulo folds)."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
        F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(True)).alias("held_out"))


def identify_languages(docs: DataFrame, **options) -> DataFrame:
    """Fit on the learnable part of ``docs`` and predict for every row."""
    ship(docs.sparkSession)
    own = with_fold(docs)
    learn = own.where(~F.col("held_out") & F.col("lang").isNotNull())
    return score(own, fit(learn.select("doc_id", "text", "lang"), **options))


def keep_identified(docs: DataFrame, min_score: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs``, with all columns, whose language is known, with at least
    ``min_score``; a narrow map.

    By default the language must be likelier than all the others together; texts without a
    letter go with any ``min_score``.
    """
    spark = docs.sparkSession
    ship(spark)
    learn = with_fold(docs).where(~F.col("held_out") & F.col("lang").isNotNull())
    shared = spark.sparkContext.broadcast(fit(learn.select("doc_id", "text", "lang"), **options))
    at = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = shared.value
        for b in batches:
            found = [m.predict(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([lang != UNKNOWN and p >= min_score for lang, p in found],
                                    pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
