"""Quality classifier by positive-unlabelled learning.

Trusted positives are learnable rows labelled 1; the unlabelled set is learnable corpus text
that has no label at all.  Rows labelled 0 take no part.  A logistic model over binned text statistics minimises the non-negative
unbiased risk::

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

When the second term is negative (the model has begun to explain single unlabelled rows),
the step ascends it instead of descending.

The class prior is estimated from the unlabelled rows.  For any region A of the scores,
``U(A) = prior * P(A) + (1 - prior) * N(A) >= prior * P(A)``, so ``U(A) / P(A)`` is never less
than the prior, and comes close where negatives are rare.  A model of one half of the
positives against one half of the unlabelled rows gives the scores, the other halves give
``P(A)`` and ``U(A)``, and the least ratio over the regions above a threshold is the estimate.

Both training sets are bounded samples: the ``sample`` rows with the smallest id hashes.
Every row is scored, on its whole text, in a narrow map over the scan.

Defined results
    * null and empty texts have all statistics 0 and are scored like any text;
    * a null id is never learned from and counts as held out;
    * without a trusted positive nothing can be learned: the score is 0.5 for every row;
    * repeated labels of one id count once (the smallest value); other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, hash_fraction, ship

RESULT = "doc_id long, held_out boolean, score double, predicted int"
N_STATS = 18

_KINDS: list[np.ndarray] = []
_LOWER, _UPPER, _LETTER, _DIGIT, _SPACE, _BREAK, _END, _SYMBOL = range(8)


def _kind_table() -> np.ndarray:
    """The kind of each code point (made once per process)."""
    if not _KINDS:
        def kind(c: str) -> int:
            if c == "\n":
                return _BREAK
            if c.isspace():
                return _SPACE
            if c.islower():
                return _LOWER
            if c.isupper():
                return _UPPER
            if c.isalpha():
                return _LETTER
            if c.isdigit():
                return _DIGIT
            return _END if c in ".,;:?'\"-()" else _SYMBOL
        _KINDS.append(np.fromiter((kind(chr(i)) for i in range(0x110000)), np.uint8, 0x110000))
    return _KINDS[0]


def text_statistics(text: str | None) -> np.ndarray:
    """Statistics of a whole text: character kinds, words, lines and repetition."""
    out = np.zeros(N_STATS)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(codes)
    kinds = np.bincount(_kind_table()[codes], minlength=8)
    words, lines = text.split(), text.split("\n")
    n_words = max(1, len(words))
    distinct = len(set(words))
    seen = Counter(lines)
    out[0] = np.log1p(n)
    out[1:9] = kinds / n
    out[9] = kinds[_UPPER] / max(1, kinds[_UPPER] + kinds[_LOWER] + kinds[_LETTER])
    out[10] = sum(map(len, words)) / n_words
    out[11] = distinct / n_words
    out[12] = np.log1p(n_words) - np.log1p(distinct)
    out[13] = np.log1p(n_words / len(lines))
    out[14] = len(seen) / len(lines)
    out[15] = sum(len(k) * (v - 1) for k, v in seen.items()) / n
    out[16] = sum(1 for w in words if not w[-1].isalnum()) / n_words
    out[17] = len(zlib.compress(raw, 1)) / len(raw)
    return out


@dataclass
class QualityModel:
    edges: list[np.ndarray]            # inner bin edges of each statistic
    weights: np.ndarray                # one per bin of each statistic
    bias: float

    def design(self, stats: np.ndarray) -> np.ndarray:
        """One column per bin; a row is shared between its two nearest bin edges."""
        columns = []
        for k, edges in enumerate(self.edges):
            x = stats[:, k]
            at = np.clip(np.searchsorted(edges, x, side="right"), 0, len(edges))
            hot = np.zeros((len(x), len(edges) + 1))
            hot[np.arange(len(x)), at] = 1.0
            columns.append(hot)
        return np.concatenate(columns, axis=1)

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(stats), 0.5)
        return 1.0 / (1.0 + np.exp(-np.clip(self.design(stats) @ self.weights + self.bias, -40, 40)))


def bin_edges(stats: np.ndarray, bins: int = 24) -> list[np.ndarray]:
    """Distinct quantiles of each statistic, with extra ones in both tails."""
    q = np.unique(np.concatenate([np.linspace(0, 1, bins + 1)[1:-1],
                                  [0.002, 0.005, 0.01, 0.02, 0.98, 0.99, 0.995, 0.998]]))
    return [np.unique(np.quantile(stats[:, k], q)) for k in range(stats.shape[1])]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def risk_slope(xp: np.ndarray, xu: np.ndarray, w: np.ndarray, b: float, prior: float,
               ascent: float) -> tuple[float, np.ndarray]:
    """The negative part of the risk, and the direction to step against: the slope of the
    whole risk, or ``-ascent`` times the slope of the negative part where that is below 0."""
    gp, gu = xp @ w + b, xu @ w + b
    # l(g) = log(1 + e^-g); its slope is -sigmoid(-g)
    pos = -_sigmoid(-gp) / len(gp) * prior
    neg_u, neg_p = _sigmoid(gu) / len(gu), _sigmoid(gp) / len(gp) * prior
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    slope = np.concatenate([xu.T @ neg_u - xp.T @ neg_p, [neg_u.sum() - neg_p.sum()]])
    if negative < 0:
        return negative, -ascent * slope
    return negative, slope + np.concatenate([xp.T @ pos, [pos.sum()]])


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 900,
           rate: float = 0.05, l2: float = 1e-4, ascent: float = 0.5) -> QualityModel:
    """Minimise the non-negative risk with Adam on the full sample."""
    if not len(positive) or not len(unlabelled):
        return QualityModel([], np.empty(0), 0.0)
    model = QualityModel(bin_edges(np.concatenate([positive, unlabelled])), np.empty(0), 0.0)
    xp, xu = model.design(positive), model.design(unlabelled)
    w, b = np.zeros(xp.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        _, slope = risk_slope(xp, xu, w, b, prior, ascent)
        slope[:-1] += l2 * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    model.weights, model.bias = w, float(b)
    return model


def least_ratio(positive: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.5) -> float:
    """Least ``U(score >= t) / P(score >= t)`` over thresholds that keep ``least_share`` of the
    positives: an estimate, from above, of the share of positives among the unlabelled."""
    p, u = np.sort(positive), np.sort(unlabelled)
    t = np.unique(np.quantile(p, np.linspace(0, 1 - least_share, 161)))
    above = lambda x: 1 - np.searchsorted(x, t, side="left") / len(x)
    share = above(p)
    ok = share >= least_share - 1e-9
    return float((above(u)[ok] / share[ok]).min())


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled rows."""
    if len(positive) < 20 or len(unlabelled) < 2:
        return 0.5
    against = fit_pu(positive[::2], unlabelled[::2], 0.5, steps=300)
    ratio = least_ratio(against.scores(positive[1::2]), against.scores(unlabelled[1::2]))
    return float(min(0.99, max(0.01, ratio)))


def _statistics(rows: DataFrame, keep: list[str], schema: str) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            stats = [text_statistics(t).tolist() for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(len(keep))),
                 pa.array(stats, pa.list_(pa.float64()))], [*keep, "stats"])
    return rows.select(*keep, "text").mapInArrow(run, schema)


def _smallest_hashes(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` ids with the smallest hashes.  So few pass the first filter that the task
    which ranks them reads about ``2 * n`` rows, however large the table is."""
    few = rows.where(hash_fraction("doc_id") * rows.count() < 2 * n + 1000)
    return few.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> QualityModel:
    """Fit on learnable documents ``(doc_id, text)`` and labels ``(doc_id, quality)``, of which
    only the ones are used, and the others to tell which documents are not unlabelled."""
    ids = docs.select("doc_id")
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ones = _smallest_hashes(known.where("quality = 1").join(ids, "doc_id", "left_semi"), sample)
    some = _smallest_hashes(ids.join(known.select("doc_id"), "doc_id", "left_anti"), sample)
    # both id lists hold at most `sample` rows
    tagged = (ones.select("doc_id", F.lit(1).alias("p"))
              .unionByName(some.select("doc_id", F.lit(0).alias("p")))
              .groupBy("doc_id").agg(F.max("p").alias("p"), F.min("p").alias("u")))
    rows = _statistics(docs.join(F.broadcast(tagged), "doc_id"), ["doc_id", "p", "u"],
                       "doc_id long, p int, u int, stats array<double>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["stats"]))
    stats = np.array([r["stats"] for r in rows]).reshape(len(rows), N_STATS)
    p = np.array([r["p"] == 1 for r in rows], bool)
    u = np.array([r["u"] == 0 for r in rows], bool)
    prior = estimate_prior(stats[p], stats[u])
    return fit_pu(stats[p], stats[u], prior)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``(doc_id, text, held_out)`` to scores; a narrow map over the scan."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)      # a few hundred numbers

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = shared.value
        for b in batches:
            stats = np.array([text_statistics(t) for t in b.column(1).to_pylist()])
            p = m.scores(stats.reshape(b.num_rows, N_STATS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(p, pa.float64()),
                 pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, RESULT)


def classify_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1,
                     **options) -> DataFrame:
    """Fit on the rows outside ``fold`` and score every row of ``docs``."""
    ship(docs.sparkSession)
    outside = F.coalesce(crc_mod("doc_id", folds) != fold, F.lit(False))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                      (~outside).alias("held_out"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("quality").cast("int").alias("quality"))
    model = fit(own.where(~F.col("held_out")).select("doc_id", "text"),
                known.where(outside & F.col("quality").isNotNull()), **options)
    return score(own, model)
