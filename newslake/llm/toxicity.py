"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words and beginnings of words is trained in numpy from
texts that are confirmed as toxic and from texts of which nothing is known. The
unlabelled texts hold an unknown share of toxic ones, so their loss as clean
texts is corrected: with the class prior ``p``, the risk is

    p * loss(toxic as toxic) + max(0, loss(unlabelled as clean) - p * loss(toxic as clean))

with the logistic loss, which makes the output a probability. Where the second
term falls below zero, the fit has begun to learn the unlabelled texts by heart,
and the step goes the other way.

The fit uses bounded samples: at most about ``POSITIVES`` toxic and
``UNLABELLED`` unlabelled texts, chosen by a hash, and at most ``FEATURES`` features: those that toxic texts have
more often than unlabelled ones by ``SURPLUS`` standard errors or more.
Everything else covers all rows.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed, to_python

cloudpickle.register_pickle_by_value(sys.modules[__name__])

POSITIVES = 6_000
UNLABELLED = 12_000
FEATURES = 4_096
PREFIXES = (4, 5, 6, 7, 8)
SURPLUS = 4.0
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_LONGEST = 24
GRAMS = (2, 3, 4)
# Letters of scripts without blanks between words: Thai and Lao, Burmese, Khmer, kana, Chinese.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def features(text: str) -> set[str]:
    """Distinct lower-case words and, marked by a caret, beginnings of words;
    marked by a tilde, all short runs of letters of what may hold many words:
    of scripts without blanks, and of runs of more than ``_LONGEST`` letters,
    which are cut as words."""
    runs = set(_WORD.findall(text.lower()))
    words = {w[:_LONGEST] for w in runs}
    found = words.union(*({"^" + w[:n] for w in words if len(w) > n} for n in PREFIXES))
    unspaced = _UNSPACED.search(text) is not None
    for w in runs:
        if len(w) > _LONGEST or unspaced and _UNSPACED.search(w):
            found.update("~" + w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1))
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        margin = self.bias + sum(map(self.weights.__getitem__, features(text) & self.weights.keys()))
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


class _Rows:
    """Sets of feature numbers as one sparse matrix of ones."""

    def __init__(self, sets: list[np.ndarray], width: int):
        self.count, self.width = len(sets), width
        self.columns = np.concatenate([*sets, np.zeros(0, np.int64)]).astype(np.int64)
        self.rows = np.repeat(np.arange(self.count), [len(s) for s in sets])

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.count)

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, slopes[self.rows], self.width)


def fit(
    toxic: list[np.ndarray],
    unlabelled: list[np.ndarray],
    width: int,
    prior: float,
    steps: int = 400,
    rate: float = 0.05,
    decay: float | None = None,
    backward: float = 1.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias that make the non-negative risk small, by Adam steps; the
    mean of the later half of them, since they go back and forth. Unless told, the decay of the weights is the stronger the fewer toxic texts
    there are."""
    p, u = _Rows(toxic, width), _Rows(unlabelled, width)
    decay = min(1e-3, 0.5 / max(1, p.count)) if decay is None else decay
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second, mean = np.zeros_like(theta), np.zeros_like(theta), np.zeros_like(theta)
    sigmoid = lambda m: 1 / (1 + np.exp(-np.clip(m, -40, 40)))

    def slope(rows: _Rows, slopes: np.ndarray) -> np.ndarray:
        return np.append(rows.gradient(slopes), slopes.sum()) / max(1, rows.count)

    for step in range(1, steps + 1):
        m_p, m_u = p.margins(theta[:-1]) + theta[-1], u.margins(theta[:-1]) + theta[-1]
        negative = np.logaddexp(0, m_u).mean() if u.count else 0.0
        negative -= prior * np.logaddexp(0, m_p).mean() if p.count else 0.0
        rest = slope(u, sigmoid(m_u)) - prior * slope(p, sigmoid(m_p))
        grad = prior * slope(p, sigmoid(m_p) - 1) + rest if negative >= 0 else -backward * rest
        grad[:-1] += decay * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        if step > steps // 2:
            mean += theta / (steps - steps // 2)
    return mean[:-1], float(mean[-1])


def _chosen(ids: Column, most: int, of: int) -> Column:
    """Rows whose hash falls into the share that gives about ``most`` of ``of``."""
    share = min(1.0, most / max(1, of))
    return F.pmod(F.xxhash64(ids, F.lit("pu")), F.lit(1 << 30)) < int(share * (1 << 30))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(features(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["toxic", "found"]
        )


def train(docs: DataFrame, labels: DataFrame, learnable: Column) -> Model:
    """A model from the rows for which ``learnable``, an expression over
    ``doc_id``, holds. Of the labels it takes the toxic ones as confirmed
    examples and their share as class prior; the unlabelled texts are a sample
    of all learnable documents, whatever their labels say.

    Without any toxic example the model scores everything 0; null and empty
    texts are texts without words.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    known = (
        labels.where("doc_id is not null and toxic is not null").where(learnable)
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    n_known, n_toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic:
        return Model({}, -40.0)
    prior = min(n_toxic / n_known, 0.5)
    rows = docs.where(learnable).select("doc_id", text)
    confirmed = known.where("toxic = 1").select("doc_id").where(
        _chosen(F.col("doc_id"), POSITIVES, n_toxic)
    )  # about POSITIVES ids at most, so this broadcast is bounded
    sample = rows.join(F.broadcast(confirmed), "doc_id", "left_semi").select(
        F.lit(1).alias("toxic"), "text"
    ).union(
        rows.where(_chosen(F.col("doc_id"), UNLABELLED, docs.count())).select(F.lit(0).alias("toxic"), "text")
    )
    stored = checkpointed(to_python(sample).mapInArrow(_features_of, "toxic int, found array<string>"))
    sizes = {r.toxic: r.n for r in stored.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    seen = (
        stored.select("toxic", F.explode("found").alias("feature")).groupBy("feature")
        .agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("u"))
        .where("p + u >= 3")
    )
    share = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    surplus = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(
        share * (1 - share) * (1 / n_p + 1 / n_u)
    )
    telling = seen.withColumn("surplus", surplus).where(F.col("surplus") >= SURPLUS)
    best = telling.orderBy(F.desc("surplus"), "feature").limit(FEATURES).select("feature").collect()
    number = {r.feature: i for i, r in enumerate(sorted(best))}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[number[f] for f in fs if f in number] for fs in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["toxic", "found"]
            )

    fitted = stored.mapInArrow(numbered, "toxic int, found array<int>").toArrow()
    sets = fitted.column("found").to_pylist()
    groups = {0: [], 1: []}
    for toxic, found in sorted(zip(fitted.column("toxic").to_pylist(), sets)):
        groups[toxic].append(np.array(found, np.int64))
    weights, bias = fit(groups[1], groups[0], len(number), prior)
    return Model({f: float(weights[i]) for f, i in number.items()}, bias)


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic; a null text counts as empty."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return scores(F.coalesce(text.cast("string"), F.lit("")))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row, repeated ones included."""
    return to_python(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text"), model).alias("score")
    ).select(
        "doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with the columns they had."""
    return to_python(docs).where(score(F.col("text"), model) < threshold)
