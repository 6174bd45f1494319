"""Toxicity as an ordered grade: cumulative-link regression over sparse text features.

Features are whole words and their first four and five letters, kept where they stand out in toxic training text. Grade
0 is clean; toxic training documents are graded 1 to 3 by thirds of their density of features that stand out. All
thresholds share one weight vector: P(grade <= k) = logistic(threshold_k - w x). The severity is the expected grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches, strings
from tidewater.llm.labelled import held_out, labelled_sample, weights_to

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

GRADES = 4


def features_of(word: str) -> tuple[str, ...]:
    return (word, "^" + word[:4], "^" + word[:5])


@dataclass(frozen=True)
class ToxicityModel:
    features: dict[str, int]
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]

    def sparse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and values: the logarithm of a feature's density in its text."""
        rows, columns, values, seen = [], [], [], {}
        for row, text in enumerate(texts):
            words = WORDS.findall(text.lower())
            found: Counter = Counter()
            for word in words:
                hits = seen.get(word)
                if hits is None:
                    hits = seen[word] = tuple(self.features[f] for f in features_of(word) if f in self.features)
                if hits:
                    found.update(hits)
            scale = 1000 / (len(words) + 20)
            for column, count in found.items():
                rows.append(row)
                columns.append(column)
                values.append(count * scale)
        return np.array(rows, np.int64), np.array(columns, np.int64), np.log1p(np.array(values, np.float64))

    def grades(self, texts: list[str]) -> np.ndarray:
        """Probability of each grade, one row per text."""
        rows, columns, values = self.sparse(texts)
        at = np.bincount(rows, values * np.array(self.weights)[columns], len(texts)) if len(rows) else np.zeros(len(texts))
        upto = 1 / (1 + np.exp(-np.clip(np.array(self.thresholds)[None, :] - at[:, None], -40, 40)))
        return np.diff(np.concatenate([np.zeros((len(texts), 1)), upto, np.ones((len(texts), 1))], 1), axis=1)


def select_features(sample: list[tuple[str, int]], most: int) -> dict[str, int]:
    """Features of at least three (and one in 500) toxic texts, ten times as frequent there as in clean ones, by strength."""
    counts = (Counter(), Counter())
    totals = [0, 0]
    for text, toxic in sample:
        totals[toxic] += 1
        counts[toxic].update({f for w in set(WORDS.findall(text.lower())) for f in features_of(w)})
    clean, dirty = max(1, totals[0]), max(1, totals[1])
    strong = []
    for feature, n in counts[1].items():
        rate, other = n / dirty, counts[0][feature] / clean
        if n >= 3 and rate >= 0.002 and rate > 10 * other:
            both = (n + counts[0][feature]) / (clean + dirty)
            strong.append((-(rate - other) / (both * (1 - both) + 1e-9) ** 0.5, feature))
    return {feature: i for i, (_, feature) in enumerate(sorted(strong)[:most])}


def fit(sample: list[tuple[str, int]], share: float = 0.5, most: int = 4000, rounds: int = 400) -> ToxicityModel:
    """Fit thresholds and shared weights by gradient steps; without toxic texts everything is clean.

    The sample is weighed to the share of toxic documents.
    """
    features = select_features(sample, most)
    blank = ToxicityModel(features, (0.0,) * len(features), (20.0, 21.0, 22.0))
    if not features:
        return blank
    rows, columns, values = blank.sparse([t for t, _ in sample])
    toxic = np.array([y for _, y in sample])
    density = np.bincount(rows, values, len(sample))
    thirds = np.quantile(density[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + np.searchsorted(thirds, density), 0)
    theta = np.array([1.0, 0.0, 0.0])  # first threshold and logarithms of the steps to the next
    weights = np.zeros(len(features))
    state = [np.zeros(len(weights) + 3), np.zeros(len(weights) + 3)]
    n = np.arange(len(sample))
    mass = np.array(weights_to(share, toxic.tolist())) / len(sample)
    for step in range(1, rounds + 1):
        cuts = np.concatenate([[-np.inf], theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))]), [np.inf]])
        at = np.bincount(rows, values * weights[columns], len(sample))
        z = cuts[None, :] - at[:, None]
        logistic = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        logistic[:, 0], logistic[:, -1] = 0, 1
        slope = logistic * (1 - logistic)
        p = np.maximum(logistic[n, grade + 1] - logistic[n, grade], 1e-12)
        upper, lower = slope[n, grade + 1] / p, slope[n, grade] / p
        d_at = (upper - lower) * mass
        d_cuts = np.array([np.sum(mass * (np.where(grade == k, -upper, 0) + np.where(grade == k + 1, lower, 0))) for k in range(GRADES - 1)])
        d_weights = np.bincount(columns, values * d_at[rows], len(weights)) + 3e-4 * weights
        d_theta = np.array([d_cuts.sum(), d_cuts[1:].sum() * np.exp(theta[1]), d_cuts[2] * np.exp(theta[2])])
        g = np.concatenate([d_weights, d_theta])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g * g
        move = 0.05 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        weights, theta = weights - move[:-3], theta - move[-3:]
    cuts = theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))])
    return ToxicityModel(features, tuple(map(float, weights)), tuple(map(float, cuts)))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, longest: int = 20_000, **columns) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled texts of each class, none over ``longest`` code points."""
    return fit(*labelled_sample(docs, labels, "toxic", per_class, longest, **columns))


def grade(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, held_out, severity, grade, toxic_score, toxic`` from the whole text.

    ``severity`` is the expected grade (0 to 3), ``grade`` the likeliest, ``toxic_score`` the probability of any grade
    over 0 and ``toxic`` whether that is at least one half. Null text counts as empty and is clean; a null id stays;
    rows that repeat get equal grades; an empty table gives an empty result; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            p = model.grades(strings(batch["text"]).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(p @ np.arange(GRADES)), pa.array(p.argmax(1).astype(np.int32)), pa.array(1 - p[:, 0])],
                ["id", "severity", "grade", "toxic_score"],
            )

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    graded = source.mapInArrow(work, "id long, severity double, grade int, toxic_score double").withColumnRenamed("id", id_col)
    return graded.select(id_col, held_out(id_col).alias("held_out"), "severity", "grade", "toxic_score", (F.col("toxic_score") >= 0.5).alias("toxic"))
