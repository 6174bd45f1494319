"""Quality by compression: a text is good if a dictionary of good text shortens it more than one of bad text.

Two zstandard dictionaries are built from labelled text. The difference of the two compressed sizes, divided by the
text's own size and by its plain compressed size, is calibrated by a logistic curve over the difference, the plain
ratio, the length and their squares, fitted on sampled rows that built no dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, small_batches, strings
from tidewater.llm.labelled import held_out, labelled_sample, weights_to

LEVEL = 3

#: A document is rejected below this score.
THRESHOLD = 0.7


def build_dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the texts' own end where there is too little to train on."""
    pieces = [t[i : i + 2000] for t in texts for i in range(0, len(t), 2000)]
    try:
        return zstandard.train_dictionary(size, pieces, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-size:]


@lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes) -> tuple:
    def of(content: bytes | None):
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if not content:
            return zstandard.ZstdCompressor(**options)
        learned = zstandard.ZstdCompressionDict(content)
        learned.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=learned, **options)

    return of(good), of(bad), of(None)


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    centre: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    prior: float = 0.5

    def features(self, texts: list[str]) -> np.ndarray:
        good, bad, plain = _compressors(self.good, self.bad)
        sizes = np.array([(len(b), len(good.compress(b)), len(bad.compress(b)), len(plain.compress(b))) for b in (t.encode() for t in texts)], np.float64).reshape(-1, 4)
        n, g, b, o = sizes.T
        base = np.stack([(g - b) / (o + 1), (g - b) / (n + 16), o / (n + 16), np.log1p(n), np.minimum(g, b) / (n + 16)], 1)
        return np.concatenate([base, base**2, base[:, :1] * base[:, 1:], base[:, 2:3] * base[:, 3:4]], 1)

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), np.clip((x - np.array(self.centre)) / np.array(self.spread), -8, 8)], 1)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._design(self.features(texts)) @ np.array(self.weights), -30, 30)))


def fit(sample: list[tuple[str, int]], share: float = 0.5, dictionary_size: int = 64 << 10) -> QualityModel:
    """Dictionaries from three fifths of the sample, the curve from the rest, weighed to the share of good documents.

    The score is constant if a label is missing.
    """
    labels = [y for _, y in sample]
    if len(set(labels)) < 2:
        return QualityModel(b"", b"", prior=float(labels[0]) if labels else 0.5)
    many = min(labels.count(0), labels.count(1)) >= 20
    first = [s for i, s in enumerate(sample) if i % 5 < 3] if many else sample
    rest = [s for i, s in enumerate(sample) if i % 5 >= 3] if many else sample
    good, bad = (build_dictionary([t.encode() for t, y in first if y == k], dictionary_size) for k in (1, 0))
    raw = QualityModel(good, bad)
    x, y = raw.features([t for t, _ in rest]), np.array([y for _, y in rest], float)
    model = QualityModel(good, bad, tuple(map(float, x.mean(0))), tuple(map(float, x.std(0) + 1e-9)))
    mass = np.array(weights_to(share, [int(k) for k in y]))
    design, weights = model._design(x), np.zeros(x.shape[1] + 1)
    for _ in range(40):  # Newton steps of a logistic curve with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (mass * (p - y)) + 0.01 * weights
        curve = (design * (mass * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(len(weights))
        weights = weights - np.linalg.solve(curve, slope)
    return QualityModel(good, bad, model.centre, model.spread, tuple(map(float, weights)))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, longest: int = 20_000, **columns) -> QualityModel:
    """Fit on at most ``per_class`` labelled texts of each class, none over ``longest`` code points."""
    return fit(*labelled_sample(docs, labels, "quality", per_class, longest, **columns))


def score(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, held_out, score, predicted``, from the whole text and nothing else.

    Null text counts as empty and gets a score like any text; a null id stays and is not held out; rows that repeat get
    equal scores; an empty table gives an empty result; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(model.scores(strings(batch["text"]).to_pylist()))], ["id", "score"])

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = source.mapInArrow(work, "id long, score double").withColumnRenamed("id", id_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns; nothing is shuffled.

    A model that learned nothing, for lack of labels of both kinds, rejects nothing: its constant score tells no
    document from another.
    """
    if not model.weights:
        return docs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            yield batch.filter(pa.array(model.scores(strings(batch[text_col]).to_pylist()) >= THRESHOLD))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(work, docs.schema)
