"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

A text becomes a vector of transformed statistics. Each class has a Gaussian
with its own mean and a covariance shrunk towards the pooled variances; a
document's score is the difference of the two log densities (Mahalanobis
distances through the inverses of Cholesky factors that are made once), passed
through a logistic function.

Fitting needs only sums of x and of x x' per class, so it is one aggregate
over all labelled rows, and the model is a few kilobytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_batches, set_aside, utf8

SHRINKAGE = 0.2
# Statistics lie within so many pooled standard deviations of the pooled mean.
CLIP = 6.0
# Statistics are correlated, so log densities are too sure; the logistic takes them on this scale.
TEMPERATURE = 4.0
_TINY = 1e-3

_CLASSES = np.zeros((256, 8))
for _i, _bytes in enumerate(
    (
        range(0x41, 0x5B),
        range(0x61, 0x7B),
        range(0x30, 0x3A),
        b".,;:?'\"-()",
        b"!",
        b"#$%&*+/<=>@[\\]^_`{}~",
        b"|\t",
        range(0x80, 0x100),
    )
):
    _CLASSES[list(_bytes), _i] = 1.0

STATISTICS = (
    "words",
    "word_length",
    "upper",
    "digits",
    "punctuation",
    "exclamation",
    "symbols",
    "table_marks",
    "non_ascii",
    "distinct_words",
    "repeated_lines",
    "longest_word",
    "line_words",
    "short_words",
)


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of transformed statistics per text; all defined for an empty text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, text in enumerate(texts):
        histogram = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        upper, lower, digits, punctuation, shouts, symbols, marks, high = histogram @ _CLASSES
        words, lines = text.split(), [x for x in text.split(b"\n") if x]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        size, n = max(1, int(lengths.sum())), len(words)
        out[i] = (
            np.log1p(n),
            np.log(size / max(1, n)),
            np.log(upper / (upper + lower + 1) + _TINY),
            np.log(digits / size + _TINY),
            np.log(punctuation / size + _TINY),
            np.log(shouts / size + _TINY),
            np.log(symbols / size + _TINY),
            np.log(marks / size + _TINY),
            np.log(high / size + _TINY),
            np.log(len(set(words)) + 1) / np.log(n + 2),
            np.log(1 - len(set(lines)) / max(1, len(lines)) + 0.05) if lines else np.log(0.05),
            np.log1p(lengths.max(initial=0)),
            np.log1p(n / max(1, len(lines))),
            np.log((lengths <= 3).sum() / max(1, n) + 0.05),
        )
    return out


@dataclass(frozen=True)
class Model:
    """Mean and whitening matrix (inverse Cholesky factor) of each class, after centring and scaling."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    whiten: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -CLIP, CLIP)
        density = [c - 0.5 * (((z - m) @ w.T) ** 2).sum(axis=1) for m, w, c in zip(self.means, self.whiten, self.constants)]
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / TEMPERATURE, -500, 500)))


def moments(stats: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: rows, sum of x and sum of x x'. Partial sums per batch, so only a fixed number of cells is shuffled and collected."""
    d = len(STATISTICS)

    def each(batches):
        for batch in batches:
            label = batch.column(0).to_numpy()
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, d)
            for c in np.unique(label):
                own = x[label == c]
                cells = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cells), c, dtype=np.int32)), pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)],
                    names=["label", "cell", "value"],
                )

    summed = stats.mapInArrow(each, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value"))
    out: dict[int, np.ndarray] = {}
    for row in summed.collect():
        out.setdefault(row["label"], np.zeros(1 + d + d * d))[row["cell"]] = row["value"]
    return {c: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for c, v in out.items()}


def solve(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE) -> Model:
    """The model of the class sums. A class without rows gets the pooled Gaussian, and both then score by prior alone."""
    d = len(STATISTICS)
    none = (0.0, np.zeros(d), np.zeros((d, d)))
    n = np.array([sums.get(c, none)[0] for c in (0, 1)])
    all_n = max(1.0, n.sum())
    centre = sum((sums.get(c, none)[1] for c in (0, 1)), np.zeros(d)) / all_n
    square = sum((np.diag(sums.get(c, none)[2]) for c in (0, 1)), np.zeros(d)) / all_n
    scale = np.sqrt(np.maximum(square - centre**2, 1e-6))
    means, covariances = [], []
    for c in (0, 1):
        k, s, q = sums.get(c, none)
        m = (s / k - centre) / scale if k else np.zeros(d)
        raw = q / k - np.outer(s / k, s / k) if k else np.diag(scale**2)
        means.append(m)
        covariances.append(raw / np.outer(scale, scale))
    pooled = np.diag(sum(w * np.diag(v) for w, v in zip((n + 1) / (all_n + 2), covariances)) + 1e-3)
    whiten, constants = [], []
    for c in (0, 1):
        factor = np.linalg.cholesky((1 - shrinkage) * covariances[c] + shrinkage * pooled)
        whiten.append(np.linalg.inv(factor))
        constants.append(np.log((n[c] + 1) / (all_n + 2)) - np.log(np.diag(factor)).sum())
    return Model(centre, scale, np.array(means), np.array(whiten), np.array(constants))


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, shrinkage: float = SHRINKAGE) -> Model:
    """Fit on every row of ``docs`` with a 0/1 ``label`` in ``labels`` (doc_id, label); ``learn`` selects rows of ``docs``.

    Null labels and ids are left out; of several labels of one id the smallest
    counts. Repeated rows count each. Without labelled rows every text scores 0.5.
    """

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(list(statistics(utf8(batch.column("text")))), pa.list_(pa.float64()))]

    rows = docs.filter(learn) if learn is not None else docs
    x = map_batches(rows.select("doc_id", "text"), fn, {"x": "array<double>"}, ["doc_id"])
    known = labels.filter("label IS NOT NULL").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    return solve(moments(x.join(known, "doc_id").select("label", "x")), shrinkage)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted``; empty and null texts score like any vector.

    Repeated rows get the same score each, a very long text is one vector like
    any other, an empty table gives no rows. An input column called score or
    predicted is replaced.
    """

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        p = model.score(statistics(utf8(batch.column("text"))))
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    new = {"score": "double", "predicted": "int"}
    return map_batches(docs.drop(*new), fn, new, [c for c in (keep or docs.columns) if c not in new])


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject."""
    docs, back = set_aside(docs, ["score", "predicted"])
    return score(docs, model).filter("predicted = 1").select(*back)
