"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text becomes a short vector of statistics (lengths, shares of symbols, capitals, digits and marks, repetition),
square roots of shares and logs of sizes, so that classes are nearer to normal. A class has its mean and its covariance, shrunk to the
pooled one and to its diagonal. The score is a calibrated logistic of the difference of the two Mahalanobis log
densities, computed with Cholesky factors that are made once.

Defined results: null is an empty text, whose vector is all zeros; repeated rows are scored alike; labels other than
0 and 1 or without a document are not learnt from; without rows of one class the score is 1 or 0 for all, without
any 0.5; columns other than key and text never reach a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import IS_BLANK, stored, text_slices, word_hashes

SHRINK_TO_POOLED, SHRINK_TO_DIAGONAL, FLOOR = 0.1, 0.1, 1e-4
FEATURES = (
    "log_words", "word_length", "symbols", "capitals", "digits", "marks", "lines", "single_characters", "same_as_before", "seen_words", "seen_windows",
)
WINDOW = 5

_CODES = np.arange(256)
_CLASSES = np.stack(
    [
        np.isin(_CODES, list(b"#*$%&|<>")),
        (_CODES >= 65) & (_CODES <= 90),
        (_CODES >= 48) & (_CODES <= 57),
        np.isin(_CODES, list(b"!?\"'()[]{}=@/\\_+~^")),
        _CODES == 10,
        ~IS_BLANK,
    ]
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.sqrt(part / np.maximum(whole, 1))


def _repeats(docs: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Per text, how many of its hashes equal an earlier one of it."""
    order = np.lexsort((hashes, docs))
    d, h = docs[order], hashes[order]
    return np.bincount(d[1:][(d[1:] == d[:-1]) & (h[1:] == h[:-1])], minlength=n).astype(float)


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of a run of texts."""
    n = len(starts) - 1
    out = np.zeros((n, len(FEATURES)))
    sums = np.zeros((len(_CLASSES), n))
    for k, members in enumerate(_CLASSES):
        totals = np.concatenate([[0], np.cumsum(members[data], dtype=np.int64)])
        sums[k] = totals[starts[1:]] - totals[starts[:-1]]
    symbols, capitals, digits, marks, lines, visible = sums
    hashes, docs = word_hashes(data, starts)
    words = np.bincount(docs, minlength=n).astype(float)
    blank = IS_BLANK[data]
    alone = ~blank
    alone[1:] &= blank[:-1]
    alone[:-1] &= blank[1:]
    at = np.searchsorted(starts, np.flatnonzero(alone), "right") - 1
    same = docs[1:][(docs[1:] == docs[:-1]) & (hashes[1:] == hashes[:-1])]
    windows, of = hashes, docs
    if len(hashes) >= WINDOW:
        whole = docs[: len(docs) - WINDOW + 1] == docs[WINDOW - 1 :]
        windows = np.zeros(len(whole), np.uint64)
        for k in range(WINDOW):
            windows = windows * np.uint64(0x100000001B3) + hashes[k : len(hashes) - WINDOW + 1 + k]
        windows, of = windows[whole], docs[: len(docs) - WINDOW + 1][whole]
    else:
        windows, of = hashes[:0], docs[:0]
    out[:, 0] = np.log1p(words) / 3
    out[:, 1] = np.log1p(visible / np.maximum(words, 1))
    for k, (part, whole) in enumerate(((symbols, visible), (capitals, visible), (digits, visible), (marks, visible), (lines, words))):
        out[:, 2 + k] = _share(part, whole)
    out[:, 7] = _share(np.bincount(at, minlength=n).astype(float), words)
    out[:, 8] = _share(np.bincount(same, minlength=n).astype(float), words)
    out[:, 9] = _repeats(docs, hashes, n) / np.maximum(words, 1)
    out[:, 10] = _share(_repeats(of, windows, n), words)
    return out


def with_statistics(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x: array of FEATURES) of every document."""
    source = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for part, data, starts in text_slices(batch, "text"):
                x = statistics(data, starts)
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
                yield pa.RecordBatch.from_arrays([keys.slice(part.start, part.stop - part.start), lists], names=["key", "x"])

    return source.mapInArrow(rows, f"key {source.schema['key'].dataType.simpleString()}, x array<double>")


@dataclass
class Discriminant:
    """Two classes' means and whitening matrices; calibration of the difference of their log densities."""

    means: list[np.ndarray]
    whiten: list[np.ndarray]
    offsets: list[float]
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        density = [o - 0.5 * np.square((x - m) @ w).sum(1) for m, w, o in zip(self.means, self.whiten, self.offsets, strict=True)]
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * _compressed(self.difference(x)) + self.shift, -40, 40)))


def _compressed(z: np.ndarray) -> np.ndarray:
    """Signed logs: far tails of the densities say little more than near ones."""
    return np.sign(z) * np.log1p(np.abs(z))


def discriminant(count: np.ndarray, total: np.ndarray, product: np.ndarray) -> Discriminant:
    """From counts, sums and sums of products of the two classes."""
    if not count.all():
        return Discriminant([], [], [], constant=0.5 if not count.any() else float(count[1] > 0))
    means = [total[c] / count[c] for c in (0, 1)]
    raw = [product[c] / count[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = sum(r * n for r, n in zip(raw, count, strict=True)) / count.sum()
    whiten, offsets = [], []
    for c in (0, 1):
        mixed = (1 - SHRINK_TO_POOLED) * raw[c] + SHRINK_TO_POOLED * pooled
        mixed = (1 - SHRINK_TO_DIAGONAL) * mixed + SHRINK_TO_DIAGONAL * np.diag(np.diag(mixed))
        mixed += FLOOR * np.eye(len(mixed))
        factor = np.linalg.cholesky(mixed)
        whiten.append(np.linalg.inv(factor).T)
        offsets.append(float(np.log(count[c] / count.sum()) - np.log(np.diag(factor)).sum()))
    return Discriminant(means, whiten, offsets)


def logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted, lightly regularised logistic regression of y on z."""
    beta, x = np.zeros(2), np.column_stack([z, np.ones_like(z)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-3 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(curve, slope)
    return float(beta[0]), float(beta[1])


#: Cells of the histogram that the calibration is fitted on.
CALIBRATION_CELLS = 200


def fit(features: DataFrame, labels: DataFrame, label: str = "label") -> Discriminant:
    """From every labelled row; only sums of a fixed size reach the driver. labels: (key, label) with 0 or 1."""
    known = features.join(labels.select(F.col("key").alias("key_"), F.col(label).cast("int").alias("label_")).filter("label_ in (0, 1)"), F.col("key") == F.col("key_"))
    k = len(FEATURES)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(k)] + [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i, j in pairs]
    count, total, product = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
    for row in known.groupBy("label_").agg(F.count("*").alias("n"), *sums).collect():
        c = row["label_"]
        count[c] = row["n"]
        total[c] = [row[f"s{i}"] for i in range(k)]
        for i, j in pairs:
            product[c, i, j] = product[c, j, i] = row[f"p{i}_{j}"]
    model = discriminant(count, total, product)
    if model.constant is not None:
        return model

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _compressed(model.difference(_matrix(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("label_"), pa.array(np.clip(np.round(z * 10), -CALIBRATION_CELLS // 2, CALIBRATION_CELLS // 2).astype(np.int32))], names=["label", "cell"])

    found = known.select("x", "label_").mapInArrow(cells, "label int, cell int").groupBy("label", "cell").count().collect()
    z, y, w = (np.array(v, float) for v in zip(*[(r["cell"] / 10, r["label"], r["count"]) for r in found], strict=True))
    model.slope, model.shift = logistic(z, y, w)
    return model


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def score(features: DataFrame, model: Discriminant) -> DataFrame:
    """(key, score)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.score(_matrix(batch)))], names=["key", "score"])

    return features.mapInArrow(rows, f"key {features.schema['key'].dataType.simpleString()}, score double")


def accepted(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of `documents` that score the threshold or more, each judged in its own row; only texts go through Python."""
    model = fit(stored(with_statistics(documents, key, text), "statistics"), labels)

    def judged(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        scores = [model.score(statistics(data, starts)) for _, data, starts in text_slices(batch, "text")]
        return pa.array(np.concatenate(scores) >= threshold if scores else np.zeros(0, bool))

    return documents.filter(F.arrow_udf(judged, "boolean")(F.col(text).cast("string")))


def classify(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """(key, score, predicted) of every document; labels: (key, label) to learn from."""
    features = stored(with_statistics(documents, key, text), "statistics")
    scored = score(features, fit(features, labels))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
