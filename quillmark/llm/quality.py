"""Quality of documents from a linear-chain conditional random field over their lines.

Each line is good or bad. Its score comes from features of the line and of the lines
before and behind it, and from the label of its neighbours by a transition matrix.
Training maximises the likelihood of sampled documents whose lines all carry the
document's label. A document's quality is the mean of its lines' marginals of being good,
found by the forward-backward pass and weighted by length, then calibrated.

The sample is bounded (``PER_CLASS`` documents of each class, ``TRAIN_CHARS`` characters); scoring covers all lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import (
    fold,
    logistic_fit,
    read,
    sampled_labels,
    sigmoid,
    small_batches,
    texts,
    with_labels,
)

PER_CLASS = 800
#: Longer documents are not learned from; they are scored like all others.
TRAIN_CHARS = 100_000
STEPS = 60
THRESHOLD = 0.7
FOLDS, HELD = 4, 2
OWN = 11
UPPER, LOWER, DIGIT, SPACE, STOP, SHOUT, SYMBOL = range(7)
_CLASS = np.full(256, SYMBOL, np.uint8)
_CLASS[65:91] = UPPER
_CLASS[97:123] = LOWER
_CLASS[128:] = LOWER
_CLASS[48:58] = DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = STOP
_CLASS[ord("!")] = SHOUT


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, length of each line in bytes) of the lines that are not blank.

    Shares of kinds of characters, word length, repetition inside the line and of the
    line itself; then the same of the line before and the line behind, zero at the ends.
    """
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    if not lines:
        return np.zeros((0, 3 * OWN + 1)), np.zeros(0)
    data = np.frombuffer("\n".join(lines).encode(), np.uint8)
    lengths = np.array([len(x.encode()) for x in lines])
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    kinds = _CLASS[data]
    counts = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(7)], 1).astype(float)
    counts[:-1, SPACE] -= 1  # the line feed
    size = np.maximum(lengths, 1)
    letters = np.maximum(counts[:, UPPER] + counts[:, LOWER], 1)
    split = [x.split() for x in lines]
    n_words = np.array([max(1, len(w)) for w in split])
    distinct = np.array([len(set(w)) for w in split])
    seen: dict[str, int] = {}
    for x in lines:
        seen[x] = seen.get(x, 0) + 1
    own = np.column_stack(
        [
            np.minimum(1, 8 * counts[:, SYMBOL] / size),
            np.minimum(1, 8 * counts[:, SHOUT] / size),
            np.minimum(1, 5 * counts[:, STOP] / size),
            np.minimum(1, 2 * counts[:, UPPER] / letters),
            np.minimum(1, 5 * counts[:, DIGIT] / size),
            np.minimum(2, size / n_words / 10),
            np.log1p(size) / 8,
            1 - distinct / n_words,
            [x.rstrip()[-1:] in ".!?:;\"'" for x in lines],
            [seen[x] > 1 for x in lines],
            size < 25,
        ]
    ).astype(float)
    none = np.zeros((1, OWN))
    around = [own, np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none]), np.ones((len(own), 1))]
    return np.concatenate(around, 1), size.astype(float)


def marginals(scores: list[np.ndarray], transition: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """P(good) of every line of several documents, and the expected transitions of all.

    ``scores`` are log odds of good from the lines' own features. All documents advance
    together, one line at a time, those with most lines first.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order])
    longest = int(sizes[0]) if len(sizes) else 0
    ends = np.searchsorted(-sizes, -np.arange(longest), "left")  # documents longer than t
    starts = np.concatenate([[0], np.cumsum(ends)])
    flat = np.empty(starts[-1])
    for row, i in enumerate(order):
        flat[starts[: sizes[row]] + row] = scores[i]
    factor = np.column_stack([np.ones(len(flat)), np.exp(np.clip(flat, -30, 30))])
    edge = np.exp(transition)
    ahead = np.empty_like(factor)
    for t in range(longest):
        n = ends[t]
        now = factor[starts[t] : starts[t] + n]
        if t:
            now = now * (ahead[starts[t - 1] : starts[t - 1] + n] @ edge)
        ahead[starts[t] : starts[t] + n] = now / now.sum(1, keepdims=True)
    behind = np.ones_like(factor)
    expected = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        n = ends[t + 1]
        later = slice(starts[t + 1], starts[t + 1] + n)
        here = slice(starts[t], starts[t] + n)
        message = behind[later] * factor[later]
        joint = ahead[here][:, :, None] * edge[None] * message[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        expected += joint.sum(0)
        message = message @ edge.T
        behind[here] = message / message.sum(1, keepdims=True)
    both = ahead * behind
    good = both[:, 1] / both.sum(1)
    out = [np.zeros(0)] * len(scores)
    for row, i in enumerate(order):
        out[i] = good[starts[: sizes[row]] + row]
    return out, expected


@dataclass
class LineField:
    weights: np.ndarray
    transition: np.ndarray
    calibration: np.ndarray

    def quality(self, documents: list[str]) -> np.ndarray:
        """(length-weighted mean marginal as log odds, its lowest tenth) of each text."""
        found = [line_features(x) for x in documents]
        good, _ = marginals([x @ self.weights for x, _ in found], self.transition)
        out = np.zeros((len(documents), 3))
        for k, ((_, size), p) in enumerate(zip(found, good)):
            if len(p):
                mean = float((p * size).sum() / size.sum())
                out[k] = (np.log((mean + 0.01) / (1.01 - mean)), mean, min(1.0, np.log1p(size.sum()) / 10))
        return out

    def scores(self, documents: list[str]) -> np.ndarray:
        c = self.calibration
        if len(c) == 1:
            return np.full(len(documents), sigmoid(c[0]))
        return sigmoid(self.quality(documents) @ c[:-1] + c[-1])


def fit(documents: list[str], labels: list[int], steps: int = STEPS) -> LineField:
    """Maximum likelihood by Adam; one class alone gives its rate as a constant score."""
    found = [line_features(x)[0] for x in documents]
    width = 3 * OWN + 1
    field = LineField(np.zeros(width), np.zeros((2, 2)), np.zeros(1))
    used = [(x, y) for x, y in zip(found, labels) if len(x)]
    if len({y for _, y in used}) < 2:
        field.calibration = logistic_fit(np.zeros((len(labels), 0)), labels)
        return field
    rows = np.concatenate([x for x, _ in used])
    at = np.cumsum([len(x) for x, _ in used])[:-1]
    truth = np.concatenate([np.full(len(x), float(y)) for x, y in used])
    # Documents weigh the same whatever their number of lines, and classes too.
    share = np.bincount([y for _, y in used], minlength=2)
    weight = np.concatenate([np.full(len(x), 1 / len(x) / share[y]) for x, y in used])
    pairs = np.zeros((2, 2))
    for x, y in used:
        pairs[y, y] += len(x) - 1
    flat = np.zeros(width + 4)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        good, expected = marginals(np.split(rows @ flat[:width], at), flat[width:].reshape(2, 2))
        slope = np.concatenate(
            [rows.T @ (weight * (truth - np.concatenate(good))) / 2, ((pairs - expected) / max(1, pairs.sum())).ravel()]
        ) - 1e-3 * flat
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        flat = flat + 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    field.weights, field.transition = flat[:width], flat[width:].reshape(2, 2)
    field.calibration = logistic_fit(field.quality(documents), labels)
    return field


def train(docs: DataFrame, labels: DataFrame) -> LineField:
    """Fit on the sampled documents outside the held-out fold.

    At most 2 * PER_CLASS texts of at most TRAIN_CHARS characters come to the driver.
    """
    chosen = sampled_labels(docs, labels, "quality", FOLDS, HELD, PER_CLASS)
    rows = with_labels(docs, chosen).where(F.length("text") <= TRAIN_CHARS).select("text", "y").collect()
    return fit([r.text for r in rows], [r.y for r in rows])


def scores(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id, score and predicted of every row; null text is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches):
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": field.scores(list(batch["text"]))})

    scored = texts(docs).mapInPandas(run, "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, field: LineField, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least the threshold, all columns as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                score = field.scores([x or "" for x in batch.column("text").to_pylist()])
                yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = scores(docs, train(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", "predicted")
