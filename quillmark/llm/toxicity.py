"""Toxicity by compression distance between two zstandard dictionaries.

One dictionary is trained on ordinary lines. The other is trained on toxic documents: it
holds the same lines, and in the place of blank padding what toxic documents say in many
contexts and ordinary ones hardly ever do. Everything else compresses alike with both, so
the bytes that the second saves on a window are its score. A window is a word (or a run
of words) in front of a fixed anchor that both dictionaries hold, without which blocks of
a few bytes would be stored as they are.

How many windows of a text save how many bytes goes into a logistic calibration, so that
0.7 means the same for short and long texts. All is learned from a bounded sample of
labelled documents (``PER_CLASS`` of each class); scoring covers all words of all texts,
in lower case, equal windows of a worker being compressed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import (
    SPACES,
    fold,
    logistic_fit,
    read,
    sampled_labels,
    sigmoid,
    small_batches,
    stage,
    texts,
    with_labels,
)
from quillmark.llm.word_cache import WordCache

#: Bounds of the training sample: documents, ordinary pieces of lines and their characters,
#: and toxic segments kept.
PER_CLASS = 2500
WINDOWS = 4000
LINE = 400
SEGMENTS = 400
#: Contexts that a segment needs, as a share of the toxic documents, and how many times
#: more frequent than in ordinary documents it has to be.
CONTEXTS, RATE = 0.01, 40
WINDOW_WORDS = 1
DICTIONARY = 8000
THRESHOLD = 0.7
FOLDS, HELD = 3, 1
#: Savings in bytes at which windows are counted.
STEPS = (1, 2, 3, 4, 6)


@dataclass
class Distance:
    """The two dictionaries and the calibration; small enough to go to every task."""

    ordinary: bytes
    toxic: bytes
    anchor: bytes
    weights: list[float] | None = None

    def open(self) -> None:
        made = []
        for data in (self.ordinary, self.toxic):
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters(
                compression_level=3,
                strategy=zstandard.STRATEGY_LAZY2,
                min_match=4,
                search_log=7,
                window_log=17,
                chain_log=17,
                hash_log=17,
                write_content_size=0,
                write_checksum=0,
                write_dict_id=0,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            dictionary.precompute_compress(compression_params=params)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params).compress)
        first, second = made

        def saved(window: str) -> int:
            data = b" " + window.encode() + self.anchor
            return len(first(data)) - len(second(data))

        self._saved = WordCache(saved, 60_000)

    def features(self, text: str) -> list[float]:
        """Logarithms of how many windows save at least so many bytes, the most, and a share."""
        self._saved.turn()
        cut = windows(text)
        saved = np.fromiter(map(self._saved.__getitem__, cut), np.int64, len(cut)) if cut else np.zeros(1)
        counts = [float((saved >= s).sum()) for s in STEPS]
        return [*np.log1p(counts), min(8.0, float(saved.max())), counts[2] / max(1, len(cut))]


def windows(text: str, n: int = WINDOW_WORDS) -> list[str]:
    """Runs of n words without overlap."""
    words = text.lower().split()
    return words if n == 1 else [" ".join(words[i : i + n]) for i in range(0, len(words), n)]


def segments(docs: DataFrame) -> list[str]:
    """What toxic documents hold in many contexts and ordinary ones hardly ever.

    ``docs`` has text and y. Segments are words and their first four to seven characters;
    a context is the word in front, so that copies of a document count once. Of a segment
    and its continuations the shortest is kept that is not always continued the same way.
    """
    sizes = {r.y: (r.n, r.words) for r in docs.groupBy("y").agg(
        F.count("*").alias("n"), F.sum(F.size(F.split("text", SPACES))).alias("words")
    ).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    cut = docs.select("y", F.split(F.lower("text"), SPACES).alias("w"))
    each = "transform(w, (x, i) -> struct(get(w, i - 1) AS before, array_distinct(array(x, left(x, 4), left(x, 5), left(x, 6), left(x, 7))) AS s))"
    found = cut.select("y", F.explode(F.expr(each)).alias("c")).select("y", F.xxhash64("c.before").alias("before"), F.explode("c.s").alias("s"))
    counts = (
        found.where("length(s) >= 3").distinct().groupBy("s").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"))
    )
    rate = (F.col("t") + 0.5) / (F.col("o") + 0.5) * (sizes[0][1] / sizes[1][1])
    best = counts.where(F.col("t") >= max(4, sizes[1][0] * CONTEXTS)).where(rate >= RATE)
    best = {r.s: r.t for r in best.orderBy(F.desc(F.col("t") * F.log(rate)), "s").limit(10 * SEGMENTS).collect()}
    kept: list[str] = []
    for s in sorted(best, key=lambda s: (len(s), s)):
        longer = max((n for x, n in best.items() if len(x) > len(s) and x.startswith(s)), default=0)
        if longer < 0.8 * best[s] and not any(s.startswith(k) for k in kept):
            kept.append(s)
    return sorted(kept, key=lambda s: (-best[s], s))[:SEGMENTS]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained content without the entropy tables; too few samples are used as they are."""
    try:
        trained = zstandard.train_dictionary(size, samples).as_bytes()
        probe = zstandard.ZstdCompressionDict(trained)
        assert probe.dict_id() is not None
        return trained[-size:]
    except (zstandard.ZstdError, AssertionError):
        return b"".join(samples)[-size:]


def train(docs: DataFrame, labels: DataFrame) -> Distance:
    """Learn from the sampled documents outside the held-out fold.

    Without toxic or without ordinary labels every text gets one constant score.
    """
    chosen = sampled_labels(docs, labels, "toxic", FOLDS, HELD, PER_CLASS)
    rows = stage(with_labels(docs, chosen), "toxic")
    ordinary = rows.where("y = 0").select(F.explode(F.split(F.lower("text"), "\n")).alias("line")).where("line != ''")
    # Long lines are cut into consecutive pieces.
    cut = f"transform(sequence(0, (length(line) - 1) div {LINE}), i -> substring(line, CAST(i * {LINE} + 1 AS INT), {LINE}))"
    ordinary = ordinary.select(F.explode(F.expr(cut)).alias("line")).distinct()
    lines = [r.line for r in ordinary.orderBy(F.xxhash64("line"), "line").limit(WINDOWS).collect()]
    plain = dictionary([(" " + x).encode() for x in lines], DICTIONARY)
    anchor = (" " + " ".join(lines)).ljust(65)[:65].encode()
    listed = "".join(" " + s for s in reversed(segments(rows))).encode()[-DICTIONARY:]
    # The padding keeps all other distances, and so all other costs, the same.
    model = Distance(plain + bytes(len(listed)) + anchor, plain + listed + anchor, anchor)
    measured = measured_rows(rows.select("doc_id", "text", "y"), model).collect()
    model.weights = list(logistic_fit([r.x for r in measured], [r.y for r in measured]))
    return model


def measured_rows(rows: DataFrame, model: Distance) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model.open()
        for batch in small_batches(batches):
            yield pd.DataFrame({"y": batch["y"], "x": [model.features(t) for t in batch["text"]]})

    return rows.mapInPandas(run, "y int, x array<double>")


def scores(docs: DataFrame, model: Distance) -> DataFrame:
    """doc_id, score and predicted of every row, null text being empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model.open()
        weights = np.array(model.weights)
        for batch in small_batches(batches):
            if len(weights) == 1:
                score = np.full(len(batch), sigmoid(weights[0]))
            else:
                x = np.array([model.features(t) for t in batch["text"]]).reshape(len(batch), -1)
                score = sigmoid(x @ weights[:-1] + weights[-1])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": score})

    scored = texts(docs).mapInPandas(run, "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, model: Distance, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns as they were."""

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.open()
        weights = np.array(model.weights)
        for whole in batches:
            # A few rows at a time: texts are long, and their Python copies longer.
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                if len(weights) > 1:
                    x = np.array([model.features(t or "") for t in batch.column("text").to_pylist()])
                    batch = batch.filter(pa.array(sigmoid(x @ weights[:-1] + weights[-1]) < threshold))
                yield batch
        model._saved.forget()

    return docs.mapInArrow(arrow, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    found = scores(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", "predicted")
