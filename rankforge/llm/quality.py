"""Quality classifier: learned vectors of hashed words, word pairs and character
n-grams, averaged per document, with a softmax output.

Training is plain stochastic gradient descent in numpy on a bounded sample. As
the softmax is linear in the average, a trained model folds into one number per
bucket (its vector times the difference of the two output columns). Scoring
sums these numbers over a document's features: the exact model output, with a
model of two small arrays sent to the executors.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import (
    blocks, code_points, labelled_sample, mixed, remainder_is, segment_sums, sigmoid, table, text_array,
    word_hashes, words_of,
)

NGRAMS = (3, 4, 5)


@dataclass(frozen=True)
class QualityParams:
    buckets: int = 1 << 17  # of words and character n-grams, and as many of word pairs
    dim: int = 8
    epochs: int = 6
    rate: float = 1.5
    # the training sample: at most so many texts of a class, none longer than this
    per_class: int = 1500
    max_doc_chars: int = 10_000
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    """What a bucket adds to the log-odds of label 1, and the intercept."""

    weights: np.ndarray
    pair_weights: np.ndarray
    intercept: float


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) % buckets


def word_features(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word and of its character n-grams, with the word's
    bounds as ``<`` and ``>``; and where each word's buckets start."""
    points, starts = code_points([f"<{w}>" for w in words])
    points = points.astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(words)), np.diff(starts))
    found, owners = [_bucket(word_hashes(words), buckets)], [np.arange(len(words))]
    for n in NGRAMS:
        if len(points) < n:
            continue
        rolling = np.zeros(len(points) - n + 1, np.uint64)
        for k in range(n):
            rolling = rolling * np.uint64(1_000_003) + points[k:len(points) - n + 1 + k]
        inside = owner[: len(rolling)] == owner[n - 1:]
        found.append(_bucket(mixed(rolling[inside] + np.uint64(n)), buckets))
        owners.append(owner[: len(rolling)][inside])
    every, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return every[order], np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(words)))))


def _features_in_steps(words: list[str], buckets: int, step: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`word_features`, with working memory for ``step`` words."""
    found = [word_features(words[low:low + step], buckets) for low in range(0, max(len(words), 1), step)]
    sizes = np.concatenate([np.diff(bounds) for _, bounds in found])
    return np.concatenate([f.astype(np.int32) for f, _ in found]), np.concatenate(([0], np.cumsum(sizes)))


def pair_features(codes: np.ndarray, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each word but the first with the word before it; all pairs
    of equal words share bucket 0."""
    left, right = codes[:-1], codes[1:]
    pairs = _bucket(mixed(hashes[left] * np.uint64(31) + hashes[right]), buckets - 1) + 1
    return np.where(left == right, 0, pairs)


def train(texts: list[str], labels: np.ndarray, params: QualityParams) -> QualityModel:
    """One class or none in the sample: a constant model of the share of 1."""
    n, size, dim = len(texts), params.buckets, params.dim
    share = (labels.sum() + 0.5) / (n + 1.0)
    if n == 0 or labels.min() == labels.max():
        zero = np.zeros(size, np.float32)
        return QualityModel(zero, zero, float(np.log(share / (1 - share))))
    starts, codes, words = words_of(pa.array(texts, pa.large_string()))
    del texts
    features, bounds = _features_in_steps(words, size)
    hashes = word_hashes(words)
    # the features of all documents one after another, with their weights; in
    # buffers that grow in place, as the driver's memory is small
    flat, weights, ends = array("i"), array("f"), [0]
    for i in range(n):
        own = codes[starts[i]:starts[i + 1]]
        parts = [features[bounds[c]:bounds[c + 1]] for c in own]
        if len(own) > 1:
            parts.append(pair_features(own, hashes, size) + size)
        ids, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0), np.zeros(0))
        flat.frombytes(ids.astype(np.int32).tobytes())
        weights.frombytes((counts / max(counts.sum(), 1)).astype(np.float32).tobytes())
        ends.append(ends[-1] + len(ids))
    del features, bounds, hashes, codes, words
    flat, weights = np.frombuffer(flat, np.int32), np.frombuffer(weights, np.float32)
    rng = np.random.default_rng(params.seed)
    vectors = rng.uniform(-1.0 / dim, 1.0 / dim, (2 * size, dim)).astype(np.float32)
    output, bias = np.zeros((dim, 2), np.float32), np.array([0.0, np.log(share / (1 - share))], np.float32)
    output[:, 1] = rng.normal(0, 0.3, dim)
    steps, done = params.epochs * n, 0
    for _ in range(params.epochs):
        for i in rng.permutation(n):
            ids, weight = flat[ends[i]:ends[i + 1]], weights[ends[i]:ends[i + 1]]
            rate = params.rate * (1.0 - done / steps)
            done += 1
            rows = vectors[ids]
            mean = weight @ rows
            logits = mean @ output + bias
            gradient = np.exp(logits - logits.max())
            gradient /= gradient.sum()
            gradient[labels[i]] -= 1.0
            # a step on an average moves each vector by its weight; the norm of
            # the weights makes long and short documents learn alike
            scale = rate / max(float(weight @ weight), 1e-3) if len(ids) else 0.0
            vectors[ids] = rows - np.outer(weight * min(scale, 60.0 * rate), output @ gradient)
            output -= rate * 0.1 * np.outer(mean, gradient)
            bias -= rate * 0.01 * gradient
    folded = vectors @ (output[:, 1] - output[:, 0])
    return QualityModel(folded[:size], folded[size:], float(bias[1] - bias[0]))


def scores(texts: pa.Array, model: QualityModel) -> np.ndarray:
    """Probability of label 1 of every text; without words, that of the intercept."""
    starts, codes, words = words_of(texts)
    if not len(codes):
        return np.full(len(texts), float(sigmoid(model.intercept)))
    size = len(model.weights)
    features, bounds = word_features(words, size)
    of_word = np.add.reduceat(model.weights[features].astype(np.float64), bounds[:-1])
    pairs = np.zeros(len(codes))
    pairs[1:] = model.pair_weights[pair_features(codes, word_hashes(words), size)]
    first = starts[:-1][starts[:-1] < starts[1:]]
    pairs[first] = 0.0  # the first word of a text has no word before it
    total = segment_sums(of_word[codes] + pairs, starts)
    n = segment_sums(np.diff(bounds)[codes] + 1.0, starts) - 1.0
    return sigmoid(total / np.maximum(n, 1.0) + model.intercept)


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    sample = labelled_sample(
        docs, labels, "quality", ~remainder_is(F.col("doc_id"), 5, 0), params.per_class, params.max_doc_chars
    )
    texts, marks = [sample["text"].tolist()], sample["label"].to_numpy(np.int64)
    del sample
    model = train(texts.pop(), marks, params)
    # what the sample took goes back to the system: later stages share the driver
    pa.default_memory_pool().release_unused()
    return model


def score_documents(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``, the probability of label 1 given the text alone.

    Null and empty texts get the probability of the intercept; every row is
    scored by itself, so repeated rows get equal scores and other columns,
    whatever their names, pass unchanged (a column ``name`` is replaced).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vars(model))  # plain arrays: executors need no package
    kept = docs.drop(name)
    schema = kept.withColumn(name, F.lit(0.0)).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = QualityModel(**shared.value)
        for batch in blocks(batches, max_bytes=2 << 20):
            text = text_array(batch.column(batch.schema.get_field_index("text")))
            values = pa.array(scores(text, model), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])

    return kept.mapInArrow(apply, schema)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", remainder_is(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
