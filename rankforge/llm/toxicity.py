"""Toxicity: a convolutional text classifier trained by all tasks in numpy.

A word's vector is the mean of the vectors of its hash and of the hashes of its
first letters. Filters over one, two and three words are maximised over the
whole text, and a logistic output reads the maxima. The output is scaled on
texts kept out of training; there, each language gets its own threshold for the
calibrated decision. The score itself sees nothing but the text. All labelled
texts, of any length, take part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import (
    MAX_BROADCAST_MARKS, blocks, remainder_is, sigmoid, table, text_array, word_hashes, words_of,
)
from rankforge.storage import materialize

WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6, 7)
_NO_LETTER = re.compile(r"[\W\d_]+")
_BLOCK = 1 << 15  # words convolved at a time


@dataclass(frozen=True)
class ToxicityParams:
    bits: int = 20  # of a word hash; the model has no more than 2 ** bits vectors
    dim: int = 12
    filters: int = 12  # of each width
    rounds: int = 2  # passes of all tasks, averaged after each
    epochs: int = 2  # of a task over its texts, in a round
    rate: float = 0.08
    min_documents: int = 3  # training documents a hash must occur in to get a vector
    texts_per_part: int = 4096
    seed: int = 5


@dataclass
class ToxicityModel:
    bits: int
    hashes: np.ndarray  # sorted hashes that have a vector of their own
    vectors: np.ndarray  # row 0: zero, for all others
    kernels: list[np.ndarray]  # per width: (width, dim, filters)
    biases: list[np.ndarray]
    output: np.ndarray
    intercept: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict = field(default_factory=dict)


def core_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words in lower case without anything but their letters: text starts,
    code per word, distinct words (empty for a word without letters)."""
    starts, codes, raw = words_of(pc.utf8_lower(texts))
    place: dict[str, int] = {}
    core = np.fromiter((place.setdefault(_NO_LETTER.sub("", w), len(place)) for w in raw), np.int64, len(raw))
    return starts, core[codes], list(place)


def word_keys(words: list[str], bits: int) -> np.ndarray:
    """Hashes of every word and of its first letters, one column each; -1 where
    the word is not longer than the prefix, or empty."""
    keys = np.full((len(words), 1 + len(PREFIXES)), -1, np.int64)
    for j, n in enumerate((None, *PREFIXES)):
        own = [i for i, w in enumerate(words) if (len(w) > n if n else w)]
        parts = [words[i][:n] + "*" * (n is not None) for i in own]
        keys[own, j] = (word_hashes(parts) >> np.uint64(64 - bits)).astype(np.int64)
    return keys


def _rows(model: ToxicityModel, keys: np.ndarray) -> np.ndarray:
    if not len(model.hashes):
        return np.zeros(keys.shape, np.int64)
    place = np.minimum(np.searchsorted(model.hashes, keys), len(model.hashes) - 1)
    return np.where(model.hashes[place] == keys, place + 1, 0)


def _maxima(model: ToxicityModel, of_word: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text the largest value of each filter. The text is followed by zero
    vectors, so that also an empty one has a window."""
    pad, n, widest = len(of_word), len(starts) - 1, max(WIDTHS)
    of_word = np.vstack([of_word, np.zeros((1, of_word.shape[1]), np.float32)])
    begin = starts[:-1] + np.arange(n) * widest
    padded = np.full(len(codes) + n * widest + widest, pad, np.int64)
    padded[np.arange(len(codes)) + np.repeat(np.arange(n) * widest, np.diff(starts))] = codes
    # a window may start at every word and at the first zero vector
    end = begin + np.diff(starts) + 1
    kernel = np.concatenate([k for kernels in model.kernels for k in kernels], axis=1)
    width = model.kernels[0].shape[2]
    best = np.full((n, width * len(WIDTHS)), -np.inf, np.float32)
    total = len(padded) - widest
    for low in range(0, total, _BLOCK):
        high = min(low + _BLOCK, total)
        z = of_word[padded[low:high + widest]] @ kernel
        value, at = np.empty((high - low, best.shape[1]), np.float32), 0
        for j, w in enumerate(WIDTHS):
            own = value[:, j * width:(j + 1) * width]
            own[:] = model.biases[j]
            for k in range(w):
                own += z[k:k + high - low, at * width:(at + 1) * width]
                at += 1
        first, last = np.searchsorted(end, low, "right"), np.searchsorted(begin, high, "left")
        if first < last:
            bounds = np.column_stack([np.maximum(begin[first:last], low), np.minimum(end[first:last], high)])
            cuts = bounds.ravel() - low
            if cuts[-1] == high - low:
                cuts = cuts[:-1]
            most = np.maximum.reduceat(value, cuts, axis=0)[::2]
            best[first:last] = np.maximum(best[first:last], most)
    return best


def logits(texts: pa.Array, model: ToxicityModel) -> np.ndarray:
    starts, codes, words = core_words(texts)
    rows = _rows(model, word_keys(words, model.bits))
    of_word = np.zeros((len(words), model.vectors.shape[1]), np.float32)
    for j in range(rows.shape[1]):
        of_word += model.vectors[rows[:, j]]
    maxima = np.maximum(_maxima(model, of_word / rows.shape[1], codes, starts), 0.0)
    return maxima.astype(np.float64) @ model.output + model.intercept


def scores(texts: pa.Array, model: ToxicityModel) -> np.ndarray:
    a, b = model.scale
    return sigmoid(a * logits(texts, model) + b)


def key_counts(texts: pa.Array, labels: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the texts' words and prefixes, and how many clean and how many
    toxic texts hold each; -1 stands for the texts themselves."""
    starts, codes, words = core_words(texts)
    keys = word_keys(words, bits)
    # a word once for each text
    own = np.unique(np.repeat(np.arange(len(labels)), np.diff(starts)) * max(len(words), 1) + codes)
    owner, word = own // max(len(words), 1), own % max(len(words), 1)
    pairs = [np.arange(len(labels), dtype=np.int64) << bits + 1]
    for j in range(keys.shape[1]):
        column = keys[word, j]
        pairs.append((owner[column >= 0] << bits + 1) + column[column >= 0] + 1)
    pairs = np.unique(np.concatenate(pairs))
    key, place = np.unique((pairs & ((1 << bits + 1) - 1)) - 1, return_inverse=True)
    toxic = np.bincount(place, labels[pairs >> bits + 1], minlength=len(key)).astype(np.int64)
    return key, np.bincount(place, minlength=len(key)) - toxic, toxic


def untrained(key: np.ndarray, clean: np.ndarray, toxic: np.ndarray, params: ToxicityParams) -> ToxicityModel:
    """Vectors start with the log-odds of their hash in one component and small
    random values in the others."""
    rng = np.random.default_rng(params.seed)
    dim, width = params.dim, params.filters
    n_clean, n_toxic = int(clean[key < 0].sum()), int(toxic[key < 0].sum())
    share = (n_toxic + 0.5) / (n_clean + n_toxic + 1.0)
    frequent = (key >= 0) & (clean + toxic >= params.min_documents)
    known, clean, toxic = key[frequent], clean[frequent], toxic[frequent]
    vectors = np.zeros((len(known) + 1, dim), np.float32)
    vectors[1:] = rng.normal(0, 0.1, (len(known), dim))
    vectors[1:, 0] = np.log((toxic + 0.5) / (n_toxic + 1.0)) - np.log((clean + 0.5) / (n_clean + 1.0))
    kernels = [rng.normal(0, 0.15, (w, dim, width)).astype(np.float32) for w in WIDTHS]
    for k in kernels:
        k[0, 0, :] = np.abs(k[0, 0, :]) + 0.5
    model = ToxicityModel(params.bits, known.astype(np.int64), vectors, kernels,
                          [np.zeros(width, np.float32) for _ in WIDTHS],
                          np.full(width * len(WIDTHS), 0.1), float(np.log(share / (1 - share))))
    if not n_clean or not n_toxic:
        model.output[:] = 0.0
    return model


class Trainer:
    """A model in training: Adagrad, one text at a time. ``touched`` counts the
    steps that changed each vector, ``texts`` all of them."""

    def __init__(self, model: ToxicityModel, params: ToxicityParams, squares: tuple | None = None):
        self.params, self.texts = params, 0
        self.model = ToxicityModel(model.bits, model.hashes, model.vectors.copy(), [k.copy() for k in model.kernels],
                                   [b.copy() for b in model.biases], model.output.copy(), model.intercept)
        self.touched = np.zeros(len(model.vectors), np.int64)
        of_vectors, others = squares or (np.full(model.vectors.shape, 1e-2, np.float32), None)
        self.of_vectors = of_vectors.copy()
        self.squares = [np.full(v.shape, 1e-2) for v in self._values()] if others is None else [s.copy() for s in others]

    def _values(self) -> list[np.ndarray]:
        m = self.model
        return [*m.kernels, *m.biases, m.output, np.array([m.intercept])]

    def flat(self) -> np.ndarray:
        """All parameters but the vectors, with their squares."""
        return np.concatenate([v.ravel().astype(np.float64) for v in (*self._values(), *self.squares)])

    def unflat(self, flat: np.ndarray) -> None:
        shapes = [v.shape for v in self._values()] * 2
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])
        values = [v.reshape(s) for v, s in zip(np.split(flat[:cuts[-1]], cuts[:-1]), shapes)]
        n, m = len(WIDTHS), self.model
        m.kernels[:] = [v.astype(np.float32) for v in values[:n]]
        m.biases[:] = [v.astype(np.float32) for v in values[n:2 * n]]
        m.output, m.intercept = values[2 * n].copy(), float(values[2 * n + 1][0])
        self.squares = [v.copy() for v in values[len(shapes) // 2:]]

    def learn(self, texts: pa.Array, labels: np.ndarray, epochs: int) -> None:
        model, rate, n = self.model, self.params.rate, len(labels)
        starts, codes, words = core_words(texts)
        rows = _rows(model, word_keys(words, model.bits))
        rng = np.random.default_rng((self.params.seed, self.texts))
        dim, width = model.vectors.shape[1], model.kernels[0].shape[2]
        of_kernels, of_biases = self.squares[:len(WIDTHS)], self.squares[len(WIDTHS):2 * len(WIDTHS)]
        of_output, of_intercept = self.squares[2 * len(WIDTHS):]
        columns, widest, parts = np.arange(width), max(WIDTHS), rows.shape[1]
        self.texts += n

        def step(value, square, gradient):
            square += gradient * gradient
            return value - rate * gradient / np.sqrt(square)

        for i in (i for _ in range(epochs) for i in rng.permutation(n)):
            own = rows[codes[starts[i]:starts[i + 1]]]
            x = np.zeros((len(own) + widest, dim), np.float32)
            x[: len(own)] = model.vectors[own].mean(axis=1)
            length = len(own) + 1
            best, places = [], []
            for j, w in enumerate(WIDTHS):
                value = model.biases[j] + sum(x[k:k + length] @ model.kernels[j][k] for k in range(w))
                place = value.argmax(axis=0)
                best.append(value[place, columns])
                places.append(place)
            hidden = np.maximum(np.concatenate(best), 0.0)
            error = float(sigmoid(hidden @ model.output + model.intercept)) - labels[i]
            back = error * model.output * (hidden > 0)
            model.output = step(model.output, of_output, error * hidden)
            model.intercept = float(step(model.intercept, of_intercept, error)[0])
            slope = np.zeros_like(x)
            for j, w in enumerate(WIDTHS):
                part = back[j * width:(j + 1) * width]
                gradient = np.empty(model.kernels[j].shape)
                for k in range(w):
                    gradient[k] = (x[places[j] + k] * part[:, None]).T
                    np.add.at(slope, places[j] + k, (model.kernels[j][k] * part).T)
                model.kernels[j][:] = step(model.kernels[j], of_kernels[j], gradient)
                model.biases[j] = step(model.biases[j], of_biases[j], part).astype(np.float32)
            touched = np.flatnonzero(slope[: len(own)].any(axis=1))
            if len(touched):
                ids, inverse = np.unique(own[touched].ravel(), return_inverse=True)
                gradient = np.zeros((len(ids), dim), np.float32)
                np.add.at(gradient, inverse, np.repeat(slope[touched] / parts, parts, axis=0))
                gradient[ids == 0] = 0.0
                square = self.of_vectors[ids]
                model.vectors[ids] = step(model.vectors[ids], square, gradient)
                self.of_vectors[ids] = square
                self.touched[ids] += 1


def train(texts: list[str], labels: np.ndarray, params: ToxicityParams) -> ToxicityModel:
    """The model of texts that one task holds."""
    column, labels = pa.array(texts, pa.large_string()), np.asarray(labels)
    trainer = Trainer(untrained(*key_counts(column, labels, params.bits), params), params)
    if trainer.model.output.any():
        trainer.learn(column, labels, params.rounds * params.epochs)
    return trainer.model


def calibrate(model: ToxicityModel, z: np.ndarray, labels: np.ndarray, langs: list, counts: np.ndarray,
              min_each: int = 10) -> None:
    """Logistic scaling on kept-out texts, given as ``counts`` of equal outputs
    ``z``, then per language the threshold with the best F1; languages with fewer
    than ``min_each`` texts of either class keep 0.5."""
    n_toxic, n = counts[labels == 1].sum(), counts.sum()
    if not 0 < n_toxic < n:
        return
    a, b = 1.0, 0.0
    target = np.where(labels == 1, 1 - 1 / (n_toxic + 2), 1 / (n - n_toxic + 2))
    for _ in range(50):
        p = sigmoid(a * z + b)
        error, curve = counts * (p - target), counts * (p * (1 - p) + 1e-9)
        hessian = np.array([[np.sum(curve * z * z) + 1e-3, np.sum(curve * z)], [np.sum(curve * z), np.sum(curve) + 1e-3]])
        move = np.linalg.solve(hessian, [np.sum(error * z), np.sum(error)])
        move *= min(1.0, 2.0 / max(np.abs(move).max(), 1e-9))
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    if a <= 0:
        return
    model.scale = (float(a), float(b))
    p = sigmoid(a * z + b)
    of = np.array([x or "" for x in langs])
    for lang in sorted({x for x in langs if x}):
        rows = np.flatnonzero(of == lang)
        rows = rows[np.argsort(p[rows])]
        own, every = p[rows], counts[rows].astype(np.float64)
        truth = every * (labels[rows] == 1)
        if min(truth.sum(), (every - truth).sum()) < min_each:
            continue
        cuts = np.concatenate(([0.5], (own[1:] + own[:-1]) / 2))
        first = np.searchsorted(own, cuts)  # the rows at or over each cut
        above, right = (np.append(np.cumsum(v[::-1])[::-1], 0.0)[first] for v in (every, truth))
        f1 = 2 * right / np.maximum(above + truth.sum(), 1)
        best = cuts[f1 == f1.max()]
        # among equally good cuts the one nearest to 0.5
        model.thresholds[lang] = float(best[np.abs(best - 0.5).argmin()])


def labelled(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """``(text, lang, label, kept_out)`` of every document with a label to learn
    from, written once, in parts of about ``texts_per_part``. A document marked
    twice has the larger label, an id that comes twice its smallest text."""
    learnable = ~remainder_is(F.col("doc_id"), 5, 0)
    marks = (
        labels.where(learnable & F.col("toxic").isin(0, 1)).groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    n = marks.count()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    found = texts.join(F.broadcast(marks) if n <= MAX_BROADCAST_MARKS else marks, "doc_id")
    whole = found.repartition(max(1, -(-n // params.texts_per_part)), "doc_id").groupBy("doc_id", "label").agg(
        F.min(F.struct("text", "lang")).alias("row"))
    kept_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4
    return materialize(whole.select("row.text", "row.lang", "label", kept_out.alias("kept_out")), "labelled")


def _counted(rows: DataFrame, params: ToxicityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`key_counts` of all ``rows``: hashes that at least ``min_documents``
    texts hold, 2 ** bits at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = key_counts(text_array(block.column(0)), block.column(1).to_numpy(), params.bits)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], names=["key", "clean", "toxic"])

    counts = rows.select("text", "label").mapInArrow(run, "key bigint, clean bigint, toxic bigint").groupBy("key").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = counts.where((F.col("key") < 0) | (F.col("clean") + F.col("toxic") >= params.min_documents)).toArrow()
    key, clean, toxic = (found.column(i).to_numpy() for i in range(3))
    order = np.argsort(key)
    return key[order], clean[order], toxic[order]


def _round(rows: DataFrame, model: ToxicityModel, squares: tuple | None, params: ToxicityParams) -> tuple[ToxicityModel, tuple]:
    """Every task goes on from ``model`` with its own texts. A vector becomes the
    mean of those of the tasks that changed it, weighted by how often they did;
    the other parameters are weighted by the tasks' texts."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((vars(model), squares))
    width = 2 * params.dim
    names = [f"v{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, squares = shared.value
        trainer = Trainer(ToxicityModel(**start), params, squares)
        for block in blocks(batches):
            trainer.learn(text_array(block.column(0)), block.column(1).to_numpy(), params.epochs)
        if not trainer.texts:
            return
        flat = trainer.flat()
        flat = np.append(flat, np.zeros(-len(flat) % width)).reshape(-1, width)
        own = np.flatnonzero(trainer.touched)
        values = np.vstack([flat, np.hstack([trainer.model.vectors[own], trainer.of_vectors[own]])])
        key = np.concatenate([-1 - np.arange(len(flat)), own])
        weight = np.concatenate([np.full(len(flat), trainer.texts), trainer.touched[own]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(weight), *(pa.array(v.astype(np.float32)) for v in values.T)], names=["key", "n", *names])

    schema = "key bigint, n bigint, " + ", ".join(f"{c} float" for c in names)
    found = rows.select("text", "label").mapInArrow(run, schema).groupBy("key").agg(
        *((F.sum(F.col("n") * F.col(c).cast("double")) / F.sum("n")).cast("float").alias(c) for c in names))
    table = found.toArrow()  # as many rows as the model has vectors
    key = table.column(0).to_numpy()
    values = np.column_stack([table.column(i).to_numpy() for i in range(1, width + 1)])
    trainer = Trainer(model, params, squares)
    own = key >= 0
    trainer.model.vectors[key[own]] = values[own, :params.dim]
    trainer.of_vectors[key[own]] = values[own, params.dim:]
    trainer.unflat(values[~own][np.argsort(-key[~own])].ravel().astype(np.float64))
    return trainer.model, (trainer.of_vectors, trainer.squares)


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Learns from every labelled document: four fifths train, each task on its
    own texts with the mean of all after each round, the rest calibrates."""
    spark = docs.sparkSession
    rows = labelled(docs, labels, params)
    training = rows.where(~F.col("kept_out"))
    model, squares = untrained(*_counted(training, params), params), None
    if not model.output.any():
        return model
    for _ in range(params.rounds):
        model, squares = _round(training, model, squares, params)
    shared = spark.sparkContext.broadcast(vars(model))

    def outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(**shared.value)
        for block in blocks(batches):
            z = np.clip(logits(text_array(block.column(0)), model), -60, 60)
            yield pa.RecordBatch.from_arrays([block.column(1), block.column(2), pa.array(np.round(z, 2))],
                                             names=["label", "lang", "z"])

    held = rows.where("kept_out").select("text", "label", "lang").mapInArrow(outputs, "label int, lang string, z double")
    found = held.groupBy("label", "lang", "z").agg(F.count(F.lit(1)).alias("n")).orderBy("z", "label", "lang").toPandas()
    calibrate(model, found["z"].to_numpy(float), found["label"].to_numpy(np.int64),
              [x if isinstance(x, str) else None for x in found["lang"]], found["n"].to_numpy(np.int64))
    return model


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (probability of being toxic, from the text alone),
    ``threshold`` (that of the row's language, else 0.5) and ``toxic`` (score at
    or over it).

    Null texts count as empty; an empty text gets the score of a lone zero
    vector. Rows are scored one by one: repeated rows get equal scores, other
    columns pass unchanged, and columns of these three names are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vars(model))  # plain arrays: executors need no package
    kept = docs.drop("score", "threshold", "toxic")
    schema = kept.withColumn("score", F.lit(0.0)).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(**shared.value)
        for batch in blocks(batches):
            text = text_array(batch.column(batch.schema.get_field_index("text")))
            values = pa.array(scores(text, model), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, "score"])

    threshold = F.lit(0.5)
    for lang, value in sorted(model.thresholds.items()):
        threshold = F.when(F.col("lang") == lang, value).otherwise(threshold)
    scored = kept.mapInArrow(apply, schema).withColumn("threshold", threshold if "lang" in kept.columns else F.lit(0.5))
    return scored.withColumn("toxic", (F.col("score") >= F.col("threshold")).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id", remainder_is(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("toxic").alias("flagged"), "threshold",
    )
