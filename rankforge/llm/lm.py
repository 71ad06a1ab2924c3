"""Language-model scores: a causal self-attention model over subword ids.

The model of :mod:`rankforge.llm.attention` learns from all training documents:
every task goes once over the texts it holds, and the tasks' parameters, weighted
by their numbers of tokens, are averaged; the next round goes on from there with
other documents. Scoring cuts a text into chunks; a window is a chunk and the one
before it, so each subword is scored once, with at least a chunk of context, in
batches of masked attention.

Words are those of the text in lower case (A-Z), each with a space before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import attention
from rankforge.llm.attention import ModelParams, Trainer
from rankforge.llm.common import blocks, remainder_is, table, text_array, words_of
from rankforge.llm.packing import Encoder
from rankforge.storage import materialize

END_WORD = ""  # words are never empty
MAX_WORD = 64  # characters of a word that may be sent to all executors
_PIECE = 2048  # parameters of a row


@dataclass(frozen=True)
class LmParams:
    vocabulary: str = "byte_bpe_50k"
    end_id: int = 50256
    smoothing: float = 0.1
    rounds: int = 2  # of training; a document belongs to one
    frequent_words: int = 200_000  # words whose counts every executor gets, at most
    model: ModelParams = field(default_factory=ModelParams)


def lower_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    return words_of(pc.ascii_lower(texts))


# Counts -----------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over all rows, the end of a document being a word too."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, max_bytes=16 << 20):
            lists = pc.ascii_split_whitespace(pc.ascii_lower(text_array(block.column(0))))
            encoded = lists.flatten().dictionary_encode()
            words = encoded.dictionary
            n = np.bincount(encoded.indices.to_numpy(zero_copy_only=False), minlength=len(words))
            # empty words, which splitting leaves at the ends of a text, are none
            n = np.where(pc.equal(words, END_WORD).to_numpy(zero_copy_only=False), 0, n)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([words, pa.array([END_WORD])]), pa.array(np.append(n, block.num_rows))],
                names=["word", "c"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(apply, "word string, c bigint")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


def subword_counts(counts: DataFrame, params: LmParams) -> np.ndarray:
    """How often every id occurs in the counted words."""
    vocabulary, end_id = params.vocabulary, params.end_id

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder(vocabulary), np.zeros(end_id + 1, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 50_000):
                words, n = batch.column(0).slice(low, 50_000).to_pylist(), batch.column(1).slice(low, 50_000).to_numpy()
                own = np.array([w != END_WORD for w in words], bool)
                total[end_id] += n[~own].sum()
                if own.any():
                    ids, starts = encoder.encode_words([w for w in words if w != END_WORD])
                    np.add.at(total, ids, np.repeat(n[own], np.diff(starts)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "c"])

    rows = counts.select("word", "c").mapInArrow(apply, "id bigint, c bigint").groupBy("id").agg(F.sum("c").alias("c"))
    total = np.zeros(end_id + 1, np.int64)  # at most the vocabulary reaches the driver
    for row in rows.collect():
        total[row["id"]] = row["c"]
    return total


def frequent_words(counts: DataFrame, params: LmParams) -> dict[str, int]:
    """The counts of the most frequent words, ``frequent_words`` at most: all of
    those above a count that a histogram of the counts gives."""
    bucket = F.floor(8 * F.log2(F.col("c").cast("double")))
    short = counts.where(F.length("word") <= MAX_WORD)
    rows = short.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()  # a few hundred
    lowest, n = None, 0
    for row in sorted(rows, key=lambda r: -r["b"]):
        n += row["n"]
        if n > params.frequent_words:
            break
        lowest = row["b"]
    if lowest is None:
        return {}
    return {r["word"]: r["c"] for r in short.where(bucket >= lowest).select("word", "c").toLocalIterator()}


# Model ------------------------------------------------------------------------


def subwords(words_of_texts, encoder: Encoder, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, each with its end, and where they
    start, with the end; from the words of the texts."""
    starts, codes, words = words_of_texts
    ids, bounds = encoder.encode_words(words)
    n = len(words)
    length = np.append(np.diff(bounds), 1)
    begin = np.append(bounds[:-1], len(ids))
    codes = np.insert(codes, starts[1:], n)
    counts = length[codes]
    out = np.cumsum(counts)
    places = np.arange(out[-1]) + np.repeat(begin[codes] - (out - counts), counts)
    every = np.append(ids.astype(np.int64), end_id)
    return every[places], np.concatenate(([0], out[starts[1:] + np.arange(len(starts) - 1)]))


def _summed(rows: DataFrame) -> DataFrame:
    """Weighted sums of the ``values`` of every ``piece``, in the order of the
    tasks, so that reruns agree. A task adds row after row; it holds one sum."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, tokens, total = None, 0, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([tokens], pa.int64()), pa.array([total], pa.list_(pa.float64()))],
                names=["piece", "tokens", "values"])

        for batch in batches:
            starts = batch.column(3).offsets.to_numpy()
            flat = batch.column(3).flatten().to_numpy()
            own = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), starts - starts[0], starts[1:] - starts[0])
            for number, weight, low, high in own:
                if number != piece:
                    if total is not None:
                        yield done()
                    piece, tokens, total = number, 0, np.zeros(high - low)
                tokens += weight
                total += weight * flat[low:high].astype(np.float64)
        if total is not None:
            yield done()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "piece").sortWithinPartitions("piece", "task")
    return dealt.mapInArrow(apply, "piece int, tokens bigint, values array<double>")


def _code_type(params: LmParams) -> str:
    return "<u2" if params.end_id < 1 << 16 else "<u4"


def _packed(ids: np.ndarray, starts: np.ndarray, params: LmParams) -> pa.Array:
    """The ids of every text as the bytes of fixed-size numbers."""
    data = ids.astype(_code_type(params))
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [
        None, pa.py_buffer((starts * data.itemsize).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(column: pa.Array, params: LmParams) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where they start, with the end."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(_code_type(params))
    return data, (offsets - offsets[0]) // data.itemsize


def _round(params: LmParams) -> Column:
    """The round of training that a document belongs to."""
    return F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(params.rounds)).cast("int")


def subword_rows(docs: DataFrame, params: LmParams) -> DataFrame:
    """``(round, ids)`` of every document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for block in blocks(batches, max_bytes=4 << 20):
            encoder = encoder or Encoder(params.vocabulary)
            found = subwords(lower_words(text_array(block.column(1))), encoder, params.end_id)
            yield pa.RecordBatch.from_arrays([block.column(0), _packed(*found, params)], names=["round", "ids"])

    texts = docs.select(_round(params).alias("round"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(apply, "round int, ids binary")


def fit(docs: DataFrame, counts: np.ndarray, params: LmParams = LmParams()) -> tuple[dict, dict]:
    """(coding, parameters) from all training rows ``docs`` and their subword
    counts. Rows have ``doc_id`` and ``text``, or ``round`` and ``ids`` where
    texts are encoded already. Without rows the parameters are the untrained ones."""
    spark = docs.sparkSession
    encoded = docs if "ids" in docs.columns else materialize(subword_rows(docs, params), "subwords")
    code = attention.coding(counts, params.model)
    state = Trainer.start(params.model)
    names, shapes = list(state), [v.shape for v in state.values()]
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    for number in range(params.rounds):
        shared = spark.sparkContext.broadcast((code, state))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            code, state = shared.value
            trainer = Trainer(state, params.model)
            for block in blocks(batches, "ids", max_bytes=2 << 20):
                ids, starts = _unpacked(block.column(0), params)
                trainer.learn(*attention.chunks(ids, starts, code, params.model.chunk)[:2], code)
            if trainer.tokens:
                flat = np.concatenate([trainer.state[k].ravel() for k in names]).astype(np.float32)
                starts = np.append(np.arange(0, len(flat), _PIECE), len(flat))
                n = len(starts) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, TaskContext.get().partitionId()), pa.int32()),
                     pa.array(np.full(n, trainer.tokens)), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat))],
                    names=["piece", "task", "tokens", "values"])

        own = encoded.where(F.col("round") == number).select("ids")
        rows = _summed(own.mapInArrow(learn, "piece int, task int, tokens bigint, values array<float>")).collect()
        if rows:  # as many parameters as one task has
            flat = np.concatenate([np.array(r["values"]) / r["tokens"] for r in sorted(rows, key=lambda r: r["piece"])])
            state = {k: a.reshape(s).astype(np.float32) for k, a, s in zip(names, np.split(flat, cuts), shapes)}
    return code, attention.weights_of(state)


# Scores -----------------------------------------------------------------------


def score_documents(docs: DataFrame, learnable: Column, params: LmParams = LmParams()) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Counts and model come from the rows where ``learnable`` holds. A null text
    counts as empty: its only token is the end. Repeated rows count and appear
    as often as they come. Without training rows all counts are 0 and the model
    is the untrained one; no rows give none. Other columns are not read.
    Texts are taken apart twice: for the counts, and into the ids that training
    and scoring read.
    """
    spark = docs.sparkSession
    train = docs.where(learnable).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = materialize(word_counts(train), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    smooth, below = params.smoothing, total + params.smoothing * (distinct + 1)
    frequent = spark.sparkContext.broadcast(frequent_words(counts, params))
    end_count = counts.where(F.col("word") == END_WORD).select("c").first()
    end_known, end_c = int(end_count is not None), end_count[0] if end_count else 0

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        number = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "round", "word", "n", "n_tokens", "n_known", "base", "ids"]
        for block in blocks(batches, max_bytes=4 << 20):
            known = frequent.value
            encoder = encoder or Encoder(params.vocabulary)
            texts = text_array(block.column(2))
            m = len(texts)
            starts, codes, words = lower_words(texts)
            ids = _packed(*subwords((starts, codes, words), encoder, params.end_id), params)
            counted = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
            common = counted >= 0
            log = np.log10((np.maximum(counted, 0) + smooth) / below)
            owner = np.repeat(np.arange(m), np.diff(starts))
            is_common = common[codes]
            end = np.log10((end_c + smooth) / below)
            base = np.bincount(owner[is_common], log[codes[is_common]], minlength=m) + end
            n_known = np.bincount(owner[is_common], minlength=m) + end_known
            rows = number + np.arange(m)
            number += m
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), block.column(0), block.column(1), pa.nulls(m, pa.string()), pa.array(np.zeros(m, np.int64)),
                 pa.array(np.diff(starts) + 1), pa.array(n_known), pa.array(base), ids], names=names)
            # the other words of each text, to be looked up by a join
            pairs, n = np.unique(owner[~is_common] * max(len(words), 1) + codes[~is_common], return_counts=True)
            if len(pairs):
                k = len(pairs)
                word = pa.array(words, pa.string()).take(pa.array(pairs % len(words)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[pairs // len(words)]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), word,
                     pa.array(n.astype(np.int64)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                     pa.nulls(k, pa.float64()), pa.nulls(k, pa.binary())], names=names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, weights = shared.value
        for block in blocks(batches, "ids", max_bytes=2 << 20):
            found = attention.score(weights, *_unpacked(block.column(5), params), code, params.model) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [*block.columns[:5], pa.array(found)], names=["row", "doc_id", "n_tokens", "n_known", "base", "score"])

    encoded = materialize(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.when(learnable, _round(params)).alias("round"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(
        apply, "row bigint, doc_id bigint, round int, word string, n bigint, n_tokens bigint, n_known bigint, "
               "base double, ids binary"), "subwords")
    shared = spark.sparkContext.broadcast(fit(encoded, subword_counts(counts, params), params))
    rows = materialize(
        encoded.where("ids is not null").select("row", "doc_id", "n_tokens", "n_known", "base", "ids").mapInArrow(
            score, "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double"), "scores")
    rare = encoded.where("word is not null").select("row", "word", "n").join(counts, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + smooth) / below)).alias("more_base"))
    return rows.join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder_is(F.col("doc_id"), 10, 0)
    found = score_documents(table(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
