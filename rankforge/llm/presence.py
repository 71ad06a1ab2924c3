"""Ranked lexical search by presence masks.

The items' terms are numbered and sent to the tasks, which cut every whole text
into terms once and keep what an item asks for: term numbers and counts beside the
document's length. Documents do not move. A task ranks them in blocks: each term
has a bitmap of the block's documents; the bitmaps of an item's terms, turned
sideways, are its documents' masks of matched terms. Documents with one mask form
a group, whose score cannot exceed the sum of its terms' largest contributions in
the block. Groups are scored exactly, highest bound first, until the next bound is
below the item's 20th score so far. Only each task's best rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import blocks, table, text_array, words_of
from rankforge.storage import materialize

# Bytes of item texts answered in one pass over the documents, which bounds the
# numbered terms that are sent to every executor.
MAX_ITEM_BYTES = 16 << 20
_SCALE = 1_000_000_000


@dataclass(frozen=True)
class SearchParams:
    k: int = 20
    item_bytes: int = MAX_ITEM_BYTES
    block_docs: int = 8192  # documents whose bitmaps a task holds
    first_docs: int = 64  # documents scored before the bounds are looked at again


def _separators() -> np.ndarray:
    """Bytes as they count in terms: A-Z as a-z, what parts terms as blanks."""
    seen = np.arange(256, dtype=np.uint8)
    ascii_term = np.array([chr(b).isalnum() for b in range(128)] + [True] * 128)
    seen[65:91] += 32
    return np.where(ascii_term, seen, 32).astype(np.uint8)


_BYTES = _separators()


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Terms of all texts, in the form of :func:`words_of`: digits, letters and
    everything beyond ASCII belong to terms, A-Z count as a-z."""
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), []
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset:texts.offset + len(texts) + 1]
    seen = _BYTES[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]]
    parts = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(seen.tobytes())]
    return words_of(pa.Array.from_buffers(texts.type, len(texts), parts))


def counted(starts: np.ndarray, codes: np.ndarray, n_codes: int):
    """(row, code, times) of the distinct codes of every row, in order."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    keys, times = np.unique(row * max(n_codes, 1) + codes, return_counts=True)
    return keys // max(n_codes, 1), keys % max(n_codes, 1), times


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term, qtf)``. Texts of one item_id count together, a row that
    comes twice once; without an id or a term there is no item."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            starts, codes, terms = terms_of(text_array(batch.column(1)))
            row, code, times = counted(starts, codes, len(terms))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(terms, pa.string()).take(pa.array(code)),
                 pa.array(times, pa.int64())], names=["item_id", "term", "qtf"])

    texts = items.where("item_id is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return texts.mapInArrow(apply, "item_id bigint, term string, qtf bigint").groupBy("item_id", "term").agg(
        F.sum("qtf").alias("qtf"))


def matches(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of every row: how many terms it has, and the
    numbers and counts of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in blocks(batches):
            starts, codes, terms = terms_of(text_array(batch.column(1)))
            asked = np.fromiter((number.get(t, -1) for t in terms), np.int64, len(terms))
            numbers = asked[codes]
            wanted = numbers >= 0
            kept = np.concatenate(([0], np.cumsum(wanted)))[starts]
            row, term, times = counted(kept, numbers[wanted], len(number))
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(c, pa.int32()))
                     for c in (term, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts)), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        apply, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


class Best:
    """The best k (score, id) pairs so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """What a score must reach to count."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.floor
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


class Block:
    """The matched terms of some documents, by term: bitmaps and contributions."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray):
        self.ids, self.n = ids, len(ids)
        row = np.repeat(np.arange(self.n), np.diff(starts))
        order = np.lexsort((row, terms))
        row, term, tf = row[order], terms[order], tfs[order]
        self.worth = weights[term] * (_SCALE * tf // (1000 * tf + 12 * m[row]))
        self.terms, first = np.unique(term, return_index=True)
        local = np.searchsorted(self.terms, term)
        self.keys = local * self.n + row
        self.most = np.maximum.reduceat(self.worth, first) if len(first) else np.zeros(0, np.int64)
        self.bits = np.zeros((len(self.terms), -(-self.n // 8)), np.uint8)
        cuts = np.append(first, len(row))
        for low in range(0, len(self.terms), 1024):
            high = min(low + 1024, len(self.terms))
            own = slice(cuts[low], cuts[high])
            plain = np.zeros((high - low, self.n), bool)
            plain[local[own] - low, row[own]] = True
            self.bits[low:high] = np.packbits(plain, axis=1)

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(documents with any of the terms, group of each, the groups' masks as
        rows of 0 and 1, all documents' masks): a mask tells which terms occur."""
        present = np.unpackbits(self.bits[terms], axis=1, count=self.n)
        packed = np.packbits(present, axis=0)
        found = np.flatnonzero(np.bitwise_or.reduce(packed, axis=0))
        words = np.zeros((len(found), -(-len(packed) // 8) * 8), np.uint8)
        words[:, :len(packed)] = packed[:, found].T
        if words.shape[1] == 8:
            keys = words.view(np.uint64)[:, 0]
        else:
            keys = words.view(f"V{words.shape[1]}")[:, 0]
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        return found, group, present[:, found[first]].T, present

    def rank(self, terms: np.ndarray, times: np.ndarray, best: Best, first_docs: int) -> int:
        """Adds the block's documents to an item's ``best``; returns how many
        were scored."""
        place = np.minimum(np.searchsorted(self.terms, terms), max(len(self.terms) - 1, 0))
        here = self.terms[place] == terms if len(self.terms) else np.zeros(len(terms), bool)
        terms, times = place[here], times[here]
        if not len(terms):
            return 0
        found, group, masks, present = self.masks(terms)
        bound = masks.astype(np.int64) @ (self.most[terms] * times)
        order = np.argsort(-bound, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        by_bound = np.argsort(place[group], kind="stable")
        found, bound = found[by_bound], bound[order]
        ends = np.cumsum(np.bincount(place[group], minlength=len(order)))
        done, scored, step = 0, 0, first_docs
        while done < len(bound) and bound[done] >= best.floor:
            # whole groups, about ``step`` documents, none that cannot count any more
            upto = min(max(done + 1, int(np.searchsorted(ends, scored + step))),
                       int(np.searchsorted(-bound, -best.floor, side="right")))
            docs = found[scored:ends[upto - 1]]
            t, d = np.nonzero(present[:, docs])
            at = np.searchsorted(self.keys, terms[t] * self.n + docs[d])
            scores = np.zeros(len(docs), np.int64)
            np.add.at(scores, d, self.worth[at] * times[t])
            best.add(scores, self.ids[docs])
            done, scored, step = upto, int(ends[upto - 1]), 2 * step
        return scored


def _ranked(found: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int,
            n_terms: int, params: SearchParams) -> DataFrame:
    """``(item_id, doc_id, score)``: the best k rows of each item in each task."""
    shared = found.sparkSession.sparkContext.broadcast((items, weights))
    names = ["item_id", "doc_id", "score"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        best = [Best(params.k) for _ in asked]
        for batch in batches:
            for low in range(0, batch.num_rows, params.block_docs):
                part = batch.slice(low, params.block_docs)
                starts = part.column(2).offsets.to_numpy().astype(np.int64)
                n = part.column(1).to_numpy()
                m = 75 + 25 * n * n_docs // n_terms
                block = Block(part.column(0).to_numpy(), m, starts - starts[0],
                              part.column(2).flatten().to_numpy().astype(np.int64),
                              part.column(3).flatten().to_numpy().astype(np.int64), weight)
                for (_, terms, times), own in zip(asked, best):
                    block.rank(terms, times, own, params.first_docs)
        for low in range(0, len(best), 4096):
            part = best[low:low + 4096]
            ids = np.repeat([i for i, _, _ in asked[low:low + 4096]], [len(b.ids) for b in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int64)), pa.array(np.concatenate([b.ids for b in part])),
                 pa.array(np.concatenate([b.scores for b in part]))], names=names)

    return found.mapInArrow(apply, "item_id bigint, doc_id bigint, score bigint")


def _one_pass(docs: DataFrame, wanted: DataFrame, params: SearchParams) -> DataFrame | None:
    """``_ranked`` for items whose (item_id, term, qtf) rows are few enough to number."""
    rows = wanted.orderBy("item_id", "term").toPandas()
    if not len(rows):
        return None
    terms = {t: i for i, t in enumerate(sorted(set(rows["term"])))}
    codes = rows["term"].map(terms).to_numpy(np.int64)
    found = materialize(matches(docs, terms), "matches")
    # the statistics are of all rows, those without an id included
    n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_terms:
        return None
    df = np.zeros(len(terms), np.int64)
    for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r["term"]] = r["df"]
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    ids, first = np.unique(rows["item_id"].to_numpy(np.int64), return_index=True)
    cuts, times = [*first.tolist(), len(rows)], rows["qtf"].to_numpy(np.int64)
    items = [(int(i), codes[low:high], times[low:high]) for i, low, high in zip(ids, cuts, cuts[1:])]
    askable = found.where((F.size("terms") > 0) & F.col("doc_id").isNotNull())
    return _ranked(askable, items, weights, n_docs, n_terms, params)


def search(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of every item.

    ``docs`` has doc_id and text, ``items`` item_id and text. Null and empty
    texts have no terms; such documents are not counted and never found, such
    items have no rows. Rows with a null doc_id count in the statistics but are
    not ranked. A doc_id that comes twice is two documents. Equal scores go by
    doc_id. Items beyond ``item_bytes`` of text are answered in several passes.
    Empty tables give no rows; other columns are not read.
    """
    size = items.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    parts = max(1, -(-size // params.item_bytes))
    passes = [items.where(F.pmod(F.xxhash64(F.col("item_id").cast("bigint")), F.lit(parts)) == i) for i in range(parts)]
    found = [x for x in (_one_pass(docs, item_terms(p), params) for p in passes) if x is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= params.k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item; see :func:`search`."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
