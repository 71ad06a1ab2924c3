"""Exact substring deduplication on a compacted, sparse de Bruijn graph of words.

Edges are k-mers of 50 consecutive words. Writing all of them would be many times
the text, so the graph holds the k-mers whose least 19-mer stands first or last in
them: that depends on a k-mer's own words alone, and of 32 consecutive k-mers at
least one is such an anchor. Four steps:

1. The least 19-mer of every k-mer, with the smallest and largest doc_id it is found
   in. A k-mer that two documents share has a 19-mer that two documents share; these
   set bits of a table of fixed size. Documents without such a k-mer are finished.
2. Repeated anchors are the edges. Where an anchor has one successor that has one
   predecessor, they belong to one path: first along the document each was first
   seen in, then path to path by pointer doubling in Spark joins.
3. Documents walk these paths. A stretch of anchors on one path, whose first copies
   stand at the same distances in one earlier document, is repeated from end to end.
4. What lies between such stretches (their edges, and passages too short for two
   anchors) is compared k-mer by k-mer, by the same join.

Keys are 96 bits of two independent hashes of the words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import blocks, code_points, mixed, table, text_array, word_hashes, words_of
from rankforge.storage import materialize

_B = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_KEY = ["key", "check"]


@dataclass(frozen=True)
class DedupParams:
    window: int = 50
    seed: int = 19  # words whose least hash a k-mer is known by
    filter_bits: int = 1 << 26  # of the table of repeated 19-mers: 8 MB
    hot_share: int = 4096  # a key with more than this part of all rows is joined by broadcast
    max_rounds: int = 64
    block_bytes: int = 2 << 20  # of text whose k-mers a task holds at a time


def rolling(hashes: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """A hash of every ``width`` consecutive values, by doubling."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, step, at = hashes, 1, 0
    # arrays of one value, since only those wrap around without a warning
    total, factor, power_of = np.zeros(n, np.uint64), np.ones(1, np.uint64), np.array([base])
    while True:
        if width & step:
            total = total + factor * power[at:at + n]
            factor, at = factor * power_of, at + step
        if 2 * step > width:
            return total
        power = power[:len(power) - step] + power_of * power[step:]
        step, power_of = 2 * step, power_of * power_of


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    least, step = values, 1
    while 2 * step <= width:
        least, step = np.minimum(least[:-step], least[step:]), 2 * step
    rest = width - step
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def _second_hashes(words: list[str]) -> np.ndarray:
    """A hash of each word independent of :func:`word_hashes`."""
    if not words:
        return np.zeros(0, np.uint64)
    points, starts = code_points(words)
    length = np.diff(starts)
    place = (np.repeat(starts[1:], length) - np.arange(len(points))).astype(np.uint64)
    return mixed(np.add.reduceat(mixed(points.astype(np.uint64) * _B[1] + place), starts[:-1]))


class Kmers:
    """The k-mers of a block of texts: ``row`` and ``pos`` of each, the least
    19-mer, and whether it is an anchor."""

    def __init__(self, texts: pa.Array, params: DedupParams):
        self.params = params
        self.starts, codes, words = words_of(texts)
        self.n = np.diff(self.starts)
        self._words, self._codes = words, codes
        self._first = word_hashes(words)[codes]
        small = mixed(rolling(self._first, params.seed, _B[0]))
        span = params.window - params.seed + 1
        if len(small) < span:
            self.at = np.zeros(0, np.int64)
            self.least = np.zeros(0, np.uint64)
            self.anchor = np.zeros(0, bool)
        else:
            least = sliding_min(small, span)
            row = np.repeat(np.arange(len(self.n)), self.n)[:len(least)]
            inside = np.arange(len(least)) + params.window <= self.starts[1:][row]
            self.at = np.flatnonzero(inside)
            self.least = least[self.at]
            self.anchor = (small[self.at] == self.least) | (small[self.at + span - 1] == self.least)
        self.row = np.searchsorted(self.starts, self.at, side="right") - 1
        self.pos = self.at - self.starts[self.row]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of every k-mer."""
        width = self.params.window
        second = _second_hashes(self._words)[self._codes]
        key = mixed(rolling(self._first, width, _B[0]))[self.at]
        check = mixed(rolling(second, width, _B[1]))[self.at]
        return key.view(np.int64), (check >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _slot(values: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(values) % np.uint64(bits)).astype(np.int64)


def repeated_filter(docs: DataFrame, params: DedupParams) -> np.ndarray:
    """A bit table, as bytes, of the least 19-mers that two doc_ids share. Its
    size is fixed; once it fills up, more unique k-mers are compared, no fewer
    repeated ones."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, max_bytes=params.block_bytes):
            kmers = Kmers(text_array(batch.column(1)), params)
            new = np.ones(len(kmers.at), bool)
            new[1:] = (kmers.least[1:] != kmers.least[:-1]) | (kmers.row[1:] != kmers.row[:-1])
            least, ids = kmers.least[new], batch.column(0).to_numpy()[kmers.row[new]]
            order = np.lexsort((ids, least))
            least, ids = least[order], ids[order]
            cut = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])) if len(least) else [])
            last = np.append(cut[1:], len(least)) - 1 if len(cut) else cut
            yield pa.RecordBatch.from_arrays(
                [pa.array(least[cut].view(np.int64)), pa.array(ids[cut]), pa.array(ids[last])],
                names=["seed", "low", "high"])

    bits = params.filter_bits
    pieces = 64
    size = bits // pieces

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy()
            for piece in np.unique(slot // size).tolist():
                bit = slot[slot // size == piece] - piece * size
                own.setdefault(piece, np.zeros(size, bool))[bit] = True
        for piece, bit in own.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece]), pa.array([np.packbits(bit).tobytes()])], names=["piece", "bits"])

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_slot(batch.column(0).to_numpy().view(np.uint64), bits))], names=["slot"])

    seeds = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(apply, "seed bigint, low bigint, high bigint")
    shared = seeds.groupBy("seed").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    # each piece of the table is filled by one task, from the distinct slots of its range
    placed = shared.select("seed").mapInArrow(slots, "slot bigint").distinct().repartition(
        pieces, F.floor(F.col("slot") / size))
    found = np.zeros(bits // 8, np.uint8)
    for r in placed.mapInArrow(tables, "piece bigint, bits binary").collect():
        own = np.frombuffer(r["bits"], np.uint8)
        found[r["piece"] * len(own):(r["piece"] + 1) * len(own)] |= own
    return found


def _may_repeat(kmers: Kmers, shared: np.ndarray) -> np.ndarray:
    slot = _slot(kmers.least, 8 * len(shared))
    return (shared[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def examined(docs: DataFrame, shared, params: DedupParams) -> DataFrame:
    """One row per document. Where no k-mer may repeat, ``kept_sha256`` is final
    and nothing else is kept; otherwise ``text`` and the anchors that may repeat,
    each with the anchors before and after it (null at the text's ends) and the
    ``step`` in words to the latter."""

    anchor = pa.struct([("key", pa.int64()), ("check", pa.int32()), ("pos", pa.int64()), ("before", pa.int64()),
                        ("after", pa.int64()), ("step", pa.int64())])
    names = ["row", "doc_id", "n_words", "kept_sha256", "text", "anchors"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, max_bytes=params.block_bytes):
            texts = text_array(batch.column(2))
            kmers = Kmers(texts, params)
            has_id = ~batch.column(1).is_null().to_numpy(zero_copy_only=False)
            may = _may_repeat(kmers, shared.value) & has_id[kmers.row]
            open_ = np.zeros(batch.num_rows, bool)
            open_[kmers.row[may]] = True
            # neighbours are taken before the filter, so that they mean the same in every document
            key, check = kmers.keys()
            a = np.flatnonzero(kmers.anchor)
            row, same = kmers.row[a], kmers.row[a][1:] == kmers.row[a][:-1]
            before, after, step = (np.zeros(len(a), np.int64) for _ in range(3))
            before[1:], after[:-1], step[:-1] = key[a][:-1], key[a][1:], np.diff(kmers.pos[a])
            no_before, no_after = np.append(True, ~same)[:len(a)], np.append(~same, True)[:len(a)]
            m = may[a]
            a, row = a[m], row[m]
            flat = pa.StructArray.from_arrays(
                [pa.array(key[a]), pa.array(check[a]), pa.array(kmers.pos[a]), pa.array(before[m], mask=no_before[m]),
                 pa.array(after[m], mask=no_after[m]), pa.array(step[m], mask=no_after[m])], fields=list(anchor))
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32()), flat)
            plain = [None if o else hashlib.sha256(b" ".join(t.as_buffer().to_pybytes().split())).hexdigest()
                     for o, t in zip(open_.tolist(), texts)]
            kept = pa.array([t.as_py() if o else None for o, t in zip(open_.tolist(), texts)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(kmers.n), pa.array(plain, pa.string()), kept, lists], names=names)

    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        apply, "row bigint, doc_id bigint, n_words bigint, kept_sha256 string, text string, "
               "anchors array<struct<key:bigint,check:int,pos:bigint,before:bigint,after:bigint,"
               "step:bigint>>")


def _meet(rows: DataFrame, edges: DataFrame, total: int, params: DedupParams) -> DataFrame:
    """Inner join of ``rows`` with the ``edges`` of their key. Keys with over a
    ``hot_share``-th of all rows are fewer than that many and are broadcast, so
    that the rows of a passage found everywhere stay where they are."""
    hot = F.col("n") * params.hot_share > total
    others = rows.join(F.broadcast(edges.where(hot).select(*_KEY)), _KEY, "left_anti")
    return rows.join(F.broadcast(edges.where(hot)), _KEY).unionByName(others.join(edges.where(~hot), _KEY))


def edges(anchors: DataFrame) -> DataFrame:
    """The repeated anchors: where each is found first (``doc``, ``row``,
    ``pos``), how often, and its neighbours where it has but one (null: none or
    several)."""
    def only(name: str):
        return F.when(F.min(name) == F.max(name), F.min(name)).alias(name)

    return anchors.groupBy(*_KEY).agg(
        F.min(F.struct("doc_id", "row", "pos")).alias("src"), F.max("doc_id").alias("_last"),
        F.count(F.lit(1)).alias("n"), only("before"), only("after"), only("step"),
    ).where(F.col("src.doc_id") < F.col("_last")).select(
        *_KEY, F.col("src.doc_id").alias("doc"), F.col("src.row").alias("row"), F.col("src.pos").alias("pos"), "n",
        "before", "after", "step")


def compacted(found: DataFrame, params: DedupParams = DedupParams()) -> DataFrame:
    """The edges with ``path`` and ``place``, their distance in words from the
    path's first edge. A path is nonbranching: each edge but the first is its
    predecessor's only successor, and the other way round. A ring without a
    first edge stays cut as the documents it was first seen in cut it."""
    n = found.count()
    # along the document where an edge was first seen, most links need no join
    order = Window.partitionBy("row").orderBy("pos")
    linked = (F.lag("after").over(order) == F.col("key")) & (F.lag("key").over(order) == F.col("before"))
    starts = F.when(F.coalesce(linked, F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    pieces = found.withColumn("_new", starts).withColumn("_piece", F.sum("_new").over(order))
    whole = Window.partitionBy("row", "_piece").orderBy("pos")
    pieces = materialize(pieces.withColumn("piece", F.first(F.struct(*_KEY)).over(whole)).withColumn(
        "place", F.col("pos") - F.first("pos").over(whole)).drop("_new", "_piece"), "pieces")
    heads = pieces.where("place = 0").select("piece", F.col("key").alias("_head"), F.col("before").alias("_before"))
    tails = pieces.select(F.col("piece").alias("parent"), F.col("key").alias("_before"), F.col("after").alias("_head"),
                          (F.col("place") + F.col("step")).alias("far"))
    # a piece goes on from the one that ends in its head's only predecessor
    jumps = materialize(heads.join(tails, ["_head", "_before"]).where("piece <> parent").dropDuplicates(["piece"]).select(
        "piece", "parent", "far"), "jumps")
    rounds = 0
    while rounds < params.max_rounds and 2 ** rounds <= max(n, 1):
        up = jumps.select(F.col("piece").alias("parent"), F.col("parent").alias("_up"), F.col("far").alias("_far"))
        met = jumps.join(up, "parent", "left")
        moved = materialize(met.select(
            "piece", F.coalesce("_up", "parent").alias("parent"),
            (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far"), F.col("_up").isNotNull().alias("moved")), "jumps")
        jumps = moved.drop("moved")
        rounds += 1
        if moved.where("moved").isEmpty():
            break
    # whoever still has a parent with a parent lies on a ring
    ring = jumps.join(jumps.select(F.col("piece").alias("parent")).distinct(), "parent", "left_semi").select("piece")
    jumps = jumps.join(ring, "piece", "left_anti")
    joined = pieces.join(jumps, "piece", "left")
    return joined.select(
        *found.columns, F.coalesce("parent", "piece").alias("path"),
        (F.col("place") + F.coalesce("far", F.lit(0))).alias("place"))


def spans(anchors: DataFrame, paths: DataFrame, total: int, params: DedupParams = DedupParams()) -> DataFrame:
    """``(row, doc_id, start, stop, source_row, source_doc, source_start)``: long
    repeated spans, as the first and last of their k-mers. Anchors of a document
    that lie on one path and whose first copy is at one distance in one document
    with a smaller id are the ends of a span; that document holds it whole."""
    walked = _meet(anchors.select("row", "doc_id", "pos", *_KEY), paths.select(
        *_KEY, "path", "place", "n", F.col("doc").alias("source_doc"), F.col("row").alias("source_row"),
        F.col("pos").alias("source_pos")), total, params).where("source_doc < doc_id")
    # where the document and its source stand on the path
    walked = walked.withColumn("_shift", F.struct(F.col("pos") - F.col("place"), F.col("source_pos") - F.col("place")))
    order = Window.partitionBy("row").orderBy("pos")
    # anchors further apart than a window do not cover what is between them
    goes_on = (
        F.lag("path").over(order).eqNullSafe(F.col("path")) & (F.lag("source_row").over(order) == F.col("source_row"))
        & (F.lag("_shift").over(order) == F.col("_shift")) & (F.col("pos") - F.lag("pos").over(order) <= params.window)
    )
    walked = walked.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), F.lit(0)).otherwise(F.lit(1)))
    walked = walked.withColumn("_span", F.sum("_new").over(order))
    return walked.groupBy("row", "doc_id", "_span").agg(
        F.min("pos").alias("start"), F.max("pos").alias("stop"), F.min("source_row").alias("source_row"),
        F.min("source_doc").alias("source_doc"), F.min("source_pos").alias("source_start")).drop("_span")


def _settled(pos: np.ndarray, row: np.ndarray, lists) -> np.ndarray:
    """Which k-mers lie in the (start, stop) spans of their row."""
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    low, high = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    starts = starts - starts[0]
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    wide = 1 + int(max(pos.max(initial=0), high.max(initial=0)))
    # spans of a row do not overlap: a k-mer is inside if the last span that starts before it reaches it
    order = np.lexsort((low, owner))
    begin, end = (owner * wide + low)[order], (owner * wide + high)[order]
    if not len(begin):
        return np.zeros(len(pos), bool)
    at = row * wide + pos
    before = np.searchsorted(begin, at, side="right") - 1
    return (before >= 0) & (at <= end[np.maximum(before, 0)])


def rest(texts: DataFrame, shared, params: DedupParams) -> DataFrame:
    """``(row, doc_id, pos, key, check)`` of the k-mers that may repeat and lie
    in no span."""
    names = ["row", "doc_id", "pos", *_KEY]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, max_bytes=params.block_bytes):
            kmers = Kmers(text_array(batch.column(2)), params)
            open_ = _may_repeat(kmers, shared.value) & ~_settled(kmers.pos, kmers.row, batch.column(3))
            key, check = kmers.keys()
            row = pa.array(kmers.row[open_])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(kmers.pos[open_]),
                 pa.array(key[open_]), pa.array(check[open_])], names=names)

    return texts.select("row", "doc_id", "text", "spans").mapInArrow(
        apply, "row bigint, doc_id bigint, pos bigint, key bigint, check int")


def _with_spans(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Every text with its row's (start, stop) spans, as an array in order."""
    lists = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    none = F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")
    return texts.join(lists, "row", "left").withColumn("spans", F.coalesce("spans", none))


def removed_spans(docs: DataFrame, params: DedupParams = DedupParams()) -> tuple[DataFrame, DataFrame]:
    """(documents as :func:`examined` leaves them, their repeated k-mers as
    ``(row, start, stop)``)."""
    spark = docs.sparkSession
    plain = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(repeated_filter(plain, params))
    seen = materialize(examined(plain, shared, params), "examined")
    anchors = seen.select("row", "doc_id", F.explode("anchors").alias("a")).select("row", "doc_id", "a.*")
    total = anchors.count()
    found = materialize(spans(anchors, compacted(edges(anchors), params), total, params), "spans")
    texts = seen.where("text is not null").select("row", "doc_id", "text")
    left = materialize(rest(_with_spans(texts, found), shared, params), "rest")
    first = materialize(left.groupBy(*_KEY).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("n"),
    ).where("first < _last").drop("_last"), "first")
    several = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    single = _meet(left, first, several, params).where("first < doc_id")
    order = Window.partitionBy("row").orderBy("pos")
    run = F.col("pos") - F.row_number().over(order)
    runs = single.select("row", "pos", run.alias("_run")).groupBy("row", "_run").agg(
        F.min("pos").alias("start"), F.max("pos").alias("stop"))
    return seen, found.select("row", "start", "stop").unionByName(runs.drop("_run"))


def dedup(docs: DataFrame, params: DedupParams = DedupParams()) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)`` of every row of
    ``docs``: its words without those in a window of 50 that also starts in a row
    with a smaller doc_id. ``kept`` is the remaining text, null where nothing was
    removed.

    Null and empty texts have no words, shorter ones no window. A row with a
    null doc_id loses nothing and makes no other lose; rows with equal doc_ids do
    not count as earlier than each other. Texts are whole, however long. An empty
    table gives no rows; other columns are not read.
    """
    seen, found = removed_spans(docs, params)
    width = params.window
    names = ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, max_bytes=params.block_bytes):
            removed, kept, hashed = [], [], []
            for n, text, own in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                words = np.array(text.as_buffer().to_pybytes().split() + [b""], object)[:-1]
                change = np.zeros(n + 1, np.int64)
                for s in own:
                    change[s["start"]] += 1
                    change[s["stop"] + width] -= 1
                gone = np.cumsum(change)[:n] > 0
                stays = b" ".join(words[~gone].tolist())
                removed.append(int(gone.sum()))
                kept.append(stays.decode("utf-8", "replace") if gone.any() else None)
                hashed.append(hashlib.sha256(stays).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(hashed, pa.string())], names=names)

    texts = seen.where("text is not null").select("row", "doc_id", "n_words", "text")
    changed = _with_spans(texts, found).select("doc_id", "n_words", "text", "spans").mapInArrow(
        apply, "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
    whole = seen.where("text is null").select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), F.lit(None).cast("string").alias("kept"),
        "kept_sha256")
    return whole.unionByName(changed)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that earlier ones hold; see :func:`dedup`."""
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
