"""Near duplicates by SimHash: exact comparison in tiles.

Fingerprints are computed where the documents lie. Equal fingerprints are one
node. A node's tile is the vector of the population counts of its fingerprint's
four 16-bit quarters; two fingerprints differ in at least as many bits as their
count vectors do, summed, so tile pairs that are further apart than the radius
are skipped. All other pairs are compared, block by block, with exclusive-or and
bit counts in numpy.

Work is dealt in blocks of bounded size, whatever the groups: a tile's nodes are
cut into blocks, each block meets the nodes of the tiles near it in chunks, and a
block reports a spanning forest of its links instead of all pairs. Components of
these links are found by Spark jobs (alternating large-star and small-star,
Kiveris et al. 2014).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import blocks, table, text_array, unused
from rankforge.storage import materialize

# Keys of 16 bytes sent to every executor; beyond it, Spark joins them.
MAX_BROADCAST_ROWS = 1_000_000
QUARTERS = 4
_BASE = 17  # population counts of 16 bits: 0 to 16


@dataclass(frozen=True)
class SimHashParams:
    radius: int = 2
    shingle: int = 3
    seed: int = 42
    block: int = 2048  # nodes of a tile compared by one group
    chunk: int = 32768  # nodes of near tiles that meet a block in one group


def fingerprint_of(words: list[str], shingle: int, seed: int) -> int:
    """Majority of the bits of all shingles' XXH64; without words 0."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    if len(words) < shingle:
        shingles = [" ".join(words)]
    else:
        shingles = map(" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxh64_intdigest(s, seed) for s in shingles], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.zeros(64, np.int64)
    whole = len(bits) - len(bits) % 255
    # sums of 255 rows fit in a byte
    ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """``(doc_id, text_hash, fingerprint)`` per row, as bigint; A-Z in lower case."""
    shingle, seed = params.shingle, params.seed

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            lists = pc.ascii_split_whitespace(pc.ascii_lower(text_array(batch.column(1))))
            found = np.fromiter((fingerprint_of([w for w in x if w], shingle, seed) for x in _rows(lists)),
                                np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found.view(np.int64))],
                names=["doc_id", "text_hash", "fingerprint"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64("text")).mapInArrow(
        apply, "doc_id bigint, text_hash bigint, fingerprint bigint")


def _rows(lists) -> Iterator[list[str]]:
    starts, words = lists.offsets.to_pylist(), lists.flatten()
    base = starts[0]
    for low, high in zip(starts, starts[1:]):
        yield words.slice(low - base, high - low).to_pylist()


def _counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the quarters, one row per fingerprint."""
    quarters = fps.astype("<u8").view("<u2").reshape(-1, QUARTERS)
    return np.bitwise_count(quarters).astype(np.int64)


def _near_vectors(radius: int) -> list[tuple[int, ...]]:
    return [v for v in itertools.product(range(-radius, radius + 1), repeat=QUARTERS)
            if sum(map(abs, v)) <= radius]


def tile_column(fingerprint) -> "F.Column":
    """The tile's number, the counts of the quarters as digits to base 17."""
    tile = F.lit(0)
    for q in range(QUARTERS):
        quarter = F.shiftrightunsigned(fingerprint, 16 * q).bitwiseAND(F.lit(0xFFFF))
        tile = tile + F.bit_count(quarter) * (_BASE ** q)
    return tile.cast("int")


def _plan(sizes: dict[int, int], params: SimHashParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tiles in order, the blocks of each, and the chunks that meet a block."""
    tiles = np.array(sorted(sizes), np.int64)
    size = np.array([sizes[t] for t in tiles.tolist()], np.int64)
    digits = np.stack([tiles // _BASE ** q % _BASE for q in range(QUARTERS)], axis=1)
    meets = size.copy()
    for vector in _near_vectors(params.radius):
        if any(vector):
            place, there = _find(tiles, digits + np.array(vector))
            meets += np.where(there & (tiles[place] > tiles), size[place], 0)
    return tiles, -(-size // params.block), np.maximum(1, -(-meets // params.chunk))


def _find(tiles: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    number = digits @ (_BASE ** np.arange(QUARTERS))
    place = np.minimum(np.searchsorted(tiles, number), len(tiles) - 1)
    return place, ((digits >= 0) & (digits < _BASE)).all(axis=1) & (tiles[place] == number)


def _deal(fps: np.ndarray, plan, radius: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows (tile, block, chunk, guest, fingerprint): a node is at home in its
    own block, once for every chunk, and a guest in the blocks before it. They
    come block by block, no more at a time than there are nodes, however many
    blocks a tile has."""
    tiles, n_blocks, n_chunks = plan
    own = _counts(fps)
    home, _ = _find(tiles, own)
    spread = ((fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
    block = spread % n_blocks[home]
    index = np.arange(len(fps))

    def rows(which, tile_place, in_block, in_chunk, guest):
        return tiles[tile_place], in_block, in_chunk, np.full(len(which), guest), fps[which]

    for chunk in range(int(n_chunks[home].max(initial=0))):
        which = index[n_chunks[home] > chunk]
        yield rows(which, home[which], block[which], np.full(len(which), chunk), 0)
    for vector in _near_vectors(radius):
        place, there = _find(tiles, own + np.array(vector))
        same = not any(vector)
        near = index[there & (same | (tiles[place] < tiles[home]))]
        for at in range(int(n_blocks[place[near]].max(initial=0))):
            which = near[(n_blocks[place[near]] > at) & ((block[near] > at) if same else True)]
            target = place[which]
            yield rows(which, target, np.full(len(which), at), spread[which] // 7919 % n_chunks[target], 1)


class _Links:
    """Links of one group: its home nodes against themselves and the guests."""

    def __init__(self, home: np.ndarray, radius: int, among: bool):
        self.home, self.radius = home, radius
        self.label = np.arange(len(home))
        self.out: list[tuple[np.ndarray, np.ndarray]] = []
        if among:
            for low in range(0, len(home), 512):
                self._join(home[low:low + 512])

    def _near(self, others: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.home[:, None] ^ others[None, :]) <= self.radius

    def _join(self, others: np.ndarray) -> np.ndarray:
        """Gives home nodes with a common neighbour the same label; returns for
        each of ``others`` a home node near it, or -1."""
        near = self._near(others)
        linked = near.any(axis=0)
        first = np.where(linked, near.argmax(axis=0), -1)
        if near.sum() > linked.sum():
            while True:
                low = np.where(near, self.label[:, None], len(self.home)).min(axis=0, initial=len(self.home))
                label = np.minimum(self.label, np.where(near, low[None, :], len(self.home)).min(axis=1))
                label = label[label]
                if (label == self.label).all():
                    break
                self.label = label
        return first

    def meet(self, guests: np.ndarray) -> None:
        for low in range(0, len(guests), 512):
            part = guests[low:low + 512]
            first = self._join(part)
            linked = first >= 0
            if linked.any():
                self.out.append((part[linked], self.home[first[linked]]))

    def edges(self) -> list[tuple[np.ndarray, np.ndarray]]:
        moved = np.flatnonzero(self.label != np.arange(len(self.home)))
        return [*self.out, (self.home[moved], self.home[self.label[moved]])]


def links(nodes: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """``(a, b)``: links within the radius between distinct ``fingerprint``
    values, as spanning forests of the groups compared."""
    spark = nodes.sparkSession
    # at most 17 ** 4 tiles, however many nodes there are
    sizes = {r["tile"]: r["n"] for r in nodes.groupBy(tile_column(F.col("fingerprint")).alias("tile"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "a bigint, b bigint")
    plan = spark.sparkContext.broadcast(_plan(sizes, params))
    radius = params.radius
    names = ["tile", "block", "chunk", "guest", "fingerprint"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(low, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                waiting, n = [], 0
                for part in itertools.chain(_deal(fps, plan.value, radius), [None]):
                    if part is not None:
                        waiting.append(part)
                        n += len(part[0])
                    # small parts travel together
                    if waiting and (part is None or n >= 16_384):
                        columns = [np.concatenate(c) for c in zip(*waiting)]
                        waiting, n = [], 0
                        yield pa.RecordBatch.from_arrays(
                            [*(pa.array(c.astype(np.int32)) for c in columns[:4]),
                             pa.array(columns[4].astype(np.uint64).view(np.int64))], names=names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(group):
            found = group.edges() if group else []
            a, b = ([np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.uint64)] * 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        key, homes, group = None, [], None
        for batch in batches:
            tile, block, chunk, guest = (batch.column(i).to_numpy() for i in range(4))
            fps = batch.column(4).to_numpy().view(np.uint64)
            change = (np.diff(tile) != 0) | (np.diff(block) != 0) | (np.diff(chunk) != 0) | (np.diff(guest) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(fps)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                own = (tile[low], block[low], chunk[low])
                if own != key:
                    if homes:  # a group without guests
                        group = _Links(np.concatenate(homes), radius, key[2] == 0)
                    if group:
                        yield edges(group)
                    key, homes, group = own, [], None
                if guest[low] == 0:
                    homes.append(fps[low:high])
                    continue
                if homes:
                    group = _Links(np.concatenate(homes), radius, key[2] == 0)
                    homes = []
                if group:
                    group.meet(fps[low:high])
        if homes:
            group = _Links(np.concatenate(homes), radius, key[2] == 0)
        if group:
            yield edges(group)

    dealt = nodes.select("fingerprint").mapInArrow(
        deal, "tile int, block int, chunk int, guest int, fingerprint bigint")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_groups = dealt.repartition(n, "tile", "block", "chunk").sortWithinPartitions(*names[:4])
    return sorted_groups.mapInArrow(compare, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links, root being the smallest
    node of its component (itself, for that one). Every step is written to the
    shared folder."""
    spark = edges.sparkSession
    current = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if current.isEmpty():
        return spark.createDataFrame([], "node bigint, root bigint")
    before = None
    while True:
        # large-star: every larger neighbour of u goes to the smallest one
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "links")
        # small-star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        current = materialize(small, "links")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def near_duplicates(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """``(doc_id, text_hash, fingerprint, root, component_id)`` for every row: a
    component is known by its smallest fingerprint, ``root``, and its id is its
    smallest doc_id.

    Null and empty texts have fingerprint 0 and are linked like any other;
    repeated rows appear as often as they come. A null doc_id is never a
    component's id, unless all of the component's are null. Other columns are
    not read.
    """
    rows = materialize(fingerprints(docs, params), "fingerprints")
    nodes = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "nodes")
    linked = components(links(nodes, params))
    rooted = materialize(
        nodes.join(linked, nodes["fingerprint"] == linked["node"], "left")
        .select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")), "rooted")
    # written, so that the join below stands alone and Spark can split a large component
    smallest = materialize(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    found = rooted.join(smallest, "root").select("fingerprint", "root", "component_id")
    return rows.join(found, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id")


def one_of_each(docs: DataFrame, params: SimHashParams = SimHashParams()) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (null before
    all), then the smallest hash of the text; of rows alike, one."""
    found = materialize(near_duplicates(docs, params).groupBy("root", "doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("rows")), "components")
    first = materialize(found.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")), "first")
    marked = found.join(first, "root").withColumn("stays", F.struct("doc_id", "text_hash").eqNullSafe(F.col("first")))
    gone = materialize(marked.where(~F.col("stays")).select("doc_id", "text_hash"), "gone")
    small = gone.count() <= MAX_BROADCAST_ROWS
    doc_id, text_hash = docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"])
    kept = docs.join(
        F.broadcast(gone) if small else gone,
        doc_id.eqNullSafe(gone["doc_id"]) & (text_hash == gone["text_hash"]), "left_anti")
    if marked.where(F.col("stays") & (F.col("rows") > 1)).isEmpty():
        return kept
    # rows with the same id and text: one of them
    mark = unused(docs, "_text_hash")
    return kept.withColumn(mark, F.xxhash64("text")).dropDuplicates(["doc_id", mark]).drop(mark)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
