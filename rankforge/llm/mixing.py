"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates
between 0 and ``max_rate`` that give each source its target number of words, the
ones nearest to 1 in relative entropy are exponentially tilted:
rate = min(max_rate, exp(tilt of the source * size)). The tilts solve the convex
dual; its gradient and curvature are sums over documents, so every Newton step
is one aggregation. Rates depend on source and size alone, and the sums run over
the table of (source, size, documents), which Spark counts once.

Rates become whole copies by rounding running totals of copies, sizes in order;
what that leaves of a source's target is made up in further passes by changing
the copies of fitting documents. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.llm.common import WORD_GAP, table, unused
from rankforge.storage import materialize


# Rows of the plan (source and size) sent to every executor, some 100 bytes each.
MAX_BROADCAST_CELLS = 500_000


@dataclass(frozen=True)
class MixParams:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)  # of the sources in order, repeating
    share: float = 1.5  # words of the mix, as a multiple of all words
    max_rate: float = 2.0  # of a source, and copies of a document
    tolerance: float = 0.5  # words a source may be off before rounding
    max_steps: int = 60
    repairs: int = 4  # passes that correct what rounding leaves
    group: int = 100_000  # documents of one source and size that are ranked together, about


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")).cast("bigint")


def _placed(totals: DataFrame) -> DataFrame:
    """``totals`` with the ``place`` of each source, from 0, by code point, null
    last: its place in a range of sources and the sources in the ranges before."""
    order = F.col("source").asc_nulls_last()
    ranges = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ids that increase in a partition hold its number above bit 33
    sorted_ = materialize(totals.repartitionByRange(ranges, order).sortWithinPartitions(order).withColumn(
        "id", F.monotonically_increasing_id()), "ranges")
    sorted_ = sorted_.withColumn("range", F.shiftright("id", 33))
    # one row per range, whatever the number of sources
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = sorted_.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return sorted_.join(F.broadcast(first), "range").withColumn(
        "place", F.col("first") + F.col("id").bitwiseAND((1 << 33) - 1)).drop("range", "first", "id")


def source_targets(sizes: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``(source, source_size, target)`` from rows of (source, size, n): weights
    go round by code point, null last; targets stop at ``max_rate`` times the
    source's size and the excess is shared by weight, until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.col("place") % len(params.weights)
    weight = F.element_at(F.array(*map(F.lit, params.weights)), (place + 1).cast("int"))
    weighed = materialize(_placed(totals).select("source", "source_size", weight.alias("weight")), "sources")
    limit = params.max_rate * F.col("source_size")
    wanted = params.share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, before = None, -1
    while True:
        # sources whose share of the words still open would exceed their limit stop there
        full = F.lit(False) if level is None else F.col("weight") * level > limit
        row = weighed.agg(
            F.count_if(full), F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
        ).first()
        if row[0] == before or not row[2]:
            break
        before, level = row[0], (wanted - row[1]) / row[2]
    reached = limit if level is None else F.least(limit, F.col("weight") * level)
    return weighed.select("source", "source_size", reached.alias("target"))


def _exact_sum(value: Column) -> Column:
    """The sum at six decimals, the same in whatever order the rows come."""
    return F.sum(value.cast("decimal(38,6)")).cast("double")


def _tilted(cells: DataFrame, params: MixParams) -> DataFrame:
    """``cells`` with ``rate``. A source's tilt is kept in a bracket; a Newton
    step that leaves it becomes a bisection."""
    top = params.max_rate
    # sizes in units of the source's mean keep the tilts near 1
    scale = F.col("source_size") / F.greatest(F.col("documents"), F.lit(1))
    sources = cells.groupBy("number").agg(
        F.first("target").alias("target"), F.first("source_size").alias("source_size"), F.sum("n").alias("documents"))
    state = materialize(sources.select(
        "number", "target", F.greatest(scale, F.lit(1.0)).alias("scale"), F.lit(0.0).alias("tilt"),
        F.lit(-60.0).alias("low"), F.lit(60.0).alias("high"),
        # at its limit, a source needs no tilt; nor does an empty one
        (F.col("target") >= top * F.col("source_size")).alias("full"),
        (F.col("target") >= top * F.col("source_size")).alias("done"),
    ), "tilts")
    slim = cells.select("number", "size", "n")
    rate = F.least(F.lit(top), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))
    for _ in range(params.max_steps):
        words = F.col("n") * F.col("size") * rate
        sums = slim.join(state, "number").groupBy("number").agg(
            _exact_sum(words).alias("words"),
            _exact_sum(F.when(rate < top, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"),
        )
        off = F.col("words") - F.col("target")
        newton = F.col("tilt") - off / F.col("slope")
        low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        # over at most 4 units of tilt per step, inside the bracket
        moved = F.when((F.col("slope") > 0) & (newton > low) & (newton < high) & (F.abs(newton - F.col("tilt")) < 4.0),
                       newton).otherwise((low + high) / 2)
        done = F.col("done") | (F.abs(off) <= params.tolerance) | (high - low < 1e-12)
        state = materialize(state.join(sums, "number").select(
            "number", "target", "scale", F.when(done, F.col("tilt")).otherwise(moved).alias("tilt"),
            F.when(done, F.col("low")).otherwise(low).alias("low"),
            F.when(done, F.col("high")).otherwise(high).alias("high"), "full", done.alias("done"),
        ), "tilts")
        if state.where(~F.col("done")).isEmpty():
            break
    solved = state.select("number", "scale", "tilt", "full")
    return cells.join(solved, "number").withColumn(
        "rate", F.when(F.col("full"), F.lit(float(top))).otherwise(rate)).drop("scale", "tilt", "full")


def _rounded(cells: DataFrame, params: MixParams) -> DataFrame:
    """``cells`` with ``copies``, a whole number of copies for the cell."""
    order = Window.partitionBy("number").orderBy("size")
    running = F.sum(F.col("n") * F.col("rate")).over(order)
    before = running - F.col("n") * F.col("rate")
    # floor keeps each cell between 0 and its most, whatever the offset
    copies = F.floor(running + 0.5 + 1e-9) - F.floor(before + 0.5 + 1e-9)
    most = (F.col("n") * int(params.max_rate)).cast("bigint")
    current = cells.withColumn("most", most).withColumn("copies", F.least(copies, most).cast("bigint"))
    current = materialize(current, "copies")
    largest_first = Window.partitionBy("number").orderBy(F.col("size").desc())
    for _ in range(params.repairs):
        off = current.groupBy("number").agg(
            F.round(F.first("target") - F.sum(F.col("copies") * F.col("size"))).cast("bigint").alias("off"))
        joined = current.join(off, "number")
        # copies that can be added, or taken away
        free = F.when(F.col("off") > 0, F.col("most") - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("off"))
        free = F.when(fits, free).otherwise(0)
        upto = F.sum(free * F.col("size")).over(largest_first.rowsBetween(Window.unboundedPreceding, -1))
        left = F.greatest(F.abs("off") - F.coalesce(upto, F.lit(0)), F.lit(0))
        change = F.least(free, F.floor(left / F.greatest(F.col("size"), F.lit(1))))
        current = materialize(joined.select(
            *[c for c in current.columns if c != "copies"],
            (F.col("copies") + F.signum("off").cast("bigint") * change).cast("bigint").alias("copies")), "copies")
    return current.drop("most")


def _number(source: Column) -> Column:
    """A number for each source, null included, that joins can compare."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null")))


def _hash(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("string"), text)


def plan(rows: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """What each (number of the source, size) takes, from one row per document
    (source, number, size, hash): ``each`` copies of every document, and one
    more of those whose hash is not above the limit of their part in ``limits``
    (null: none), part = hash mod number of parts."""
    sizes = materialize(rows.groupBy("source", "number", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    targets = source_targets(sizes, params).withColumn("number", _number(F.col("source"))).drop("source")
    cells = materialize(_tilted(sizes.join(targets, "number"), params), "rates")
    cells = _rounded(cells, params).select(
        "number", "size", "n", "source_size", "target", "rate",
        F.floor(F.col("copies") / F.col("n")).cast("bigint").alias("each"),
        (F.col("copies") % F.col("n")).alias("extra"), F.ceil(F.col("n") / params.group).alias("parts"))
    key = ["number", "size", "part"]
    split = cells.where("extra > 0").select("number", "size", "n", "extra", "parts")
    placed = rows.join(split, ["number", "size"]).withColumn("part", F.pmod("hash", "parts"))
    # a cell's extra copies are dealt to its parts by running totals
    counted = placed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("extra").alias("extra"))
    upto = F.sum("m").over(Window.partitionBy("number", "size").orderBy("part"))
    share = F.floor(F.col("extra") * upto / F.col("n")) - F.floor(F.col("extra") * (upto - F.col("m")) / F.col("n"))
    dealt = counted.select(*key, share.alias("share"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("hash"))
    limits = (
        placed.select(*key, "hash", rank.alias("rank")).join(dealt, key).where("rank <= share")
        .groupBy(*key).agg(F.max("hash").alias("limit"))
        .groupBy("number", "size").agg(F.map_from_entries(F.collect_list(F.struct("part", "limit"))).alias("limits"))
    )
    limit = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), lambda i: F.col("limits")[i])
    return materialize(cells.join(limits, ["number", "size"], "left").select(
        "number", "size", "source_size", "target", "rate", "each", limit.alias("limits")), "plan")


def _copies(each: Column, limits: Column, hash_: Column) -> Column:
    limit = F.get(limits, F.pmod(hash_, F.size(limits)).cast("int"))
    return each + F.when(hash_ <= limit, 1).otherwise(0)


def _small(cells: DataFrame) -> DataFrame:
    """Broadcast up to a checked number of rows; beyond it, Spark joins them."""
    return F.broadcast(cells) if cells.count() <= MAX_BROADCAST_CELLS else cells


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        _number(F.col("source")).alias("number"), size_of(F.col("text")).alias("size"),
        _hash(F.col("doc_id"), F.col("text")).alias("hash"))


def mix(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies)`` per row.

    Which documents of one source and size get one copy more goes by the hash
    of id and text, so reruns agree and repeated rows get equal copies. Null
    sources are a source of their own, null texts have size 0. No rows give
    none. Other columns are not read.
    """
    rows = materialize(_rows(docs), "sizes")
    cells = _small(plan(rows, params))
    return rows.join(cells, ["number", "size"]).select(
        "doc_id", "source", "size", "source_size", "target", "rate",
        _copies(F.col("each"), F.col("limits"), F.col("hash")).alias("copies"))


def copied(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``docs`` as the mix takes them: every row as often as its copies say.
    Texts stay where they are, as long as the plan is small."""
    cells = plan(materialize(_rows(docs), "sizes"), params)
    number, size, each, limits = (unused(docs, c) for c in ("_mix_number", "_mix_size", "_mix_each", "_mix_limits"))
    cells = cells.select(F.col("number").alias(number), F.col("size").alias(size), F.col("each").alias(each),
                         F.col("limits").alias(limits))
    keyed = docs.withColumn(number, _number(F.col("source"))).withColumn(size, size_of(F.col("text")))
    copies = _copies(F.col(each), F.col(limits), _hash(F.col("doc_id"), F.col("text")))
    return keyed.join(_small(cells), [number, size]).select(
        *docs.columns, F.explode(F.array_repeat(F.lit(1), copies.cast("int"))).alias(each)).select(*docs.columns)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
        "rate", "copies",
    )
