"""Merkle manifest of a table, with octopus multiproofs.

Every row is a leaf. The leaves of a source form a tree of runs of three, the
source roots form one more tree, and its root stands for the whole table. Leaves
are numbered by a range sort; a block is 3 ** 8 consecutive leaves of a source and
becomes one node of the tree above it, so a round of Spark shrinks the table
6561-fold. A leaf partition holds some blocks. It works out which node coordinates
all its paths need beyond its own leaves, each once, fetches those by one join,
derives the interior nodes its paths share, and expands the proof of each leaf
from them without further data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import table
from rankforge.storage import materialize

TOP = -1  # the tree over the source roots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree bigint, n bigint, level int, index bigint, digest string"
_PROOF = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


@dataclass(frozen=True)
class MerkleParams:
    arity: int = 3
    height: int = 8  # levels inside a block
    part_leaves: int = 19_683  # leaves of a leaf partition, but for the rest of its last block

    @property
    def block(self) -> int:
        return self.arity ** self.height


def digest(parts: Iterable[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf_of(values: dict[str, Column]) -> Column:
    """H over the fields: ``-`` for null, else the byte count, a colon, the value."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
             for c in (values[f].cast("string") for f in FIELDS)]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def parents(nodes: list[bytes], arity: int) -> list[bytes]:
    return [digest(nodes[i:i + arity]) for i in range(0, len(nodes), arity)]


def missing(known: list[int], n: int, level: int, arity: int) -> Iterator[tuple[int, int]]:
    """(level, index) of the nodes which the paths from ``known`` (ascending
    indices among the ``n`` nodes of ``level``) to the top need and cannot
    derive: the least set, each node once."""
    while n > 1:
        have, runs = set(known), sorted({i // arity for i in known})
        for run in runs:
            for i in range(run * arity, min(run * arity + arity, n)):
                if i not in have:
                    yield level, i
        known, n, level = runs, -(-n // arity), level + 1


def siblings(nodes, i: int, arity: int, n: int) -> tuple[list[bytes], list[bytes]]:
    """The others of the run of node ``i`` among ``n``, left and right of it."""
    low = i - i % arity
    return [nodes[j] for j in range(low, i)], [nodes[j] for j in range(i + 1, min(low + arity, n))]


def levels_of(leaves: list[bytes], n: int, params: MerkleParams) -> list[list[bytes]]:
    """The nodes of a block level by level. ``n`` is the size of its whole tree:
    a tree within one block ends at its root, others at the block's height."""
    levels = [leaves]
    while len(levels) <= params.height and (n > params.block or len(levels[-1]) > 1):
        levels.append(parents(levels[-1], params.arity))
    return levels


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df``, range-sorted and written, with ``number`` (from 0 in that order)
    and ``part``, the range it lies in."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ids that increase in a partition hold its number above bit 33
    placed = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    # one row for each range partition
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    first, rows = 0, []
    for r in sizes:
        rows.append((r["part"], first))
        first += r["n"]
    offsets = spark.createDataFrame(rows, "part bigint, _first bigint")
    return placed.join(F.broadcast(offsets), "part").withColumn("number", F.col("_first") + F.col("_at")).drop(
        "_first", "_at")


def placed_leaves(docs: DataFrame, params: MerkleParams = MerkleParams()) -> tuple[DataFrame, int]:
    """``(doc_id, leaf, tampered, tree, n, pos, home)`` of every row and the
    number of sources. ``home`` is its leaf partition. Rows of one source and id
    are in order of their leaf; null ids come first."""
    own = {f: docs[f] for f in FIELDS}
    odd = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 != 0
    changed = {**own, "text": F.replace(docs["text"].cast("string"), F.lit("\n"), F.lit(""))}
    leaves = materialize(docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), docs["source"].cast("string").alias("source"),
        leaf_of(own).alias("leaf"),
        # a null id has no checksum and is left alone
        F.when(odd | docs["doc_id"].isNull(), None).otherwise(leaf_of(changed)).alias("tampered")), "leaves")
    placed = numbered(leaves, "source", "doc_id", "leaf")
    # a large source has one of these rows in each range it reaches
    runs = placed.groupBy("part", "source").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("rows"))
    sources = runs.groupBy("source").agg(F.min("first").alias("start"), F.sum("rows").alias("n"))
    sources = numbered(sources, "start").select(
        F.col("source").alias("_source"), "start", "n", F.col("number").alias("tree"))
    runs = materialize(runs.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("part").alias("_part"), "_source", "start", "n", "tree"), "runs")
    found = placed.join(runs, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    pos = F.col("number") - F.col("start")
    home = F.floor((F.col("number") - pos % params.block) / params.part_leaves)
    return found.select("doc_id", "leaf", "tampered", "tree", "n", pos.alias("pos"), home.alias("home")), sources.count()


def _by_tree(leaves: dict) -> Iterator[tuple[int, int, int, list[int]]]:
    """(tree, n, first position, rows in order) of every block of a partition."""
    order = sorted(range(len(leaves["pos"])), key=lambda i: (leaves["tree"][i], leaves["pos"][i]))
    block: list[int] = []
    for i in order:
        if block and (leaves["tree"][i] != leaves["tree"][block[0]] or leaves["pos"][i] % leaves["block"] == 0):
            yield leaves["tree"][block[0]], leaves["n"][block[0]], leaves["pos"][block[0]], block
            block = []
        block.append(i)
    if block:
        yield leaves["tree"][block[0]], leaves["n"][block[0]], leaves["pos"][block[0]], block


def _columns(part: pa.Table, params: MerkleParams) -> dict:
    found = {c: part.column(c).to_pylist() for c in part.column_names}
    found["block"] = params.block
    return found


def summaries(leaves: DataFrame, n_sources: int, params: MerkleParams = MerkleParams()) -> DataFrame:
    """For every leaf partition (``home``): the top node of each of its blocks,
    and, with a null digest, the coordinates its multiproof lacks."""

    def apply(part: pa.Table) -> pa.Table:
        columns, rows, trees = _columns(part, params), [], {}
        home = columns["home"][0]
        for tree, n, pos, block in _by_tree(columns):
            levels = levels_of([columns["leaf"][i].encode() for i in block], n, params)
            level, index = len(levels) - 1, pos // params.block
            rows.append((home, tree, n, level, index, levels[-1][0].decode()))
            if n > params.block:
                trees.setdefault((tree, n), []).append(index)
            else:
                trees.setdefault((tree, n), [])
        for (tree, n), known in trees.items():
            if known:
                for level, i in missing(known, -(-n // params.block), params.height, params.arity):
                    rows.append((home, tree, n, level, i, None))
        for level, i in missing(sorted(t for t, _ in trees), n_sources, 0, params.arity):
            rows.append((home, TOP, n_sources, level, i, None))
        names = ["home", "tree", "n", "level", "index", "digest"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    slim = leaves.select("home", "tree", "n", "pos", "leaf")
    return slim.groupBy("home").applyInArrow(apply, "home bigint, " + _NODE)


def grown(nodes: DataFrame, params: MerkleParams = MerkleParams()) -> DataFrame:
    """``nodes`` and every node above them up to the roots of their trees. Nodes
    of a tree are of one level; a round climbs ``height`` levels at most."""
    arity, block = params.arity, params.block

    def apply(part: pa.Table) -> pa.Table:
        columns = {c: part.column(c).to_pylist() for c in part.column_names}
        tree, n, level = columns["tree"][0], columns["n"][0], columns["level"][0]
        order = sorted(range(len(columns["index"])), key=columns["index"].__getitem__)
        own, first = [columns["digest"][i].encode() for i in order], columns["index"][order[0]]
        whole = -(-n // arity ** level)
        rows = []
        for _ in range(params.height):
            if whole == 1:
                break
            own, first, level, whole = parents(own, arity), first // arity, level + 1, -(-whole // arity)
            rows += [(tree, n, level, first + i, d.decode()) for i, d in enumerate(own)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        names = ["tree", "n", "level", "index", "digest"]
        return pa.table([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=names)

    found = open_ = nodes
    whole = F.ceil(F.col("n") / F.pow(F.lit(float(arity)), F.col("level")))
    while not open_.where(whole > 1).isEmpty():
        made = materialize(
            open_.where(whole > 1).withColumn("_run", F.floor(F.col("index") / block))
            .groupBy("tree", "_run").applyInArrow(apply, _NODE), "nodes")
        found = found.unionByName(made)
        # the next round starts from the highest level of each tree
        highest = made.groupBy("tree").agg(F.max("level").alias("_most"))
        open_ = made.join(highest, "tree").where(F.col("level") == F.col("_most")).drop("_most")
    return found


def proofs(leaves: DataFrame, fetched: DataFrame, n_sources: int, params: MerkleParams = MerkleParams()) -> DataFrame:
    """Every leaf with its roots, its proof's hash and the root that its
    ``tampered`` form folds to. ``fetched`` holds the missing nodes of every
    ``home``; nothing else is read."""
    arity = params.arity

    def apply(part: pa.Table, extra: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if not part.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        columns, other = _columns(part, params), {c: extra.column(c).to_pylist() for c in extra.column_names}
        known: dict[tuple[int, int], dict[int, bytes]] = {}
        for tree, level, i, d in zip(other["tree"], other["level"], other["index"], other["digest"]):
            known.setdefault((tree, level), {})[i] = d.encode()

        def climb(tree: int, n: int, level: int, own: dict[int, bytes]) -> list[tuple[dict[int, bytes], int]]:
            """Nodes and size of each level from ``level`` to the top: the
            fetched ones and those that the partition's nodes share."""
            climbed = []
            while True:
                at = {**known.get((tree, level), {}), **own}
                climbed.append((at, n))
                if n == 1:
                    return climbed
                runs = sorted({i // arity for i in own})
                own = {r: digest(at[i] for i in range(r * arity, min(r * arity + arity, n))) for r in runs}
                n, level = -(-n // arity), level + 1

        def path(climbed, i: int):
            """(left, right) siblings on the way up."""
            steps = []
            for at, n in climbed[:-1]:
                steps.append(siblings(at, i, arity, n))
                i //= arity
            return steps

        blocks, tops = [], {}
        for tree, n, pos, rows in _by_tree(columns):
            levels = levels_of([columns["leaf"][i].encode() for i in rows], n, params)
            blocks.append((tree, n, pos, rows, levels))
            tops.setdefault((tree, n), {})[pos // params.block] = levels[-1][0]
        trees, subroots = {}, {}
        for (tree, n), own in tops.items():
            trees[tree] = climb(tree, -(-n // params.block), params.height, own) if n > params.block else None
            subroots[tree] = trees[tree][-1][0][0] if trees[tree] else own[0]
        above = climb(TOP, n_sources, 0, subroots)
        root = above[-1][0][0]
        for tree, n, pos, rows, levels in blocks:
            shared = path(trees[tree], pos // params.block) if trees[tree] else []
            shared = shared + path(above, tree)
            end = b"".join(b"".join(left + right) for left, right in shared)
            for j, i in enumerate(rows):
                steps, at = [], j
                for nodes in levels[:-1]:
                    steps.append(siblings(nodes, at, arity, len(nodes)))
                    at //= arity
                hashed = hashlib.sha256(b"".join(b"".join(left + right) for left, right in steps) + end).hexdigest()
                folded = (columns["tampered"][i] or columns["leaf"][i]).encode()
                for left, right in steps + shared:
                    folded = digest([*left, folded, *right])
                out.append((columns["doc_id"][i], columns["leaf"][i], subroots[tree].decode(), root.decode(), hashed,
                            folded.decode(), folded == root))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    names = [c.split()[0] for c in _PROOF.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return leaves.groupBy("home").cogroup(fetched.groupBy("home")).applyInArrow(apply, _PROOF)


def manifest(docs: DataFrame, params: MerkleParams = MerkleParams()) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of
    every row of ``docs``, which has the columns of ``documents``.

    Any field may be null; null ids come first in their source and are never
    tampered with. Empty and long texts are leaves like others. Rows of one
    source and id are ordered by their leaf; equal rows are leaves of their own.
    An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    leaves, n_sources = placed_leaves(docs, params)
    if not n_sources:
        return spark.createDataFrame([], _PROOF)
    leaves = materialize(leaves, "placed")
    found = materialize(summaries(leaves, n_sources, params), "summaries")
    tops = found.where("digest is not null").drop("home")
    nodes = grown(tops, params)
    whole = F.ceil(F.col("n") / F.pow(F.lit(float(params.arity)), F.col("level")))
    subroots = nodes.where(whole == 1).select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(n_sources).cast("bigint").alias("n"), F.lit(0).alias("level"),
        F.col("tree").alias("index"), "digest")
    known = nodes.unionByName(grown(subroots, params)).select("tree", "level", "index", "digest")
    fetched = found.where("digest is null").select("home", "tree", "level", "index").join(
        known, ["tree", "level", "index"])
    return proofs(leaves, fetched, n_sources, params)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest of ``documents``; see :func:`manifest`."""
    return manifest(table(spark, sf_dir, "documents"))
