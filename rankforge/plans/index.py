"""The searchable tables: built once, updated by segments, published by a manifest.

A segment is a folder that is written once and never changed:

docs         documents with their fields and vector, bucketed by ``doc_id``
postings     term counts, in the same buckets, sorted by term
vectors      vector, filter fields and cell, partitioned by cell

Searching, filtering and summing per document need no shuffle in a segment.
Beside the segments lie, for each version of the index:

gone         documents of a segment that a later one replaces
term_stats   documents per (field, term), field_stats documents and lengths per
             field, cells the bounds of every cell

The manifest has a row for each version and is written last: until then, and if a
job dies before, readers see the version before it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rankforge.config import FIELD_BOOSTS, MAX_BROADCAST_ROWS
from rankforge.operators import analysis
from rankforge.operators.encode import Encoder, HashingEncoder, attach_embeddings
from rankforge.operators.knn import CELL_STATS, CellBounds, assign_cells, cell_bounds, cell_stats, train_cells
from rankforge.sources.catalogue import latest
from rankforge.storage import materialize

# What a bucket holds: a task counts its terms, and scores its documents, in memory.
_TARGET_BUCKET_BYTES = 24 * 1024 * 1024
# How much larger than the raw text postings and vectors may be on disk.
_GROWTH = 2
_SEGMENT = "struct<name:string,docs:bigint,gone:bigint>"
_MANIFEST = ("version bigint, fingerprint string, buckets int, encoder string, dim int, fields array<string>, "
             f"centres array<array<double>>, segments array<{_SEGMENT}>, stats string")
# An update that leaves more segments, or a larger share of replaced or added
# documents, is followed by a compaction.
MAX_SEGMENTS = 8
COMPACT_SHARE = 0.5


@dataclass(frozen=True)
class Segment:
    """The live rows of one segment; both tables have the same buckets."""

    docs: DataFrame
    postings: DataFrame


@dataclass(frozen=True)
class Index:
    docs: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    vectors: DataFrame
    encoder: Encoder | None
    encoder_name: str
    centres: np.ndarray | None = None
    cells: CellBounds | None = None
    segments: tuple[Segment, ...] = ()
    version: int = 0
    buckets: int = 0  # 0: not stored in buckets

    def check_encoder(self, encoder: Encoder | None) -> Encoder:
        """The query encoder; it must be the one the documents went through."""
        chosen = encoder or self.encoder
        if chosen is None:
            raise ValueError(f"this index needs the encoder {self.encoder_name!r}")
        if chosen.name != self.encoder_name:
            raise ValueError(
                f"documents were encoded with {self.encoder_name!r}, not with {chosen.name!r}"
            )
        return chosen


def frames(docs: DataFrame, encoder: Encoder | None = None,
           fields: Sequence[str] = tuple(FIELD_BOOSTS)) -> Index:
    """The same tables as unwritten DataFrames, for one-off jobs."""
    encoder = encoder or HashingEncoder()
    post = analysis.postings(docs, fields)
    embedded = attach_embeddings(docs, encoder)
    return Index(docs, post, analysis.term_stats(post), analysis.field_stats(post), embedded,
                 encoder, encoder.name, segments=(Segment(docs, post),))


def default_buckets(docs: DataFrame, dim: int = 0) -> int:
    """Buckets of about 24 MB by the measured size of texts and vectors, at
    least one per core."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in docs.schema.fields
            if f.dataType.simpleString() == "string"]
    row = sum(text, F.lit(4 * dim + 8)).cast("bigint")
    size = docs.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size * _GROWTH // _TARGET_BUCKET_BYTES))


# Manifest ---------------------------------------------------------------------


def manifest(spark: SparkSession, path: str) -> Row | None:
    """The newest published version, or None."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
        return rows.orderBy(F.desc("version")).first()
    except AnalysisException:
        return None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete index is at ``path``."""
    return manifest(spark, path) is not None


def input_fingerprint(docs: DataFrame, *settings) -> str:
    """Count and sum of hashes of the rows, in any order, and the settings."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(docs.columns)]).cast("decimal(38,0)")
    n, total = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return f"{n}-{total}-{hashlib.md5(repr(settings).encode()).hexdigest()[:16]}"


def _publish(spark: SparkSession, path: str, version: int, fingerprint: str, buckets: int, encoder: Encoder,
             fields: Sequence[str], centres: np.ndarray | None, segments: list[tuple], stats: str) -> None:
    row = (version, fingerprint, buckets, encoder.name, encoder.dim, list(fields),
           None if centres is None else centres.tolist(), segments, stats)
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


# Segments ---------------------------------------------------------------------


def _table(folder: str, name: str) -> str:
    return f"rankforge_{hashlib.md5(folder.encode()).hexdigest()[:16]}_{name}"


_ORDER = {"docs": ("doc_id",), "postings": ("term", "field", "doc_id")}


def _open_table(spark: SparkSession, folder: str, name: str, buckets: int) -> DataFrame:
    """A bucketed table of a segment. Its folder never changes, so an entry of
    an earlier session cannot be out of date."""
    table = _table(folder, name)
    if not spark.catalog.tableExists(table):
        fields = spark.read.parquet(f"{folder}/{name}").schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (doc_id) "
                  f"SORTED BY ({', '.join(_ORDER[name])}) INTO {buckets} BUCKETS LOCATION '{folder}/{name}'")
    return spark.table(table)


def _write_segment(spark: SparkSession, path: str, n: int, embedded: DataFrame, fields: Sequence[str],
                   options: dict[str, str], postings: DataFrame | None = None) -> tuple[str, int]:
    """Write docs and postings of a new segment; its name and number of documents."""
    name = f"s-{uuid.uuid4().hex}"
    folder = f"{path}/{name}"

    def write_bucketed(df: DataFrame, table: str) -> DataFrame:
        (
            df.write.format("parquet").options(**options).bucketBy(n, "doc_id").sortBy(*_ORDER[table])
            .option("path", f"{folder}/{table}").saveAsTable(_table(folder, table))
        )
        return spark.table(_table(folder, table))

    # one task per bucket, so that a bucket is one sorted file
    docs = write_bucketed(embedded.repartition(n, "doc_id"), "docs")
    # counted inside the buckets, without a shuffle
    counts = docs.groupBy("doc_id").count()
    total, most = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.max("count")).first()
    if most and most > 1:
        twice = counts.where("count > 1").select("doc_id").first()
        raise ValueError(f"document id {twice[0]!r} comes more than once; keep one row of it first (see latest)")
    # the texts are in their buckets now: their terms are counted there
    write_bucketed(analysis.postings(docs, fields, 0) if postings is None else postings.repartition(n, "doc_id"),
                   "postings")
    return name, int(total)


def _write_vectors(docs: DataFrame, folder: str, n: int, fields: Sequence[str], centres: np.ndarray) -> None:
    plain = docs.drop(*[f for f in fields if f in docs.columns])
    # a hot cell is spread over several files by the second key
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n // len(centres))))
    cells = assign_cells(plain, centres).repartition(n, "cell", spread)
    cells.write.partitionBy("cell").parquet(f"{folder}/vectors")


def _totals(post: DataFrame) -> DataFrame:
    """Term and field counts that can be added up: ``(field, term, df, n_tokens)``,
    with a null term for the field as a whole."""
    per_field = analysis.doc_lengths(post).groupBy("field").agg(
        F.count(F.lit(1)).alias("df"), F.sum("dl").alias("n_tokens"))
    terms = analysis.term_stats(post).withColumn("n_tokens", F.lit(None).cast("bigint"))
    return terms.unionByName(per_field.withColumn("term", F.lit(None).cast("string")))


def _write_stats(path: str, totals: DataFrame) -> str:
    name = f"v-{uuid.uuid4().hex}"
    totals.where("term is not null").select("field", "term", "df").write.parquet(f"{path}/{name}/term_stats")
    totals.where("term is null").select(
        "field", F.col("df").alias("n_docs"), (F.col("n_tokens") / F.col("df")).alias("avgdl"), "n_tokens",
    ).coalesce(1).write.parquet(f"{path}/{name}/field_stats")
    return name


# Building, updating, opening --------------------------------------------------


def build_index(docs: DataFrame, path: str, *, id_col: str = "doc_id",
                fields: Sequence[str] = tuple(FIELD_BOOSTS), encoder: Encoder | None = None,
                buckets: int | None = None, n_cells: int | None = None,
                centres: np.ndarray | None = None, force: bool = False,
                fingerprint: str | None = None, options: dict[str, str] | None = None) -> Index:
    """Publish the searchable tables of ``docs`` under ``path`` and open them.

    Nothing is written, unless ``force``, if the index there was built from the
    same input with the same settings: the manifest holds a ``fingerprint`` of
    both, worked out in one pass over ``docs`` where none is given (the version
    of a table, say). Another input makes a new version; readers keep theirs.

    Cells need ``centres``, or ``n_cells`` to train them; without either the
    index answers exact vector search only. ``options`` go to the parquet writer.
    """
    spark = docs.sparkSession
    encoder = encoder or HashingEncoder()
    path = path.rstrip("/")
    docs = docs.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else docs
    before = manifest(spark, path)
    mark = fingerprint or input_fingerprint(
        docs, encoder.name, tuple(fields), buckets, n_cells, None if centres is None else centres.tolist())
    if before and before["fingerprint"] == mark and not force:
        return open_index(spark, path, encoder)
    n = buckets or default_buckets(docs, encoder.dim)
    return _build(spark, path, n, attach_embeddings(docs, encoder), encoder, fields, n_cells, centres, mark,
                  before["version"] + 1 if before else 1, options or {})


def _build(spark: SparkSession, path: str, n: int, embedded: DataFrame, encoder: Encoder, fields: Sequence[str],
           n_cells: int | None, centres: np.ndarray | None, mark: str, version: int, options: dict[str, str],
           postings: DataFrame | None = None) -> Index:
    """A version of one segment."""
    name, count = _write_segment(spark, path, n, embedded, fields, options, postings)
    folder = f"{path}/{name}"
    docs = _open_table(spark, folder, "docs", n)
    if centres is None and n_cells:
        centres = train_cells(docs, n_cells)
    stats = _write_stats(path, _totals(_open_table(spark, folder, "postings", n)))
    if centres is not None:
        _write_vectors(docs, folder, n, fields, centres)
        assigned = spark.read.parquet(f"{folder}/vectors")
        cell_stats(assigned, centres).coalesce(1).write.parquet(f"{path}/{stats}/cells")
    _publish(spark, path, version, mark, n, encoder, fields, centres, [(name, count, 0)], stats)
    return open_index(spark, path, encoder)


def update_index(spark: SparkSession, path: str, batch: DataFrame, *, encoder: Encoder | None = None,
                 order: str = "pos", options: dict[str, str] | None = None,
                 max_segments: int = MAX_SEGMENTS, compact_share: float = COMPACT_SHARE) -> Index:
    """Insert or replace the documents of ``batch`` and publish the result.
    Within the batch the highest ``order`` wins.

    Only the batch is analysed, encoded and written, as a new segment. The ids
    it replaces are marked as gone in theirs, whose files stay as they are, and
    the statistics change by what was added less what was replaced. Once there
    are many segments or much has changed, :func:`compact_index` follows.
    """
    encoder, path = encoder or HashingEncoder(), path.rstrip("/")
    old, live = manifest(spark, path), open_index(spark, path, encoder)
    n, fields, centres = old["buckets"], old["fields"], live.centres
    fresh = materialize(latest(batch, "doc_id", (order,)), "batch")
    if fresh.isEmpty():
        return live
    known = _open_table(spark, f"{path}/{old['segments'][0]['name']}", "docs", n).columns
    embedded = attach_embeddings(fresh, encoder).select(*[c for c in known if c in {*fresh.columns, "embedding"}])
    # no more buckets than the batch fills
    name, count = _write_segment(spark, path, n, embedded, fields, options or {})
    folder = f"{path}/{name}"
    added, ids = _open_table(spark, folder, "postings", n), fresh.select("doc_id")
    replaced, gone = [], _gone(spark, path, old)
    for segment, tables in zip(old["segments"], live.segments):
        replaced.append(tables.docs.join(ids, "doc_id", "left_semi").select(
            F.lit(segment["name"]).alias("segment"), "doc_id"))
    now_gone = materialize(reduce(DataFrame.unionByName, replaced), "replaced")
    lost = live.postings.join(now_gone.select("doc_id"), "doc_id", "left_semi")
    signed = (
        _stored_totals(spark, path, old).unionByName(_totals(added))
        .unionByName(_totals(lost).withColumns({"df": -F.col("df"), "n_tokens": -F.col("n_tokens")}))
    )
    totals = signed.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("n_tokens").alias("n_tokens"))
    stats = _write_stats(path, totals.where("df > 0"))
    now_gone.unionByName(gone).write.parquet(f"{path}/{stats}/gone")
    if centres is not None:
        _write_vectors(_open_table(spark, folder, "docs", n), folder, n, fields, centres)
        # bounds only widen until the next compaction
        both = spark.read.schema(CELL_STATS).parquet(f"{path}/{old['stats']}/cells").unionByName(
            cell_stats(spark.read.parquet(f"{folder}/vectors"), centres))
        both.groupBy("cell").agg(
            F.sum("n").alias("n"), F.max("angle").alias("angle"), F.min("shortest").alias("shortest"),
            F.max("longest").alias("longest"), F.max("zero").alias("zero"),
        ).coalesce(1).write.parquet(f"{path}/{stats}/cells")
    lately = {r["segment"]: r["n"] for r in now_gone.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments = [(s["name"], s["docs"], s["gone"] + lately.get(s["name"], 0)) for s in old["segments"]]
    segments.append((name, count, 0))
    _publish(spark, path, old["version"] + 1, old["fingerprint"], n, encoder, fields, centres, segments, stats)
    changed = sum(s[2] for s in segments) + sum(s[1] for s in segments[1:])
    if len(segments) > max_segments or changed > compact_share * sum(s[1] for s in segments):
        return compact_index(spark, path, encoder=encoder, options=options)
    return open_index(spark, path, encoder)


def compact_index(spark: SparkSession, path: str, *, encoder: Encoder | None = None,
                  options: dict[str, str] | None = None) -> Index:
    """A version of one segment that holds the live documents of all. Nothing is
    analysed or encoded again."""
    encoder, path = encoder or HashingEncoder(), path.rstrip("/")
    old, live = manifest(spark, path), open_index(spark, path, encoder)
    stored = reduce(DataFrame.unionByName, [
        _live(spark, path, old, s, _open_table(spark, f"{path}/{s['name']}", "docs", old["buckets"]))
        for s in old["segments"]])
    return _build(spark, path, old["buckets"], stored, encoder, old["fields"], None, live.centres, old["fingerprint"],
                  old["version"] + 1, options or {}, live.postings)


def _gone(spark: SparkSession, path: str, row: Row) -> DataFrame:
    """``(segment, doc_id)`` of the documents that a later segment replaces."""
    if any(s["gone"] for s in row["segments"]):
        return spark.read.parquet(f"{path}/{row['stats']}/gone")
    first = _open_table(spark, f"{path}/{row['segments'][0]['name']}", "docs", row["buckets"])
    return first.select(F.lit("").alias("segment"), "doc_id").limit(0)


def _live(spark: SparkSession, path: str, row: Row, segment: Row, table: DataFrame) -> DataFrame:
    """A segment's table without what is gone."""
    if not segment["gone"]:
        return table
    gone = _gone(spark, path, row).where(F.col("segment") == segment["name"]).select("doc_id")
    small = segment["gone"] <= MAX_BROADCAST_ROWS
    return table.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti")


def _stored_totals(spark: SparkSession, path: str, row: Row) -> DataFrame:
    folder = f"{path}/{row['stats']}"
    terms = spark.read.parquet(f"{folder}/term_stats").withColumn("n_tokens", F.lit(None).cast("bigint"))
    per_field = spark.read.parquet(f"{folder}/field_stats").select(
        "field", F.lit(None).cast("string").alias("term"), F.col("n_docs").alias("df"), "n_tokens")
    return terms.unionByName(per_field)


def open_index(spark: SparkSession, path: str, encoder: Encoder | None = None) -> Index:
    """Open the newest version under ``path`` (written in this or an earlier session)."""
    path = path.rstrip("/")
    row = manifest(spark, path)
    if row is None:
        raise ValueError(f"there is no index at {path!r}")
    n, folder = row["buckets"], f"{path}/{row['stats']}"
    centres = None if row["centres"] is None else np.array(row["centres"])
    segments, stored, vectors = [], [], []
    for s in row["segments"]:
        docs, post = (_live(spark, path, row, s, _open_table(spark, f"{path}/{s['name']}", t, n)) for t in _ORDER)
        segments.append(Segment(docs.drop("embedding"), post))
        stored.append(docs)
        if centres is not None:
            vectors.append(_live(spark, path, row, s, spark.read.parquet(f"{path}/{s['name']}/vectors")))
    cells = None
    if centres is not None:
        cells = cell_bounds(spark.read.schema(CELL_STATS).parquet(f"{folder}/cells"), centres)

    def all_of(tables: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, tables)

    index = Index(
        all_of([s.docs for s in segments]), all_of([s.postings for s in segments]),
        spark.read.parquet(f"{folder}/term_stats"), spark.read.parquet(f"{folder}/field_stats"),
        all_of(vectors or stored), encoder, row["encoder"], centres, cells, tuple(segments), row["version"], n,
    )
    if encoder is not None:
        index.check_encoder(encoder)
    return index
