"""Bulk upserts that arrive as a stream.

Every micro-batch is appended to a log of document versions; the current corpus
is resolved when it is read. No state is kept in the stream, and nothing already
written is rewritten by a batch. Compaction writes what the log says up to a batch
into a folder of its own and, last, a row that names it; from then on older batches
are not read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankforge.sources.catalogue import latest


def append_versions(stream: DataFrame, path: str, checkpoint: str, order: str = "pos",
                    **trigger) -> StreamingQuery:
    """Append each micro-batch under its own number. A batch that is delivered
    again after a failure overwrites itself, so versions are written once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumnRenamed(order, "_pos").write.mode("overwrite").parquet(f"{path}/_batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


_COMPACTED = "upto bigint, folder string"


def _compacted(spark: SparkSession, path: str):
    """(last batch, folder) of the newest compaction, or None."""
    try:
        return spark.read.schema(_COMPACTED).parquet(f"{path}.compacted/manifest").orderBy(F.desc("upto")).first()
    except AnalysisException:
        return None


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions since the newest compaction, and what that left."""
    log = spark.read.parquet(path).withColumn("_batch", F.col("_batch").cast("bigint"))
    base = _compacted(spark, path)
    if base is None:
        return log
    stored = spark.read.parquet(f"{path}.compacted/{base['folder']}")
    return log.where(F.col("_batch") > base["upto"]).unionByName(stored.select(*log.columns))


def current(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """The newest version of every document: latest batch, then position."""
    return latest(_versions(spark, path), key, ("_batch", "_pos"))


def compact(spark: SparkSession, path: str, key: str = "id") -> int | None:
    """Write the newest version of every document in the log so far, for readers
    to start from; the number of the last batch in it. Batches that arrive
    meanwhile are not in it and stay in the log. Without new batches nothing is
    written. A job that dies before its end changes nothing for readers."""
    versions = _versions(spark, path)
    upto = versions.agg(F.max("_batch")).first()[0]
    base = _compacted(spark, path)
    if upto is None or (base is not None and base["upto"] >= upto):
        return upto
    folder = uuid.uuid4().hex
    # the order of a row's version stays with it
    kept = versions.where(F.col("_batch") <= upto).withColumns({"_b": F.col("_batch"), "_p": F.col("_pos")})
    newest = latest(kept, key, ("_batch", "_pos")).withColumnsRenamed({"_b": "_batch", "_p": "_pos"})
    newest.write.parquet(f"{path}.compacted/{folder}")
    spark.createDataFrame([(upto, folder)], _COMPACTED).write.mode("append").parquet(f"{path}.compacted/manifest")
    return upto
