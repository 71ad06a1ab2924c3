"""Where intermediate tables live.

Results that several later stages read are written once as parquet, under the
shared folder the cluster names in ``spark.checkpoint.dir``. That cuts their
lineage, outlives lost executors and gives the optimizer their true size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Only a ``local`` session, whose executors
    are the driver itself, gets a temporary one when none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder all executors share before running this job"
        )
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="rankforge-")
        context.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a table's size: file sizes for a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Stored bytes of texts that one task takes apart; some twenty times as many of
# working memory.
PART_BYTES = 8 * 1024 * 1024


def parts_of(df: DataFrame) -> int:
    """Parts of about :data:`PART_BYTES` of a table, at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(df) // PART_BYTES))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a small table.

    A file with one row group is read by one task, however much work follows.
    A table with less than 128 MB for each core is redistributed by its key, in
    parts whose size does not grow with it; a larger one has enough row groups
    and stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) < cores * 128 * 1024 * 1024:
        return df.repartition(parts_of(df), key)
    return df


def prepared(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table of this application in the shared folder: built when it is not
    there yet, read when it is."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{name}"
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        build().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
