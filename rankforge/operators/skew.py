"""Joins by keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than one in so many rows counts as hot; there are fewer than
# that many of them.
HOT_SHARE = 1024


def attach_by_key(rows: DataFrame, table: DataFrame, key: str, n: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` with ``columns`` of ``table``, which has one row for each
    ``key`` of ``rows`` and in ``n`` how many rows there are of it.

    Hot keys, by their share of all rows, are few enough to be broadcast, and
    their rows are then dealt at random; the others are shuffled by key. ``rows``
    is read once. Rows with a null key are left out.
    """
    is_hot = F.col(n) * HOT_SHARE > table.agg(F.coalesce(F.sum(n), F.lit(0))).scalar()
    hot = table.where(is_hot).select(
        key, F.lit(True).alias("_hot"), *(F.col(c).alias(f"_h_{c}") for c in columns))
    rest = table.where(~is_hot).select(
        F.col(key).alias("_key"), F.lit(0).cast("bigint").alias("_salt"), *(F.col(c).alias(f"_c_{c}") for c in columns))
    found = F.col("_hot").isNotNull()
    spread = F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(HOT_SHARE))
    marked = rows.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left").withColumns({
        # a null key meets nothing; the salt keeps those rows apart
        "_key": F.when(~found, F.col(key)), "_salt": F.when(found, spread).otherwise(F.lit(0)).cast("bigint"),
    })
    return marked.join(rest, ["_key", "_salt"], "left").select(
        *rows.columns, *(F.coalesce(f"_h_{c}", f"_c_{c}").alias(c) for c in columns))
