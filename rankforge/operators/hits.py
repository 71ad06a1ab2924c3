"""Ranked ids to full hits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.config import MAX_BROADCAST_BYTES, MAX_PUSHED_IDS
from rankforge.storage import estimated_bytes, materialize

# Ranges of ids that a scan is asked for at most.
_RANGES = 128
# What a scan reads for one listed id, about: pages of the columns it needs.
PAGE_BYTES = 1 << 20


def worth_listing(docs: DataFrame, max_rows: int | None) -> bool:
    """Whether naming up to ``max_rows`` ids to a scan of ``docs`` can save any
    reading: only if the table is larger than what they make it read."""
    return max_rows is not None and max_rows <= MAX_PUSHED_IDS and estimated_bytes(docs) > max_rows * PAGE_BYTES


def _id_ranges(ids: list) -> Column | None:
    """A condition that holds for ``ids`` (ascending) and that parquet statistics
    can judge: their ranges, parted at the widest gaps. None for many texts."""
    if not isinstance(ids[0], int):
        return reduce(lambda a, b: a | b, [F.col("doc_id") == i for i in ids]) if len(ids) <= _RANGES else None
    gaps = sorted(range(1, len(ids)), key=lambda i: ids[i - 1] - ids[i])[:_RANGES - 1]
    cuts = [0, *sorted(gaps), len(ids)]
    ranges = [F.col("doc_id").between(ids[low], ids[high - 1]) for low, high in zip(cuts, cuts[1:])]
    return reduce(lambda a, b: a | b, ranges)


def only_listed(docs: DataFrame, ranked: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``docs``, cut to the ids of a shortlist before they are read.

    ``ranked`` is a written table of up to ``max_rows`` rows. Its ids, when that
    is :func:`worth_listing`, are named to the scan: buckets without any of them
    are left out, and in the others, which are sorted by id, the pages between
    their ranges.
    """
    if not worth_listing(docs, max_rows):
        return docs
    ids = sorted(r["doc_id"] for r in ranked.select("doc_id").distinct().collect() if r["doc_id"] is not None)
    if not ids:
        return docs.where(F.lit(False))
    listed, ranges = docs.where(F.col("doc_id").isin(ids)), _id_ranges(ids)
    return listed if ranges is None else listed.where(ranges)


def attach_documents(ranked: DataFrame, docs: DataFrame, *, fields: Sequence[str] | None = None,
                     max_rows: int | None = None) -> DataFrame:
    """The document's fields, without its vector, next to every ranked row.

    Documents are looked up once, after ranking. ``max_rows`` is an upper bound
    the caller knows for ``ranked`` (queries x k); under the broadcast bound the
    documents stay where they are. If few enough are ranked, these are written
    and only what :func:`only_listed` leaves of the documents is read.
    """
    shown = list(fields) if fields else [c for c in docs.columns if c not in ("doc_id", "embedding")]
    # some 64 bytes for each value of a ranked row
    small = max_rows is not None and max_rows * 64 * len(ranked.columns) <= MAX_BROADCAST_BYTES
    payload = docs.select("doc_id", *shown)
    if worth_listing(payload, max_rows):
        ranked = materialize(ranked, "shortlist")
        payload = only_listed(payload, ranked, max_rows)
    joined = payload.join(F.broadcast(ranked) if small else ranked, "doc_id")
    return joined.select(*ranked.columns, *shown)
