"""Column expressions, samples and Arrow text helpers that several operators share."""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.storage import materialize

WORD_GAP = r"[\x20\x09-\x0D]+"  # everything between two words
MAX_BROADCAST_MARKS = 1_000_000  # ids and labels sent to all executors
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PRIME = np.uint64(1099511628211)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder_is(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` = ``remainder``; null ids count as
    such, so that nothing is learned from them."""
    crc = F.crc32(doc_id.cast("string").cast("binary")) % modulus
    return F.coalesce(crc == remainder, F.lit(True))


def share_of(key: Column) -> Column:
    """A reproducible number in [0, 1) for a key."""
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 31)) / float(1 << 31)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learnable: Column, per_class: int, max_doc_chars: int,
):
    """At most ``per_class`` whole labelled texts of each class, as pandas.

    The rows with the smallest hash of their id are taken, out of the labelled
    rows where ``learnable`` holds and whose text has at most ``max_doc_chars``
    characters; a document marked twice has the larger label, an id that comes
    twice its smallest text. At most 2 * per_class * max_doc_chars characters
    reach the driver.
    """
    marks = (
        labels.where(learnable & F.col(label).isin(0, 1)).groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    found = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    texts = texts.where(F.length("text") <= max_doc_chars)
    if not found:
        return texts.limit(0).withColumn("label", F.lit(0)).toPandas()
    share = share_of(F.col("doc_id"))
    # a share of each class that should do; where many texts are too long, a larger one
    limits = {value: min(1.0, 1.2 * per_class / n) for value, n in found.items()}
    while True:
        drawn = marks.where(reduce(or_, ((F.col("label") == v) & (share < limit) for v, limit in limits.items())))
        if sum(found[v] * limit for v, limit in limits.items()) <= MAX_BROADCAST_MARKS:
            drawn = F.broadcast(drawn)
        rows = materialize(texts.join(drawn, "doc_id").groupBy("doc_id", "label").agg(
            F.min(F.struct("text", "lang")).alias("row")).select("doc_id", "row.text", "row.lang", "label"), "sample")
        got = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [v for v, limit in limits.items() if limit < 1 and got.get(v, 0) < per_class]
        if not short:
            break
        limits.update({v: min(1.0, 8 * limits[v]) for v in short})
    sample = reduce(DataFrame.unionByName, (
        rows.where(F.col("label") == v).orderBy(share, "doc_id").limit(per_class) for v in sorted(found)))
    # in an order that does not depend on the partitions
    return sample.toPandas().sort_values("doc_id").reset_index(drop=True)


def text_array(column) -> pa.Array:
    """An Arrow column as one string array without nulls."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(array, "")


def dictionary_of(lists) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A list array as (first position of every list and the end, code of every
    element, distinct elements)."""
    encoded = lists.flatten().dictionary_encode()
    starts = lists.offsets.to_numpy().astype(np.int64)
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return starts - starts[0], codes, encoded.dictionary.to_pylist()


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of all texts: (first position of every text and the end, code of
    every word, distinct words). Only the six ASCII white space characters part
    words; the empty ones that splitting leaves at the ends of a text are dropped."""
    starts, codes, words = dictionary_of(pc.ascii_split_whitespace(texts))
    if "" not in words:
        return starts, codes, words
    empty = words.index("")
    keep = codes != empty
    before = np.concatenate(([0], np.cumsum(keep)))
    return before[starts], np.where(codes > empty, codes - 1, codes)[keep], words[:empty] + words[empty + 1:]


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after another, and where each word starts, with the end."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.concatenate(([0], np.cumsum(lengths)))


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of every (not empty) word, the same on every machine."""
    if not words:
        return np.zeros(0, np.uint64)
    points, starts = code_points(words)
    place = np.arange(len(points)) - np.repeat(starts[:-1], np.diff(starts))
    powers = np.cumprod(np.full(int(place.max()) + 1, _PRIME))
    return mixed(np.add.reduceat((points.astype(np.uint64) + np.uint64(1)) * powers[place], starts[:-1]))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MULTIPLIER
    return values ^ (values >> np.uint64(29))


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, empty ones included."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[starts[1:]] - total[starts[:-1]]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def blocks(batches, column: str = "text", max_bytes: int = 8 << 20):
    """Arrow batches cut into runs of whole rows of about ``max_bytes`` of text,
    so that working memory does not depend on how long a batch's texts are."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        block = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
