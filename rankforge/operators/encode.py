"""Text to unit vectors.

An encoder is anything with a ``name``, a ``dim`` and an ``encode(df, text,
out)`` method. :class:`HashingEncoder` is the built-in stand-in for a neural
model; :class:`ArrowEncoder` runs a user's model in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.config import EMBED_DIM
from rankforge.functions.text import embedding_text, tokens


BLOCK_CODES = 1 << 20  # token codes summed up at a time


class Encoder(Protocol):
    name: str
    dim: int

    def encode(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame: ...


def _arrow_batches(df: DataFrame, source: str, out: str, make) -> DataFrame:
    """Replace column ``source`` by a vector column, batch by batch.

    ``make()`` is called once per task and returns a function from an Arrow
    array to a float matrix, so a model is loaded once, not once per batch.
    """
    kept = [c for c in df.columns if c not in (source, out)]
    schema = T.StructType(
        [df.schema[c] for c in kept] + [T.StructField(out, T.ArrayType(T.FloatType(), False))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_matrix = make()
        for batch in batches:
            m = np.ascontiguousarray(to_matrix(batch.column(source)), dtype=np.float32)
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]) if len(m) \
                else pa.array([], pa.list_(pa.float32(), 1))
            arrays = [batch.column(c) for c in kept] + [vectors.cast(pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, out])

    return df.select(*kept, source).mapInArrow(run, schema)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Scale every row to length one; zero rows stay zero."""
    n = np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


@dataclass(frozen=True)
class HashingEncoder:
    """Signed feature hashing (Weinberger et al. 2009) of all tokens.

    The bucket is the first seven hex digits of the token's md5 modulo ``dim``;
    the eighth digit gives the sign. Tokens are cut and hashed by built-in
    functions; numpy only adds the signs up. No shuffle. ``max_tokens`` gives it
    the window of a neural encoder; without it whole texts are hashed.
    """

    dim: int = EMBED_DIM
    max_tokens: int | None = None

    @property
    def name(self) -> str:
        return f"hashing-{self.dim}-{self.max_tokens or 'all'}"

    def hashed(self, text: Column) -> Column:
        """The first eight hex digits of every token's md5, as numbers."""
        found = tokens(text)
        return F.transform(
            F.slice(found, 1, self.max_tokens) if self.max_tokens else found,
            lambda t: F.conv(F.left(F.md5(t), F.lit(8)), 16, 10).cast("bigint"),
        )

    def encode(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        dim = self.dim

        def make():
            def to_matrix(lists: pa.ListArray) -> np.ndarray:
                codes, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                ends = ends - ends[0]
                sums = np.zeros((len(lists), dim))
                # so many whole rows at a time as have about a block of codes
                cuts = np.flatnonzero(np.diff(ends[:-1] // BLOCK_CODES)) + 1 if len(lists) else []
                for low, high in zip([0, *cuts], [*cuts, len(lists)]):
                    part = codes[ends[low]:ends[high]]
                    row = np.repeat(np.arange(high - low), np.diff(ends[low:high + 1]))
                    sign = np.where(part & 1, 1.0, -1.0)
                    sums[low:high] = np.bincount(
                        row * dim + (part >> 1), weights=sign, minlength=(high - low) * dim).reshape(-1, dim)
                return unit_rows(sums)

            return to_matrix

        # bucket and sign in four bytes
        code = F.transform(self.hashed(F.col(text)), lambda c: (
            F.shiftright(c, 4) % dim * 2 + (c.bitwiseAND(F.lit(15)) < 8).cast("int")).cast("int"))
        hashed = df.withColumn("_codes", code)
        return _arrow_batches(hashed.drop(text), "_codes", out, make)


@dataclass(frozen=True)
class ArrowEncoder:
    """A user's model: ``load()`` runs once per task and returns a function
    from a list of texts to a float matrix with ``dim`` columns."""

    name: str
    dim: int
    load: Callable[[], Callable[[list[str]], np.ndarray]]
    normalize: bool = True
    batch_size: int = 32

    def encode(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        load, normalize, dim, size = self.load, self.normalize, self.dim, self.batch_size

        def make():
            model = load()

            def to_matrix(texts: pa.Array) -> np.ndarray:
                values = texts.to_pylist()
                parts = [
                    np.asarray(model(values[i:i + size]), dtype=np.float64)
                    for i in range(0, len(values), size)
                ]
                m = np.concatenate(parts) if parts else np.zeros((0, dim))
                if m.shape[1:] != (dim,):
                    raise ValueError(f"encoder returned {m.shape[1:]} columns, expected {dim}")
                return unit_rows(m) if normalize else m

            return to_matrix

        return _arrow_batches(df, text, out, make)


def attach_embeddings(docs: DataFrame, encoder: Encoder, keep: Sequence[str] | None = None) -> DataFrame:
    """Every document with the vector of its embedding text. The columns to
    ``keep``, all by default, go through the encoder's tasks beside it."""
    text = embedding_text(F.col("title"), F.col("features"), F.col("text"))
    kept = docs.columns if keep is None else keep
    return encoder.encode(docs.select(*[F.col(f"`{c}`") for c in kept], text.alias("_embedding_text")), "_embedding_text")


def encode_queries(queries: DataFrame, encoder: Encoder) -> DataFrame:
    """``(query_id, embedding)`` by the same encoder as the documents'."""
    return encoder.encode(
        queries.select("query_id", F.coalesce("query", F.lit("")).alias("query")), "query"
    )
