"""Sum-of-squares online packing of tokenised documents into windows.

Every task packs the documents of its partition as they come. Whole windows of a
long document stand alone; the rest of it goes, uncut, into the open window whose
fill level keeps the sum of squared level counts smallest (Csirik, Johnson,
Kenyon, Orlin, Shor, Weber 2006). At the end of the partition the pieces of the
emptiest open windows are cut to fill the fullest ones, so that a task leaves one
padded window at most.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import blocks, dictionary_of, table, text_array

_NEAR_SPACE = re.compile(r" \s|\s ")
# a word without a space longer than this goes to the tokenizer whose merges do
# not slow down with its length
_LONG = 2000


@dataclass(frozen=True)
class PackingParams:
    window: int = 1024
    end_id: int = 0
    vocabulary: str = "byte_bpe_50k"  # name of a public byte-level vocabulary


class Encoder:
    """Byte-level subword ids of many texts at a time.

    Spaces between two other characters always part tokens, so the text between
    them is encoded once for every distinct word of a block. Texts in which a
    space touches other white space are encoded whole. Strings of special
    tokens in a text are ordinary text.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tiktoken.registry import ENCODINGS

        # the library's own registry keeps the vocabulary for a worker's next tasks
        if name not in ENCODINGS:
            with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            ENCODINGS[name] = tiktoken.Encoding(
                name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._fast, self._name, self._whole = ENCODINGS[name], name, None
        ids = range(self._fast.max_token_value + 1)
        self._bytes = np.fromiter((len(self._fast.decode_single_token_bytes(i)) for i in ids), np.int64, len(ids))

    def encode(self, text: str) -> list[int]:
        if len(text) > _LONG and max(map(len, text.split())) > _LONG:
            if self._whole is None:
                import public_tokenizers
                from tokenizers import Tokenizer

                self._whole = Tokenizer.from_file(public_tokenizers.path(f"{self._name}.json"))
                self._whole.encode_special_tokens = True
            return self._whole.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " " + word for all words, and where each word's ids start."""
        long = {i for i, w in enumerate(words) if len(w) > _LONG}
        short = [w for i, w in enumerate(words) if i not in long]
        ids = np.array(self._fast.encode_ordinary("".join(" " + w for w in short)), np.uint32)
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in short), np.int64, len(short)))
        counts = np.diff(np.searchsorted(np.cumsum(self._bytes[ids]), ends, "left") + 1, prepend=0)
        if not long:
            return ids, np.concatenate(([0], np.cumsum(counts)))
        short_parts = iter(np.split(ids, np.cumsum(counts)[:-1]) if short else [])
        parts = [np.array(self.encode(" " + w), np.uint32) if i in long else next(short_parts)
                 for i, w in enumerate(words)]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def encode_block(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, each text's followed by ``end_id``, and
        where each text starts, with the end."""
        plain = texts.to_pylist()
        whole = np.array([bool(_NEAR_SPACE.search(t)) for t in plain], bool)
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        starts, codes, words = dictionary_of(split)
        ids, bounds = self.encode_words([w if not _NEAR_SPACE.search(w) else "" for w in words])
        # the first word of a text has no space before it: ids of its own
        own = [np.array(self.encode(t if w else t[: t.find(" ")] if " " in t else t), np.uint32)
               for t, w in zip(plain, whole)]
        n = len(words)
        every = np.concatenate([ids, np.array([end_id], np.uint32), *own])
        length = np.concatenate([np.diff(bounds), [1], [len(x) for x in own]]).astype(np.int64)
        begin = np.cumsum(length) - length
        codes = codes.copy()
        codes[starts[:-1]] = n + 1 + np.arange(len(plain))
        codes = np.insert(codes, starts[1:], n)
        counts = length[codes]
        out = np.cumsum(counts)
        places = np.arange(out[-1]) + np.repeat(begin[codes] - (out - counts), counts)
        text_ends = starts[1:] + np.arange(1, len(plain) + 1)
        return every[places], np.concatenate(([0], out[text_ends - 1]))


class Packer:
    """Open windows by fill level. ``closed`` receives (sequence, pieces);
    a piece is (document, start in it, ids)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        # what a window adds at its new level, and takes away at its old one;
        # an empty window and a full one are no levels: they count one half each
        self.arrive = np.zeros(window + 1)
        self.leave = np.full(window + 1, -np.inf)
        self.arrive[window], self.leave[0] = -0.5, 0.5
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def level(self, size: int) -> int:
        """The fill level that keeps the sum of squares smallest, the fuller of
        two as good; 0: a new window."""
        cost = self.arrive[size:] - self.leave[: self.window + 1 - size]
        return len(cost) - 1 - int(cost[::-1].argmin())

    def place(self, piece: tuple) -> list | None:
        """The pieces of the window it filled up, if it did."""
        size = len(piece[2])
        at = self.level(size)
        if at:
            pieces = self.open[at].pop()
            self._count(at)
        else:
            pieces = []
        pieces.append(piece)
        if at + size == self.window:
            return pieces
        self.open[at + size].append(pieces)
        self._count(at + size)
        return None

    def _count(self, level: int) -> None:
        n = len(self.open[level])
        self.arrive[level] = n
        self.leave[level] = n if n else -np.inf

    def next_sequence(self) -> int:
        self.sequence += 1
        return self.sequence - 1

    def rest(self) -> Iterator[list]:
        """The open windows, filled up from the emptiest by cutting pieces."""
        left = [w for level in reversed(self.open) for w in level]
        low, high = 0, len(left) - 1
        while low < high:
            gap = self.window - sum(len(p[2]) for p in left[low])
            while gap and low < high:
                document, start, ids = left[high].pop()
                left[low].append((document, start, ids[:gap]))
                if len(ids) > gap:
                    left[high].append((document, start + gap, ids[gap:]))
                gap -= min(gap, len(ids))
                if not left[high]:
                    high -= 1
            if not gap:
                low += 1
        yield from (w for w in left[: high + 1] if w)


SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_documents(docs: DataFrame, params: PackingParams = PackingParams()) -> DataFrame:
    """Pieces of all documents: their ids (little-endian unsigned 32 bit), where
    they lie in the document and in which sequence at which offset.

    A null or empty text is a document of the end id alone. A repeated row is a
    document of its own; a null doc_id stays null. Sequence ids are unique
    numbers: the partition's number in the upper bits. No rows give no rows.
    Other columns are not read, whatever their names.
    """
    settings = (params.window, params.end_id, params.vocabulary)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, end_id, vocabulary = settings
        encoder = Encoder(vocabulary)
        packer = Packer(window, TaskContext.get().partitionId() << 32)
        out: list[tuple] = []

        def close(pieces: list) -> None:
            sequence, offset = packer.next_sequence(), 0
            for (doc_id, total), start, ids in pieces:
                out.append((doc_id, start, len(ids), ids.tobytes(), total, sequence, offset))
                offset += len(ids)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[] for _ in _ARROW]
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
            out.clear()
            return batch

        for block in blocks(batches, max_bytes=4 << 20):
            ids, starts = encoder.encode_block(text_array(block.column(1)), end_id)
            for doc_id, low, high in zip(block.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                total = high - low
                document, cut = (doc_id, total), total - total % window
                for start in range(0, cut, window):
                    close([(document, start, ids[low + start:low + start + window])])
                if cut < total:
                    # a copy: a view would keep the whole block's ids alive
                    filled = packer.place((document, cut, ids[low + cut:high].copy()))
                    if filled:
                        close(filled)
            yield flush()
        for pieces in packer.rest():
            close(pieces)
        yield flush()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(apply, SCHEMA)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )
