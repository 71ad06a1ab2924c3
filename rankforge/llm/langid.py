"""Language identification by cross-parsing (Ziv and Merhav 1993).

A suffix automaton of sample text of each language tells how far a text matches
some stretch of it. The text is parsed greedily into phrases, each the longest
match from where the last one ended (one symbol if there is none). Phrases times
the logarithm of the sample's size, for each symbol of the text, estimate the
cross entropy; the language with the least wins.

All texts of a block step through the automaton together, one symbol at a time:
a step is a lookup in a table of states by symbols.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import blocks, remainder_is, share_of, table, text_array

_NO_LETTER = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"


@dataclass(frozen=True)
class LangParams:
    # the labelled sample: so many documents of a language, a passage of each
    passages: int = 80
    passage_chars: int = 300
    # texts are parsed in stretches of so many bytes, phrases go on across their ends
    stretch: int = 4096
    lanes: int = 2048  # stretches that step together


def normalised(text: str) -> str:
    """Letters in lower case, anything between them one space."""
    return _NO_LETTER.sub(" ", text.lower()).strip()


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings (Blumer et al. 1985)."""
    step: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in symbols:
        state = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = step[at][symbol]
            if length[at] + 1 == length[target]:
                link[state] = target
            else:
                clone = len(step)
                step.append(dict(step[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and step[at].get(symbol) == target:
                    step[at][symbol] = clone
                    at = link[at]
                link[target] = link[state] = clone
        last = state
    return step


def parse_table(passages: list[bytes]) -> dict:
    """The automaton of a language's passages as a table: entry (state, symbol)
    is twice the next state's row, plus 1 if a new phrase starts there. Row 0 is
    the state outside any phrase; symbol 0 is a byte the sample does not have."""
    seen = sorted(set(b"".join(passages)))
    code = np.zeros(256, np.uint8 if len(seen) < 255 else np.uint16)
    code[seen] = np.arange(1, len(seen) + 1)
    size = len(seen) + 1
    symbols: list[int] = []
    for passage in passages:
        symbols += [*code[np.frombuffer(passage, np.uint8)].tolist(), 0]  # 0 parts the passages
    step = suffix_automaton(symbols)
    fresh = np.ones(size, np.int64)
    for symbol, target in step[0].items():
        fresh[symbol] = 2 * target * size + 1
    fresh[0] = 1
    rows = np.tile(fresh, (len(step), 1))
    state = np.repeat(np.arange(len(step)), [len(s) for s in step])
    symbol = np.fromiter((c for s in step for c in s), np.int64, len(state))
    target = np.fromiter((t for s in step for t in s.values()), np.int64, len(state))
    inside = (symbol > 0) & (state > 0)
    rows[state[inside], symbol[inside]] = 2 * target[inside] * size
    return {"code": code, "table": rows.ravel().astype(np.int32), "size": len(symbols)}


def phrases(stretches: list[bytes], language: dict, lanes: int, owners: np.ndarray | None = None) -> np.ndarray:
    """Number of phrases that start in every (not empty) stretch. One with the
    owner of the stretch before it goes on from there; without ``owners`` each
    is a text of its own.

    All stretches are parsed as if they began a text. Where the one before
    leaves an open phrase, :func:`_carry` puts the count right."""
    found, leaving = np.zeros(len(stretches), np.int64), np.zeros(len(stretches), np.int64)
    lengths = np.array([len(s) for s in stretches], np.int64)
    order = np.argsort(-lengths, kind="stable")
    flat, code = language["table"], language["code"]
    for low in range(0, len(order), lanes):
        own = order[low:low + lanes]
        length = lengths[own]
        longest = int(length[0]) if len(own) else 0
        symbols = np.zeros((longest, len(own)), code.dtype)
        for lane, i in enumerate(own.tolist()):
            symbols[: length[lane], lane] = code[np.frombuffer(stretches[i], np.uint8)]
        # lanes are sorted by length: at step t the first active[t] are not over
        active = np.searchsorted(-length, -np.arange(longest), "left")
        state, count = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for t in range(longest):
            k = int(active[t])
            entry = flat.take(state[:k] + symbols[t, :k])
            count[:k] += entry & 1
            state[:k] = entry >> 1
        found[own], leaving[own] = count, state
    if owners is not None and len(owners) > len(np.unique(owners)):
        follows = np.diff(owners, prepend=-1) == 0
        _carry(code[np.frombuffer(b"".join(stretches), np.uint8)], np.cumsum(lengths), follows, flat, found, leaving)
    return found


def _carry(symbols: np.ndarray, ends: np.ndarray, follows: np.ndarray, flat: np.ndarray, found: np.ndarray,
           leaving: np.ndarray) -> None:
    """Parse the stretches that follow another from the state it leaves, beside
    the parse so far, until both are in one state: the rest is the same. A
    stretch where they never meet changes what the next one begins with."""
    begin = np.append(0, ends[:-1])
    entering = np.zeros(len(ends), np.int64)
    while True:
        lane = np.flatnonzero(follows & (np.append(0, leaving[:-1]) != entering))
        if not len(lane):
            return
        before, now, at = entering[lane], leaving[lane - 1], begin[lane]
        entering[lane] = now
        while len(lane):
            symbol = symbols.take(at)
            old, new = flat.take(before + symbol), flat.take(now + symbol)
            found[lane] += (new & 1) - (old & 1)
            before, now, at = old >> 1, new >> 1, at + 1
            over = at == ends[lane]
            leaving[lane[over]] = now[over]
            apart = (before != now) & ~over
            lane, before, now, at = lane[apart], before[apart], now[apart], at[apart]


def identify(texts: list[str], languages: dict[str, dict], params: LangParams) -> tuple[list[str], np.ndarray]:
    """Language of every text, and how far it leads: 1 - its entropy estimate
    over the next best one's (1 if there is one language only)."""
    plain = [normalised(t) for t in texts]
    encoded = [p.encode("utf-8", "surrogatepass") if any(map(str.isalpha, p)) else b"" for p in plain]
    stretches, owner = [], []
    for i, data in enumerate(encoded):
        for low in range(0, len(data), params.stretch):
            stretches.append(data[low:low + params.stretch])
            owner.append(i)
    owners = np.array(owner, np.int64)
    names = sorted(languages)
    entropy = np.zeros((len(names), len(texts)))
    for row, name in enumerate(names):
        count = np.bincount(owners, phrases(stretches, languages[name], params.lanes, owners), minlength=len(texts))
        entropy[row] = count * np.log2(languages[name]["size"] + 1)
    pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if names:
        best = entropy.argmin(axis=0)
        in_order = np.sort(entropy, axis=0)
        for i, data in enumerate(encoded):
            if data:
                pred[i] = names[best[i]]
                score[i] = 1 - in_order[0, i] / in_order[1, i] if len(names) > 1 else 1.0
    return pred, score


def fit(docs: DataFrame, params: LangParams = LangParams()) -> dict[str, dict]:
    """The parse table of each language, from at most ``passages`` passages of
    ``passage_chars`` characters, one out of the middle of a document each. The
    documents with the smallest hashes are taken."""
    known = docs.where(~remainder_is(F.col("doc_id"), 3, 1) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language
    share = share_of(F.col("doc_id"))
    wanted = F.lit(False)
    for row in counts:
        wanted |= (F.col("lang") == row["lang"]) & (share < min(1.0, 1.5 * params.passages / row["n"]))
    begin = F.floor(F.greatest(F.length("text") - params.passage_chars, F.lit(0)) / 2).cast("int") + 1
    rows = known.where(wanted).select(
        "lang", share.alias("share"), "doc_id", F.substring("text", begin, F.lit(params.passage_chars)).alias("passage")
    ).collect()
    languages = {}
    for row in counts:
        own = sorted((r["share"], r["doc_id"], r["passage"]) for r in rows if r["lang"] == row["lang"])
        plain = [normalised(p).encode() for _, _, p in own[: params.passages]]
        if any(plain):
            languages[row["lang"]] = parse_table([p for p in plain if p])
    return languages


def identify_documents(docs: DataFrame, languages: dict[str, dict], params: LangParams = LangParams()) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, read off the text alone.

    A null text and one without a letter are ``und`` with score 0, as all are
    when no language was learned; equal entropies go to the smaller language
    code. Rows are judged one by one, repeated rows alike; other columns pass
    unchanged, columns named like the two results are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(languages)
    kept = docs.drop("lang_pred", "score")
    schema = kept.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            text = text_array(batch.column(batch.schema.get_field_index("text")))
            pred, score = identify(text.to_pylist(), shared.value, params)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(apply, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_documents(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", remainder_is(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")
