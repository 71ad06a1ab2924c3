"""Quality rules, line first: lines that fail a rule go, then documents that
lose too much text are rejected. DataFrame functions only, no shuffle: every
count is made inside the row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm.common import WORD_GAP, bound, table, unused

SYMBOLS = "#*$%&|<>"
_GAP_ONLY = r"^[\x20\x09-\x0D]*$"


@dataclass(frozen=True)
class LineRules:
    # a line fails if it does not end like a sentence, in any of the larger scripts
    ending: str = r"[.!?…:;\"')\]”’»。．！？；：」』）】।॥؟۔։።][\x20\x09-\x0D]*$"
    # characters of a line for which the counts of separators and shouts hold;
    # a line twice as long may have twice as many
    per_chars: int = 300
    # if it has so many separators of a navigation bar
    separators: str = "|»›•·"
    max_separators: int = 1
    # if it names things that only page furniture names, and is short enough for that
    max_boilerplate_chars: int = 600
    boilerplate: str = (
        r"(?i)\b(?:cookies?|privacy policy|terms of (?:use|service)|all rights reserved|javascript|lorem ipsum"
        r"|sign in|log in|subscribe|newsletter|licensed under|released under|copyright)\b")
    # if so many of its characters, in percent, are symbols
    max_symbols: int = 10
    # if it shouts: so many doubled exclamation marks, or letters in capitals, in percent
    max_shouts: int = 2
    max_capitals: int = 60
    # if a word comes so many times in a row
    repeated: str = r"(?:^|\x20)(\S+)(?:\x20\1){3,}(?=\x20|$)"
    # a document fails that keeps less than this percentage of its words' characters
    min_kept: int = 50
    min_words: int = 20
    max_repeated: int = 30  # percent of words in repeated windows
    window: int = 8


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(_without(text, characters))


def line_fails(line: Column, rules: LineRules = LineRules()) -> Column:
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    times = F.greatest(F.ceil(F.length(line) / rules.per_chars), F.lit(1))
    return (
        ~F.rlike(line, F.lit(rules.ending))
        | (_count_of(line, rules.separators) > rules.max_separators * times)
        | (100 * _count_of(line, SYMBOLS) > rules.max_symbols * F.length(line))
        | (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("!"))) > rules.max_shouts * times)
        | ((letters >= 20) & (100 * capitals > rules.max_capitals * letters))
        | F.rlike(line, F.lit(rules.repeated))
        | ((F.length(line) <= rules.max_boilerplate_chars) & F.rlike(line, F.lit(rules.boilerplate)))
    )


def _repeated_words(hashes: Column, size: int) -> Column:
    """Words covered by windows of ``size`` words that occur twice or more,
    given the hashes of all words."""
    n = F.size(hashes)

    def windows(words: Column) -> Column:
        return F.transform(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0))),
            lambda _, i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]),
        )

    def covered(found: Column) -> Column:
        # equal windows are neighbours when sorted; then count what they cover
        in_order = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = bound(in_order, lambda s: F.transform(s, lambda x, k: F.when(
            (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            F.sort_array(F.filter(places, lambda p: p.isNotNull())), start,
            lambda done, p: F.struct(
                (done["n"] + p + size - F.greatest(p, done["end"])).alias("n"), (p + size).alias("end")),
            lambda done: done["n"],
        )

    return F.when(n < size, F.lit(0)).otherwise(bound(windows(hashes), lambda found: F.when(
        F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(covered(found))))


def apply_rules(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with the counts of the base rules, ``base_failed``, the text of
    the lines kept (``clean_text``) and the verdict ``kept``.

    Null and empty texts have no words: they fail. Every row is judged by
    itself, so repeated rows get equal verdicts and no rows give none. Other
    columns pass unchanged; columns named like the results are replaced.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text",
               "kept"]
    docs = docs.drop(*results)
    lines, hashes, good = (unused(docs, c) for c in ("_lines", "_hashes", "_good"))
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    parts = docs.select(
        "*",
        F.transform(words, lambda w: F.xxhash64(w)).alias(hashes),
        F.filter(F.split(text, "\n"), lambda l: ~F.rlike(l, F.lit(_GAP_ONLY))).alias(lines),
        F.length(F.regexp_replace(text, WORD_GAP, "")).cast("bigint").alias("word_chars"),
        _count_of(text, SYMBOLS).cast("bigint").alias("n_symbols"),
    )
    counted = parts.select(
        *docs.columns, "word_chars", "n_symbols",
        F.size(hashes).cast("bigint").alias("n_words"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col(hashes), rules.window).cast("bigint").alias("n_repeat_words"),
        F.filter(lines, lambda l: ~line_fails(l, rules)).alias(good),
    )
    judged = counted.withColumn(
        "base_failed",
        (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeated * F.col("n_words")),
    ).withColumn("clean_text", F.array_join(good, "\n"))
    left = F.length(F.regexp_replace("clean_text", WORD_GAP, ""))
    return judged.withColumn(
        "kept", ~F.col("base_failed") & (100 * left >= rules.min_kept * F.col("word_chars"))
    ).select(*docs.columns, *results)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
