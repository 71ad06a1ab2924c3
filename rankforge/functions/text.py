"""Column functions on text: trimming, tokens, embedding text, prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.config import KEYWORD_MAX_CHARS

# Every character Python's ``str.strip`` removes; plain ``trim`` removes only
# the space.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_TOKEN = r"[\p{L}\p{N}_]+"
# What a decimal number looks like once currency signs and commas are gone.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(c: Column) -> Column:
    """Remove white space of every kind, newlines included, from both ends."""
    return F.trim(c, F.lit(_BLANKS))


def blank_to_null(c: Column) -> Column:
    s = strip(c)
    return F.when(s != "", s)


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores, in text order.

    Identifiers such as ``cache_lines`` or ``BPACT08WT`` stay whole; nothing is
    stemmed. Null text gives an empty array.
    """
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(_TOKEN), F.lit(0))


def bigrams(toks: Column) -> Column:
    """Distinct pairs of adjacent tokens, joined by one space."""
    n = F.size(toks)
    pairs = F.zip_with(
        F.slice(toks, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(toks, F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(F.when(n > 1, pairs).otherwise(F.array().cast("array<string>")))


def embedding_text(title: Column, features: Column, text: Column) -> Column:
    """Title, then features, then body; blank parts leave no separator."""
    return F.concat_ws("\n\n", *(blank_to_null(c) for c in (title, features, text)))


def join_items(items: Column) -> Column:
    """Trim the items of a string array, drop the blank ones, join by a space."""
    kept = F.filter(F.transform(items, strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_join(kept, " "), F.lit(""))


def parse_price(c: Column) -> Column:
    """A price given as ``13.99``, ``$13.99`` or ``1,299.50``; null for junk."""
    s = strip(F.replace(F.ltrim(strip(c.cast("string")), F.lit("$")), F.lit(","), F.lit("")))
    value = F.when(F.regexp_like(s, F.lit(_NUMBER)), s.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def keyword(c: Column, max_chars: int = KEYWORD_MAX_CHARS) -> Column:
    """The exact-match form of a text; longer values are not matchable."""
    return F.when(F.length(c) <= max_chars, c)
