"""Text scalars shared by the filters, dedup, summaries and categories.

A *token* is a maximal run of Unicode letters, digits and underscores of the
lower-cased text.  Whole texts are always processed, never prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token pattern (Java regex; RE2 reads it the same way).
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
BETWEEN_TOKENS = r"[^\p{L}\p{N}_]+"
# Fixed value: a sentence is a run of non-terminators plus its terminators.
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"
# Fixed value: a mention or hashtag token, not preceded by a word character,
# so e-mail addresses do not count.
TAG_PATTERN = r"(?:^|[^\p{L}\p{N}_])([@#])([\p{L}\p{N}_]+)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(text: Column | str) -> Column:
    """Word tokens of the whole text, in text order, with repeats."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 0)


def token_set(text: Column | str) -> Column:
    return F.array_distinct(tokens(text))


def as_line(toks: Column) -> Column:
    """Tokens as one string: half the size of their array in a shuffle."""
    return F.array_join(toks, " ")


def of_line(line: Column | str) -> Column:
    """The tokens of ``as_line``."""
    none = F.array().cast("array<string>")
    return F.when(_c(line) == "", none).otherwise(F.split(_c(line), " "))


def _between_replaced(text: Column | str) -> Column:
    """The tokens joined by single spaces: what is between them is replaced, so no
    array of tokens is built."""
    return F.trim(F.regexp_replace(F.lower(_c(text)), BETWEEN_TOKENS, " "))


def _or_raw(line: Column, text: Column | str) -> Column:
    return F.when(line != "", line).otherwise(_c(text))


def normalized(text: Column | str) -> Column:
    """Exact-copy key: tokens joined by single spaces; the raw text when the
    text has no token at all."""
    return _or_raw(_between_replaced(text), text)


def text_key(text: Column | str) -> Column:
    """Fixed-width 96-bit key of the normalized text (xxhash64 + murmur3), so
    shuffles carry 12 bytes instead of whole texts."""
    # one element, so that the text is normalized once for both hashes
    line = F.array(_between_replaced(text))
    return F.get(F.transform(line, lambda n: F.struct(F.xxhash64(_or_raw(n, text)).alias("h1"),
                                                      F.hash(_or_raw(n, text)).alias("h2"))), F.lit(0))


def sentences(text: Column | str) -> Column:
    """Sentences of the whole text in order (trimmed, empty ones dropped)."""
    raw = F.regexp_extract_all(_c(text), F.lit(SENTENCE_PATTERN), 0)
    return F.filter(F.transform(raw, lambda s: F.trim(s)), lambda s: s != "")


def tags_of(text: Column | str, sigil: str) -> Column:
    """Lower-cased mention (``@``) or hashtag (``#``) names of the text."""
    pattern = TAG_PATTERN.replace("([@#])", "[" + sigil + "]")
    return F.transform(F.regexp_extract_all(_c(text), F.lit(pattern), 1),
                       lambda t: F.lower(t))


def jaccard_at_least(a: Column, b: Column, num: int, den: int) -> Column:
    """``|a ∩ b| / |a ∪ b| >= num/den`` in integer arithmetic (exact)."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return inter * den >= union * num
