"""Column expressions that clean and compare names and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def clean(text: Column) -> Column:
    """Letters and digits alone in lower case, with single spaces; null as empty. For texts without address punctuation; normal.clean_expr keeps that."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def phonetic_fold(text: Column) -> Column:
    """Runs of a vowel become one; ph becomes f."""
    return F.replace(F.regexp_replace(text, r"([aeiou])\1+", "$1"), F.lit("ph"), F.lit("f"))


def tokens(text: Column) -> Column:
    """Space-separated tokens without empty ones."""
    return F.filter(F.split(text, " "), lambda x: x != "")


def acronym(words: Column) -> Column:
    """First character of each token."""
    return F.array_join(F.transform(words, lambda x: F.substring(x, 1, 1)), "")


def script_of(text: Column) -> Column:
    """0 no letters, 1 Latin only, 2 to 10 the Indic script with most characters (first of equals), 15 other."""
    blocks = [(2 + i, rf"[\x{{{0x900 + 0x80 * i:04x}}}-\x{{{0x97F + 0x80 * i:04x}}}]") for i in range(9)]
    counts = [F.regexp_count(text, F.lit(p)) for _, p in blocks]
    most = F.greatest(*counts)
    indic = F.coalesce(*[F.when(c == most, F.lit(code)) for (code, _), c in zip(blocks, counts, strict=True)])
    return F.when(most > 0, indic).when(F.rlike(text, F.lit(r"[\p{L}&&[^\p{IsLatin}]]")), 15).when(F.rlike(text, F.lit(r"\p{L}")), 1).otherwise(0)


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets of tokens; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.size(F.array_union(a, b)))


def containment(a: Column, b: Column) -> Column:
    """Shared tokens over those of the smaller set; 0 if either is empty."""
    both, least = F.size(F.array_intersect(a, b)), F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least == 0, F.lit(0.0)).otherwise(both / F.greatest(least, F.lit(1)))


def char_grams(text: Column, n: int) -> Column:
    """The set of n-character pieces; none if the text is shorter."""
    last = F.length(text) - n
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.substr(text, i + 1, F.lit(n)))
    return F.when(last < 0, F.array().cast("array<string>")).otherwise(F.array_distinct(pieces))


def length_ratio(a: Column, b: Column) -> Column:
    most = F.greatest(F.length(a), F.length(b))
    return F.when(F.least(F.length(a), F.length(b)) == 0, F.lit(0.0)).otherwise(F.least(F.length(a), F.length(b)) / F.greatest(most, F.lit(1)))


def prefix_ratio(a: Column, b: Column) -> Column:
    """Length of the common prefix over that of the longer text."""
    least, most = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    same = F.transform(F.sequence(F.lit(1), F.greatest(least, F.lit(1))), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1)))
    first = F.array_position(same, F.lit(False))
    return F.when(least == 0, F.lit(0.0)).otherwise(F.when(first == 0, least).otherwise(first - 1) / F.greatest(most, F.lit(1)))
