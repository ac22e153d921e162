"""Text rules for matching and lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tail cut at a guest credit, and what counts as punctuation.
GUEST_TAIL = r"(?U)\b(ft|feat|featuring)\b.*$"
PUNCTUATION = r"[^a-z0-9\s]"


def match_text(text: Column) -> Column:
    """Lower-case ASCII words of a title or artist without its guest credit."""
    lowered = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    credited = F.regexp_replace(lowered, GUEST_TAIL, "")
    words = F.regexp_replace(credited, PUNCTUATION, " ")
    return F.trim(F.regexp_replace(words, r"\s+", " "))


def lookup_text(text: Column) -> Column:
    """Trimmed lower-case text with single blanks; punctuation stays."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "))


def listed_values(text: Column) -> Column:
    """Values of a list written with commas or semicolons, blanks dropped."""
    parts = F.split(F.translate(text, ";", ","), ",")
    return F.filter(
        F.transform(parts, lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != ""
    )


def holds(outer: Column, inner: Column) -> Column:
    """``inner`` occurs in ``outer``; an empty string occurs in nothing."""
    return (inner != "") & F.contains(outer, inner)


def _power(k: Column) -> Column:
    return F.pow(F.lit(2), k).cast("int")


def ladder_prefix(text: Column) -> Column:
    """The longest prefix of a text whose length is a power of two."""
    return F.substring(text, F.lit(1), _power(F.floor(F.log2(F.length(text)))))


def ladder_parts(text: Column) -> Column:
    """Distinct substrings of a text whose lengths are powers of two: under (log2 n + 1) n of them."""
    steps = F.sequence(F.lit(0), F.floor(F.log2(F.length(text))).cast("int"))

    def of_length(n: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n))

    return F.array_distinct(F.flatten(F.transform(steps, lambda k: of_length(_power(k)))))
