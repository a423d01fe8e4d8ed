"""Text expressions: trimming, tokens, patterns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.schema import FALSE_WORDS, MISSING_TOKENS, TRUE_WORDS


# Fixed value: the characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


# Java's \s, \d and \b know ASCII only; with this flag they match no-break blanks as well.
UNICODE = "(?U)"


def strip(c: Column) -> Column:
    """Trim every kind of Unicode white space (``trim`` alone removes blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, ``''`` without one; casts turn that into NULL."""
    return F.regexp_extract(c, UNICODE + pattern, group)


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, UNICODE + r"\s+", " ")


def null_if_token(trimmed: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """A trimmed text, or NULL when it is one of ``tokens`` in any case.

    The tokens are one array: a list of comparisons for each of many columns
    makes a method too large for the JVM to compile.
    """
    words = F.array(*[F.lit(t) for t in tokens]).cast("array<string>")
    return F.when(~F.array_contains(words, F.lower(trimmed)), trimmed)


def capitalize(c: Column) -> Column:
    """First letter upper, the rest lower (``initcap`` would raise every word)."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def tidy_list(c: Column) -> Column:
    """Normalise a ``|``-separated list: no blanks around bars, no outer bars."""
    bars = F.regexp_replace(c, UNICODE + r"\s*\|\s*", "|")
    return F.regexp_replace(bars, r"^\|+|\|+$", "")


def slug(c: Column) -> Column:
    """Lower-case key with every other character run as one ``_``."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def text_flag(c: Column) -> Column:
    """Text to boolean by two word lists; any other text is NULL."""
    word = F.lower(c)
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """Value of a small fixed mapping, NULL for other keys."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), c)
