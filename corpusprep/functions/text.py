"""Text columns: words, lines, bytes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The word pattern, and what is not white space in any script.
WORD = "[a-z0-9]+"
NON_BLANK = r"[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def is_blank(text: Column) -> Column:
    """True when the line holds nothing but (Unicode) white space."""
    return ~text.rlike(NON_BLANK)


def words(text: Column) -> Column:
    """Lower-case word tokens."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def count_words(text: Column) -> Column:
    """``size(words(text))`` without building the array."""
    return F.regexp_count(F.lower(text), F.lit(WORD))


def byte_ids(text: Column) -> Column:
    """UTF-8 byte values of the text, as token ids 0-255."""
    pairs = F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit("[0-9A-F]{2}"), F.lit(0))
    return F.transform(pairs, lambda pair: F.conv(pair, 16, 10).cast("int"))


def byte_len(text: Column) -> Column:
    """Length in bytes."""
    return F.octet_length(text)


def repair_utf8(text: Column) -> Column:
    """Replace every malformed byte sequence with U+FFFD."""
    return F.make_valid_utf8(text)


def lines_of(text: Column) -> Column:
    """The lines of a text, without line ends and without the void after a final one."""
    parts = F.split(text, "\n", -1)
    whole = F.size(parts) - F.when(text.endswith("\n") | (F.length(text) == 0), 1).otherwise(0)
    return F.slice(parts, F.lit(1), whole)
