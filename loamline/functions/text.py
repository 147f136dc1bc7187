"""Text primitives with Unicode whitespace, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The Unicode white space characters, as the inside of a Java character class (Java's \s is ASCII only).
W = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of them. The ranges beyond ASCII are behind one that contains them, so a letter is settled by three comparisons.
SPACES = r"[\t-\r\x1c-\x20[\x85-\u3000&&[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]+"
#: The characters themselves.
SPACE_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACE_CHARS))


def words(c: Column) -> Column:
    """Non-empty parts between white space; null stays null."""
    return F.filter(F.split(c, SPACES), lambda x: x != "")


def word_count(c: Column) -> Column:
    return F.coalesce(F.size(words(c)), F.lit(0)).cast("long")


def char_count(c: Column) -> Column:
    """Code points; null: 0."""
    return F.coalesce(F.length(c), F.lit(0)).cast("long")


def is_blank(c: Column) -> Column:
    return c.isNull() | ~c.rlike(f"[^{W}]")


def stable_id(*parts: Column) -> Column:
    """A deterministic id of a row: the SHA-256 of its parts (null parts count as empty)."""
    return F.sha2(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
