"""Language and encoding repair, small deterministic functions in Arrow batches, and readability, in native expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import W

# Frequent function words of each language.
STOP_WORDS = {
    "en": frozenset("the of and to in is that it for was on with as be at by this from or an are not have which you but his her they we".split()),
    "de": frozenset("der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie".split()),
    "fr": frozenset("le la les de des et en un une du que est pour qui dans par sur au plus ne se pas avec ce il sont ou aux elle nous".split()),
    "es": frozenset("de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí es".split()),
}
LANGUAGE_CHARS = 1000
_WORD = re.compile(r"[^\W\d_]+")
VOWELS = "aeiouyàâäáéèêëíîïóôöúùûü"
_VOWELS = re.compile(f"[{VOWELS}]+")
DEFAULT_READABILITY = 50.0
# The inside of a Java character class for what _WORD takes: letters and numbers that are no decimal digits. Java 17 knows the characters of
# Unicode 13; the ranges are those that came until 15.1. The outer range spares most characters the walk through them.
LETTERS = (
    r"\p{L}\p{Nl}\p{No}[\x{870}-\x{323af}&&[\x{870}-\x{887}\x{889}-\x{88e}\x{8b5}\x{8c8}\x{8c9}\x{c5d}\x{cdd}\x{170d}\x{171f}\x{1b4c}\x{2c2f}\x{2c5f}\x{9ffd}-\x{9fff}"
    r"\x{a7c0}\x{a7c1}\x{a7d0}\x{a7d1}\x{a7d3}\x{a7d5}-\x{a7d9}\x{a7f2}-\x{a7f4}\x{10570}-\x{1057a}\x{1057c}-\x{1058a}\x{1058c}-\x{10592}\x{10594}\x{10595}\x{10597}-\x{105a1}"
    r"\x{105a3}-\x{105b1}\x{105b3}-\x{105b9}\x{105bb}\x{105bc}\x{10780}-\x{10785}\x{10787}-\x{107b0}\x{107b2}-\x{107ba}\x{10f70}-\x{10f81}\x{11071}\x{11072}\x{11075}\x{1123f}\x{11240}"
    r"\x{11740}-\x{11746}\x{11ab0}-\x{11abf}\x{11f02}\x{11f04}-\x{11f10}\x{11f12}-\x{11f33}\x{12f90}-\x{12ff0}\x{1342f}\x{13441}-\x{13446}\x{16a70}-\x{16abe}\x{1aff0}-\x{1aff3}"
    r"\x{1aff5}-\x{1affb}\x{1affd}\x{1affe}\x{1b11f}-\x{1b122}\x{1b132}\x{1b155}\x{1d2c0}-\x{1d2d3}\x{1df00}-\x{1df1e}\x{1df25}-\x{1df2a}\x{1e030}-\x{1e06d}\x{1e290}-\x{1e2ad}"
    r"\x{1e4d0}-\x{1e4eb}\x{1e7e0}-\x{1e7e6}\x{1e7e8}-\x{1e7eb}\x{1e7ed}\x{1e7ee}\x{1e7f0}-\x{1e7fe}\x{2a6de}\x{2a6df}\x{2b735}-\x{2b739}\x{2ebf0}-\x{2ee5d}\x{31350}-\x{323af}]]"
)


def guess_language(text: str | None) -> str:
    """The language with most stop words among the first 1000 characters; unknown without a hit or on a tie."""
    tokens = _WORD.findall((text or "")[:LANGUAGE_CHARS].lower())
    scores = sorted(((sum(t in words for t in tokens), lang) for lang, words in STOP_WORDS.items()), reverse=True)
    return scores[0][1] if scores[0][0] > 0 and scores[0][0] > scores[1][0] else "unknown"


def syllables(word: str) -> int:
    groups = len(_VOWELS.findall(word))
    return max(1, groups - (word.endswith("e") and not word.endswith("le") and groups > 1))


def reading_ease(text: str | None) -> float:
    """Flesch reading ease with rule-based syllables; 50 for texts without words. The plain form of `readability`."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return DEFAULT_READABILITY
    sentences = max(1, len([s for s in re.split(r"[.!?]+", text) if s.strip()]))
    return 206.835 - 1.015 * len(words) / sentences - 84.6 * sum(map(syllables, words)) / len(words)


def repair(text: str | None) -> str | None:
    """Undo UTF-8 that was read as cp1252, where the round trip is exact and leaves fewer suspicious characters."""
    if not text or text.isascii():
        return text
    try:
        better = text.encode("cp1252").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return text
    return better if len(better) < len(text) else text


@F.pandas_udf(T.StringType())
def _language(s: pd.Series) -> pd.Series:
    return s.map(guess_language)


@F.pandas_udf(T.StringType())
def _repair(s: pd.Series) -> pd.Series:
    return s.map(repair)


def detect_language(c: Column) -> Column:
    return _language(F.coalesce(F.substring(c, 1, LANGUAGE_CHARS), F.lit("")))


def readability(c: Column) -> Column:
    """The reading ease, by counts of matches in the JVM: no text goes to Python. Null counts as the empty text.

    A vowel is a letter, so the vowel groups of all words are those of the text. A word without one has a syllable too, and a
    word of two or more groups that ends in e, but not in le, has one less. Each pattern takes a word whole, so time is linear.
    """
    text = F.coalesce(c, F.lit(""))
    low, count = F.lower(text), lambda x, pattern: F.regexp_count(x, F.lit(pattern))
    letter, vowel, other = f"[{LETTERS}]", f"[{VOWELS}]", f"[{LETTERS}&&[^{VOWELS}]]"
    words = count(low, f"{letter}+")
    silent = count(low, f"(?<!{letter})(?={other}*+{vowel}++{letter}){letter}++(?<=e)(?<!le)")
    syllables = count(low, f"{vowel}+") + count(low, f"(?<!{letter}){other}++(?!{letter})") - silent
    sentences = F.greatest(F.lit(1), count(text, rf"[^.!?{W}][^.!?]*+"))
    ease = F.lit(206.835) - F.lit(1.015) * words / sentences - F.lit(84.6) * syllables / words
    return F.when(words == 0, F.lit(DEFAULT_READABILITY)).otherwise(ease)


def fix_encoding(c: Column) -> Column:
    """Only texts with characters beyond ASCII reach Python."""
    return F.when(c.rlike(r"[^\x00-\x7f]"), _repair(c)).otherwise(c)
