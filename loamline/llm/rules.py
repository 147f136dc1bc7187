"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations only read the bits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, map_texts

SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

MEASURES = [
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("n_lines", T.LongType()),
    ("n_upper", T.LongType()),
    ("n_bare_tokens", T.LongType()),
]


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where `fails` (SQL over the measurements) is true. The bit never changes its meaning."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_word_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols_per_word", "4 * n_symbols > n_words"),
    Rule(3, "capitals", "2 * n_upper > word_chars"),
    Rule(4, "duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule(5, "tokens_without_letters", "10 * n_bare_tokens > 3 * n_words"),
    Rule(6, "mean_word_length", "word_chars > 30 * n_words OR word_chars < 2 * n_words"),
)

#: Versioned policies: the bits that reject a document. A policy is data; the ledger needs no new pass for another one.
POLICIES = {
    "base": 0b0000011,
    "v1": 0b0001111,
    "v2": 0b1111111,
}


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    m = len(ids)
    if m < 2_000_000:
        windows = (codes[:-2] * m + codes[1:-1]) * m + codes[2:]
    else:  # three codes would leave 64 bits: number the pairs first
        _, pairs = np.unique(codes[:-1] * m + codes[1:], return_inverse=True)
        windows = pairs[:-1].astype(np.int64) * m + codes[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def _word_marks(word: bytes) -> int:
    """Capital letters times 2^32, plus 1 for a word without letter or digit: sums of these hold both counts."""
    chars = word.decode("utf-8", "replace")
    return (sum(map(str.isupper, chars)) << 32) + (not any(map(str.isalnum, chars)))


def measure_texts():
    marks = BoundedCache(_word_marks)

    def measure(texts: list[str | None]) -> dict[str, list[int]]:
        rows = []
        for text in texts:
            if not text:
                rows.append((0,) * len(MEASURES))
                continue
            words = text.encode("utf-8", "replace").split()
            marked = sum(map(marks.__getitem__, words))
            lines = [x for x in text.split("\n") if x.strip(SPACES)]
            rows.append((
                len(words),
                len(text) - sum(map(text.count, SPACES)),
                sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)),
                _repeat_words(words),
                len(lines),
                marked >> 32,
                marked & 0xFFFFFFFF,
            ))
            marks.trim()
        return {name: [r[i] for r in rows] for i, (name, _) in enumerate(MEASURES)}

    return measure


def ledger(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Measurements and `failed` (long), the bits of the rules that the document fails; one row for each input row.

    A null or empty text has zero measurements and so fails the rules on them. Repeated rows are measured each.
    keep: the input columns to keep, all by default; input columns named as a measurement or `failed` give way.
    """
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    stay = [c for c in (df.columns if keep is None else keep) if c != "failed"]
    return map_texts(df, measure_texts, MEASURES, text, stay).withColumn("failed", bits)


def apply_policy(ledger_df: DataFrame, policy: str | int = "v1", column: str = "kept") -> DataFrame:
    """Add a boolean column: true where no bit of the policy's mask is set. Null bits (no ledger row) count as failed."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return ledger_df.withColumn(column, F.coalesce(F.col("failed").bitwiseAND(F.lit(mask).cast("long")) == 0, F.lit(False)))


def ablations(ledger_df: DataFrame, policy: str | int = "v1", rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule does within a policy, from the bits alone, one row a rule.

    Returns rule, bit, n_failed, n_only_this (kept if the rule were left out), n_failed_with_any, n_rows. The bits are
    first grouped, so at most 2^rules rows reach the second step. An empty ledger gives zeros.
    """
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = ledger_df.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("p")).agg(F.count("*").alias("n"))
    chosen = [r for r in rules if mask >> r.bit & 1]
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    one = patterns.agg(
        F.array(*[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.bit).alias("bit"),
                total(F.col("p").bitwiseAND(F.lit(1 << r.bit).cast("long")) != 0).alias("n_failed"),
                total(F.col("p") == F.lit(1 << r.bit)).alias("n_only_this"),
                total(F.col("p") != 0).alias("n_failed_with_any"),
                total(F.lit(True)).alias("n_rows"),
            )
            for r in chosen
        ]).alias("rules")
    )
    return one.select(F.inline("rules"))


def co_failures(ledger_df: DataFrame) -> DataFrame:
    """bit_or, bit_and and the number of rows of each failure pattern, for audits."""
    return ledger_df.groupBy("failed").agg(F.count("*").alias("n"), F.bit_or("failed").alias("any_bits"), F.bit_and("failed").alias("all_bits"))
