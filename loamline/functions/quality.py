"""Quality metrics of a text and the gate that names the first failing rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import W, words

METRICS = ("word_count", "unique_words", "unique_ratio", "repetition_ratio", "alpha_ratio")


@dataclass(frozen=True)
class QualityConfig:
    """Bounds are inclusive on the keeping side. The default keeps by word count alone; strict() also by the ratios."""

    min_text_length: int = 50
    min_words: int = 10
    max_words: int = 100_000
    min_unique_ratio: float = 0.0
    max_repetition_ratio: float = 1.0
    min_alpha_ratio: float = 0.0
    min_readability: float | None = None

    def __post_init__(self) -> None:
        if not 0 <= self.min_words <= self.max_words:
            raise ValueError("min_words must lie between 0 and max_words")

    @staticmethod
    def strict() -> QualityConfig:
        return QualityConfig(min_words=50, min_unique_ratio=0.3, max_repetition_ratio=0.5, min_alpha_ratio=0.7)


def unique_words(lower_words: Column) -> Column:
    return F.size(F.array_distinct(lower_words)).cast("long")


def repetition_ratio(lower_words: Column) -> Column:
    """1 - distinct / all 3-word windows; 0 below 10 words."""
    n = F.size(lower_words)
    windows = F.transform(F.slice(lower_words, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), lower_words[i + 1], F.lit(" "), lower_words[i + 2]))
    return F.when(n < 10, 0.0).otherwise(1 - F.size(F.array_distinct(windows)) / (n - 2))


def alpha_ratio(c: Column) -> Column:
    """Letters and white space over all characters; 0 for the empty text."""
    return F.when(F.length(c) == 0, 0.0).otherwise(F.length(F.regexp_replace(c, rf"[^\p{{L}}{W}]+", "")) / F.length(c))


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the METRICS columns. A null text is measured as the empty text. Words are split once, in a step of their own."""
    c = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn("__words", words(c)).withColumn("__lower", F.transform("__words", F.lower))
    out = out.withColumn("word_count", F.size("__words").cast("long")).withColumn("unique_words", unique_words(F.col("__lower")))
    out = out.withColumn("unique_ratio", F.when(F.col("word_count") == 0, 0.0).otherwise(F.col("unique_words") / F.col("word_count")))
    out = out.withColumn("repetition_ratio", repetition_ratio(F.col("__lower"))).withColumn("alpha_ratio", alpha_ratio(c))
    return out.drop("__words", "__lower")


def gate_reason(config: QualityConfig, readability: Column | None = None) -> Column:
    """The code of the first rule that a measured row fails, in fixed order; null if it passes."""
    rules = [
        (F.col("word_count") < config.min_words, "too_few_words"),
        (F.col("word_count") > config.max_words, "too_many_words"),
        (F.col("unique_ratio") < config.min_unique_ratio, "low_unique_ratio"),
        (F.col("repetition_ratio") > config.max_repetition_ratio, "high_repetition"),
        (F.col("alpha_ratio") < config.min_alpha_ratio, "low_alpha_ratio"),
    ]
    if config.min_readability is not None and readability is not None:
        rules.append((readability < config.min_readability, "low_readability"))
    return F.coalesce(*[F.when(fails, F.lit(code)) for fails, code in rules])
