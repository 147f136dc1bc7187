"""Text cleaning as chained native expressions; every rejected text keeps a reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language import detect_language, fix_encoding
from .text import is_blank, strip

# The character sets and shapes that count as URL, e-mail address and telephone number. The two last
# telephone shapes need a word character right before ( or +, so they seldom match; compat keeps them so.
URL = r"https?://[!$-_a-z]+"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONES = (r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b", r"\b\(\d{3}\)\s*\d{3}[-.]?\d{4}\b", r"\b\+\d{1,3}[-.\s]?\d{1,4}[-.\s]?\d{1,4}[-.\s]?\d{1,9}\b")
PHONES_STRICT = (r"\+\d{1,3}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}\b", r"\(\d{3}\)\s*\d{3}[-.]?\d{4}\b", PHONES[0])
MIN_CLEANED = 50


@dataclass(frozen=True)
class CleanConfig:
    remove_urls: bool = True
    remove_emails: bool = True
    remove_phones: bool = True
    straighten_quotes: bool = False
    normalise_whitespace: bool = True
    min_line_length: int = 0
    languages: tuple[str, ...] = field(default_factory=tuple)
    compat: bool = True
    fix_encoding: bool = False
    detect_language: bool = False


def remove_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, "")


def remove_emails(c: Column) -> Column:
    return F.regexp_replace(c, EMAIL, "")


def remove_phones(c: Column, compat: bool = True) -> Column:
    for shape in PHONES if compat else PHONES_STRICT:
        c = F.regexp_replace(c, "(?U)" + shape, "")
    return c


def straighten_quotes(c: Column) -> Column:
    return F.translate(c, "“”„‟‘’‚‛", "\"\"\"\"''''")


def normalise_whitespace(c: Column) -> Column:
    """One space for runs of spaces, at most two line ends in a row, then every line stripped; outer line ends stay."""
    c = F.regexp_replace(F.regexp_replace(c, " {2,}", " "), "\n{3,}", "\n\n")
    return F.array_join(F.transform(F.split(c, "\n"), strip), "\n")


def remove_short_lines(c: Column, least: int) -> Column:
    """Lines of `least` characters (stripped) or more, and blank lines."""
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: (F.length(strip(x)) >= least) | (strip(x) == "")), "\n")


def clean_expression(c: Column, config: CleanConfig = CleanConfig()) -> Column:
    for wanted, step in (
        (config.fix_encoding, fix_encoding),
        (config.remove_urls, remove_urls),
        (config.remove_emails, remove_emails),
        (config.remove_phones, lambda x: remove_phones(x, config.compat)),
        (config.straighten_quotes, straighten_quotes),
        (config.normalise_whitespace, normalise_whitespace),
        (config.min_line_length > 0, lambda x: remove_short_lines(x, config.min_line_length)),
    ):
        c = step(c) if wanted else c
    return c


def clean(df: DataFrame, config: CleanConfig = CleanConfig(), text: str = "text", lang: str | None = "lang", guard: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add cleaned, original_length, cleaned_length, reduction_ratio, cleaning_success and cleaning_reason to every row.

    guard, if given, sees the rows once `cleaned` is made; it may change `cleaned` and adds filter_action.
    Reasons: empty_text (null or blank), filter_rejected (by the guard), language (a known language that is not wanted), too_short (under 50 characters
    once cleaned); null on success. Failed rows stay, with their cleaned text. With detect_language the language is
    guessed from the cleaned text (column `language`) instead of read from `lang`; unknown ones pass.
    """
    out = df.withColumn("cleaned", clean_expression(F.coalesce(F.col(text), F.lit("")), config))
    out = guard(out) if guard else out
    out = out.withColumn("original_length", F.length(F.coalesce(F.col(text), F.lit(""))).cast("long")).withColumn("cleaned_length", F.coalesce(F.length("cleaned"), F.lit(0)).cast("long"))
    ratio = F.when(F.col("original_length") == 0, 0.0).otherwise((F.col("original_length") - F.col("cleaned_length")) / F.col("original_length"))
    reasons = [F.when(is_blank(F.col(text)), F.lit("empty_text"))]
    if guard:
        reasons.append(F.when(F.col("filter_action") == "rejected", F.lit("filter_rejected")))
    if config.detect_language:
        out, lang = out.withColumn("language", detect_language(F.col("cleaned"))), "language"
    if config.languages and lang:
        known = F.coalesce(F.col(lang), F.lit("unknown"))
        reasons.append(F.when((known != "unknown") & ~known.isin(list(config.languages)), F.lit("language")))
    reasons.append(F.when(F.col("cleaned_length") < MIN_CLEANED, F.lit("too_short")))
    out = out.withColumn("reduction_ratio", ratio).withColumn("cleaning_reason", F.coalesce(*reasons))
    return out.withColumn("cleaning_success", F.col("cleaning_reason").isNull())
