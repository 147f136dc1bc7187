"""Content filter: detect, flag, reject or remove what user patterns match, with the sections around it."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import pandas as pd
from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("remove", "flag", "reject")
STAGES = ("extraction", "cleaning", "chunking", "filtering")
#: A section's ends look this far for a paragraph end, and this far for a sentence end.
PARAGRAPH_REACH, SENTENCE_REACH = 200, 100
#: So many matches give full confidence.
SURE = 3
#: Matches that one fold places.
BLOCK = 256


@dataclass(frozen=True)
class FilterConfig:
    patterns: tuple[str, ...] = ()
    action: str = "flag"
    context_chars: int = 500
    enabled: bool = True
    stages: tuple[str, ...] = field(default=STAGES)

    def valid_patterns(self) -> list[str]:
        """The patterns that can run; the others are left out (see invalid_patterns)."""
        return [p for p in self.patterns if _runs(p)]

    def invalid_patterns(self) -> list[str]:
        return [p for p in self.patterns if not _runs(p)]

    def active(self, stage: str | None = None) -> bool:
        return self.enabled and bool(self.valid_patterns()) and (stage is None or stage in self.stages)


#: Spellings of other dialects and what the JVM's regular expressions have for them.
_SPELLINGS = ((re.compile(r"\(\?P<"), "(?<"), (re.compile(r"\(\?P=(\w+)\)"), r"\\k<\1>"), (re.compile(r"\(\?#[^)]*\)"), ""))


def _java(pattern: str) -> str:
    """The pattern for the JVM: no case, ^ and $ at line ends (\\n only), Unicode classes."""
    for shape, spelling in _SPELLINGS:
        pattern = shape.sub(spelling, pattern)
    return "(?dimU)" + pattern


def _runs(pattern: str) -> bool:
    """Whether the JVM, which runs the patterns, takes this one."""
    jvm = SparkContext._active_spark_context._jvm
    try:
        jvm.java.util.regex.Pattern.compile(_java(pattern))
    except IllegalArgumentException:
        return False
    return True


def match_count(c: Column, config: FilterConfig) -> Column:
    """Non-overlapping matches of each pattern, patterns independent, added up; 0 for null."""
    total = F.lit(0)
    for pattern in config.valid_patterns() if config.enabled else []:
        total = total + F.coalesce(F.regexp_count(c, F.lit(_java(pattern))), F.lit(0))
    return total


def confidence(n: Column) -> Column:
    return F.least(n / F.lit(float(SURE)), F.lit(1.0))


def matches(c: Column, pattern: str) -> Column:
    """array<struct<text,start,end>> of one pattern's matches: the parts between them give the places.

    A fold copies what it has gathered at every step, so it runs within blocks of BLOCK matches, each from its own offset:
    the work grows with the matches, but for a number for each earlier block.
    """
    kind = "array<struct<text:string,start:int,end:int>>"
    found, gaps = F.regexp_extract_all(c, F.lit("(" + _java(pattern) + ")"), 1), F.split(c, _java(pattern))
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda t, g: F.struct(g.alias("gap"), t.alias("text")))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["gap"])
        end = at + F.length(x["text"])
        return F.struct(F.concat(acc["out"], F.array(F.struct(x["text"].alias("text"), at.alias("start"), end.alias("end")))).alias("out"), end.alias("at"))

    def place(block: Column, at: Column) -> Column:
        return F.aggregate(block, F.struct(F.expr(f"cast(array() as {kind})").alias("out"), at.alias("at")), step, lambda acc: acc["out"])

    def placed(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["text"])))
        offsets = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(blocks, F.slice(offsets, 1, F.size(blocks)), place))

    cut = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda i: F.slice(p, i * BLOCK + 1, BLOCK))
    # arrays of one element bind the pairs and the blocks, which would be computed at every use otherwise
    out = F.get(F.transform(F.transform(F.array(pairs), cut), placed), F.lit(0))
    return F.when(F.coalesce(F.regexp_count(c, F.lit(_java(pattern))), F.lit(0)) > 0, out).otherwise(F.expr(f"cast(array() as {kind})"))


def detections(c: Column, config: FilterConfig) -> Column:
    """array<struct<pattern,text,start,end>> of all patterns' matches, in the patterns' order; patterns cut to 50
    characters and matched texts to 100."""
    parts = []
    for pattern in config.valid_patterns() if config.enabled else []:
        name = F.lit(pattern[:50])
        parts.append(F.transform(matches(c, pattern), lambda m, name=name: F.struct(name.alias("pattern"), F.left(m["text"], F.lit(100)).alias("text"), m["start"].alias("start"), m["end"].alias("end"))))
    return F.concat(*parts) if parts else F.expr("cast(array() as array<struct<pattern:string,text:string,start:int,end:int>>)")


class Breaks:
    """The places of a text where a section may end: paragraph ends and sentence ends, each kind sorted."""

    def __init__(self, text: str):
        self.size = len(text)
        # (places, how far to look, what of the mark stays before a section, what stays after one), the preferred kind first
        self.kinds = [
            ([m.start() for m in re.finditer(r"(?=\n\n)", text)], PARAGRAPH_REACH, 2, 0),
            ([m.start() for m in re.finditer(r"\.(?=[ \n])", text)], SENTENCE_REACH, 2, 1),
        ]

    def before(self, at: int) -> int:
        for places, reach, skip, _ in self.kinds:
            i = bisect_right(places, at - 2)
            if i and places[i - 1] >= at - reach:
                return places[i - 1] + skip
        return at

    def after(self, at: int) -> int:
        for places, reach, _, keep in self.kinds:
            i = bisect_left(places, at)
            if i < len(places) and places[i] + 2 <= min(self.size, at + reach):
                return places[i] + keep
        return at


def sections(text: str, places: Sequence[tuple[int, int]], context: int) -> list[tuple[int, int]]:
    """Disjoint stretches around the places, widened by the context and moved to paragraph or sentence ends."""
    breaks = Breaks(text)
    wide = sorted((breaks.before(max(0, a - context)), breaks.after(min(len(text), b + context))) for a, b in places)
    ends = list(accumulate((hi for _, hi in wide), max))
    first = [i for i, (lo, _) in enumerate(wide) if i == 0 or lo > ends[i - 1]]
    return [(wide[i][0], ends[j - 1]) for i, j in zip(first, [*first[1:], len(wide)], strict=True)]


def redact(text: str | None, places: Sequence[tuple[int, int]], context: int) -> tuple[str | None, int, int]:
    """(text without the sections around the places, sections, removed characters). Without a place the text stays as it is."""
    if not text or not places:
        return text, 0, 0
    cut = sections(text, places, context)
    edges = [0, *(x for section in cut for x in section), len(text)]
    kept = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    out = re.sub(r"\n{3,}", "\n\n", kept).strip()
    return out, len(cut), len(text) - len(out)


def apply_filter(df: DataFrame, config: FilterConfig, stage: str | None = None, text: str = "text") -> DataFrame:
    """Add filter_matches, patterns_detected, filter_action, filter_confidence, filter_sections and removed_chars.

    Actions: flag leaves the text, reject makes it null, remove cuts the sections (only rows with a match reach Python).
    filter_action: removed, flagged, rejected or none. An unknown action detects and does nothing. Without active
    patterns nothing is detected.
    """
    active = config.active(stage)
    out = df.withColumn("filter_matches", match_count(F.col(text), config) if active else F.lit(0))
    hit = F.col("filter_matches") > 0
    done = {"remove": "removed", "flag": "flagged", "reject": "rejected"}.get(config.action, "none")
    out = out.withColumn("patterns_detected", hit).withColumn("filter_action", F.when(hit, done).otherwise("none")).withColumn("filter_confidence", confidence(F.col("filter_matches")))
    if active and config.action == "remove":

        @F.pandas_udf("text string, sections int, removed int")
        def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
            rows = [redact(t, [] if a is None else list(zip(map(int, a), map(int, b), strict=True)), config.context_chars) for t, a, b in zip(texts, starts, ends, strict=True)]
            return pd.DataFrame(rows, columns=["text", "sections", "removed"])

        # the places are those that the JVM counted, so one dialect decides
        out = out.withColumn("__at", F.when(hit, detections(F.col(text), config)))
        out = out.withColumn("__cut", cut(F.when(hit, F.col(text)), F.col("__at.start"), F.col("__at.end"))).drop("__at")
        out = out.withColumn(text, F.when(hit, F.col("__cut.text")).otherwise(F.col(text)))
        return out.withColumn("filter_sections", F.coalesce("__cut.sections", F.lit(0))).withColumn("removed_chars", F.coalesce("__cut.removed", F.lit(0))).drop("__cut")
    if active and config.action == "reject":
        out = out.withColumn(text, F.when(~hit, F.col(text)))
    return out.withColumn("filter_sections", F.lit(0)).withColumn("removed_chars", F.lit(0))


def filter_summary(filtered: DataFrame) -> DataFrame:
    """total, detected, removed, flagged, rejected, emptied and removed_chars: one row."""
    n = lambda c: F.count_if(c)
    return filtered.agg(
        F.count("*").alias("total"), n(F.col("patterns_detected")).alias("detected"), n(F.col("filter_action") == "removed").alias("removed"),
        n(F.col("filter_action") == "flagged").alias("flagged"), n(F.col("filter_action") == "rejected").alias("rejected"),
        n((F.col("filter_action") == "removed") & (F.col("text") == "")).alias("emptied"), F.coalesce(F.sum("removed_chars"), F.lit(0)).cast("long").alias("removed_chars"),
    )


def reapply(chunks: DataFrame, config: FilterConfig, text: str = "text") -> DataFrame:
    """The filter over stored chunks: adds `outcome` (kept, rewritten, deleted, flagged) and refreshes word_count and char_count.

    Nothing is written; callers write the rows they want, so looking at the outcomes is the dry run.
    """
    from loamline.functions.text import char_count, is_blank, word_count

    out = apply_filter(chunks, config, text=text)
    outcome = (
        F.when(F.col("filter_action") == "rejected", "deleted").when((F.col("filter_action") == "removed") & is_blank(F.col(text)), "deleted")
        .when(F.col("filter_action") == "removed", "rewritten").when(F.col("filter_action") == "flagged", "flagged").otherwise("kept")
    )
    return out.withColumn("outcome", outcome).withColumn("word_count", word_count(F.col(text))).withColumn("char_count", char_count(F.col(text)))
