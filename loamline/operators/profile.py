"""Profiles of tables and of consecutive chunks, returned as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens a word, and the two pairs of size-class bounds in use.
TOKENS_PER_WORD = 1.33
SIZE_CLASSES = {"chunks": (256, 768), "shard": (300, 700)}
BUCKETS = ((256, "<=256"), (512, "257-512"), (1024, "513-1024"))


def length_profile(df: DataFrame, words: Column, chars: Column) -> DataFrame:
    """Word and character statistics: sample deviation and interpolated median, exact, in one row."""
    rows = df.select(words.cast("long").alias("w"), chars.cast("long").alias("c"))
    return rows.agg(
        F.count("*").alias("n"), F.min("w").alias("min_words"), F.max("w").alias("max_words"), F.avg("w").alias("mean_words"), F.percentile("w", F.lit(0.5)).alias("median_words"),
        F.stddev_samp("w").alias("std_words"), F.min("c").alias("min_chars"), F.max("c").alias("max_chars"), F.avg("c").alias("mean_chars"),
    )


def length_histogram(df: DataFrame, words: Column) -> DataFrame:
    """bucket, n and percent over the word count's buckets."""
    label = F.lit(">=1025")
    for bound, name in reversed(BUCKETS):
        label = F.when(words <= bound, name).otherwise(label)
    counts = df.groupBy(label.alias("bucket")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def null_profile(df: DataFrame) -> DataFrame:
    """column, non_null and null_percent of every column, in one pass."""
    counts = df.agg(F.count("*").alias("__all"), *[F.count(F.col(f"`{c}`")).alias(f"__{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("non_null")) for i, c in enumerate(df.columns)])
    flat = counts.select("__all", F.explode(rows).alias("r")).select("__all", "r.*")
    return flat.select("column", "non_null", F.when(F.col("__all") > 0, 100.0 * (F.col("__all") - F.col("non_null")) / F.col("__all")).otherwise(0.0).alias("null_percent"))


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column and n_unique (nulls excluded), exact."""
    counts = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(f"__{i}") for i, c in enumerate(columns)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("n_unique")) for i, c in enumerate(columns)])).alias("r")).select("r.*")


def value_counts(df: DataFrame, column: str, top: int = 10, max_unique: int = 20) -> DataFrame:
    """value, n and percent of the `top` most frequent values; no rows if the column has more than max_unique values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    whole = counts.agg(F.count("*").alias("__u"), F.sum("n").alias("__n"))
    kept = counts.join(F.broadcast(whole), F.col("__u") <= max_unique)  # the right side is one row
    return kept.select("value", "n", (100.0 * F.col("n") / F.col("__n")).alias("percent")).orderBy(F.desc("n"), "value").limit(top)


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, min, max and mean (doubles) of numeric columns, in one pass."""
    parts = [x for i, c in enumerate(columns) for x in (F.min(c).cast("double").alias(f"l{i}"), F.max(c).cast("double").alias(f"h{i}"), F.avg(c).alias(f"m{i}"))]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"), F.col(f"m{i}").alias("mean")) for i, c in enumerate(columns)])
    return df.agg(*parts).select(F.explode(rows).alias("r")).select("r.*")


def group_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def chunk_stats(df: DataFrame, by: str, words: Column) -> DataFrame:
    """n, min, max and mean words per value of a column, sorted by it."""
    return df.select(F.col(by), words.alias("w")).groupBy(by).agg(F.count("*").alias("n"), F.min("w").alias("min_words"), F.max("w").alias("max_words"), F.avg("w").alias("mean_words")).orderBy(by)


def token_estimate(words: Column) -> Column:
    return words * F.lit(TOKENS_PER_WORD)


def size_class(tokens: Column, bounds: tuple[int, int] = SIZE_CLASSES["chunks"]) -> Column:
    return F.when(tokens < bounds[0], "small").when(tokens <= bounds[1], "medium").otherwise("large")


def overlap_length(a: Column, b: Column, reach: int = 200, least: int = 20) -> Column:
    """The longest suffix of a that is a prefix of b, within `reach` characters; 0 below `least`.

    The first place of b's first `least` characters in a's tail gives the longest candidate, which nearly always decides; only where it
    fails are all lengths tried.
    """
    bound = F.least(F.lit(reach), F.length(a), F.length(b))
    tail, head = F.right(a, F.lit(reach)), F.left(b, F.lit(reach))
    sizes = F.filter(F.sequence(F.lit(least), F.greatest(bound, F.lit(least))), lambda n: (n <= bound) & (F.right(tail, n) == F.left(head, n)))
    place = F.instr(tail, F.left(head, F.lit(least)))
    first = F.length(tail) - place + 1
    found = (
        F.when(bound < least, 0).when(place == 0, 0).when((first <= bound) & (F.right(tail, first) == F.left(head, first)), first)
        .otherwise(F.coalesce(F.array_max(sizes), F.lit(0)))
    )
    return F.coalesce(found, F.lit(0))


def consecutive_overlap(df: DataFrame, order: Sequence[str], partition: Sequence[str], text: str = "text", reach: int = 200, least: int = 20) -> DataFrame:
    """Order columns, overlap_chars and overlap_words of each row with the row after it in its partition.

    Without a partition the whole table is one order (a single order column): rows are numbered by ranges and joined with
    the row one number on, so they don't meet in one task.
    """
    keys = list(dict.fromkeys([*partition, *order]))
    if partition:
        after = F.lead(text).over(Window.partitionBy(*partition).orderBy(*order))
        pairs = df.select(*keys, F.col(text), after.alias("__next")).where("__next IS NOT NULL")
    else:
        pairs = _with_next(df.select(*keys, F.col(text)), order[0], text)
    out = pairs.withColumn("overlap_chars", overlap_length(F.col(text), F.col("__next"), reach, least))
    from loamline.functions.text import word_count

    return out.select(*keys, "overlap_chars", word_count(F.when(F.col("overlap_chars") > 0, F.right(F.col(text), F.col("overlap_chars")))).alias("overlap_words"))


def _with_next(df: DataFrame, order: str, text: str) -> DataFrame:
    """The rows of a table in an order, each with row_index and the text of the row after it, as __next."""
    from loamline.operators.shards import row_numbers

    numbered = row_numbers(df, order)
    after = numbered.select((F.col("row_index") - 1).alias("row_index"), F.col(text).alias("__next"))
    return numbered.join(after, "row_index").where("__next IS NOT NULL")


def overlap_summary(df: DataFrame, order: str, text: str = "text", reach: int = 200, least: int = 20) -> DataFrame:
    """has_overlap, total_compared, overlapping_pairs, overlap_rate, avg_overlap_chars and avg_overlap_words of the sampled pairs: one row.

    The pairs that start at the places of sampled_pairs are compared, as far as both texts are there and not empty. Means are
    over overlapping pairs and null without one; the rate is 0 without a pair.
    """
    from loamline.functions.text import word_count
    from loamline.operators.shards import row_numbers

    at = sampled_pairs(df.select(order, text), order)
    # the sampled rows and those after them: a bounded number
    near = at.select(F.explode(F.array("row_index", F.col("row_index") + 1)).alias("row_index")).distinct()
    rows = row_numbers(df.select(order, text), order).join(F.broadcast(near), "row_index").select("row_index", text)
    pairs = at.select("row_index", F.col(text).alias("__a")).join(rows.select((F.col("row_index") - 1).alias("row_index"), F.col(text).alias("__b")), "row_index")
    pairs = pairs.where((F.coalesce("__a", F.lit("")) != "") & (F.coalesce("__b", F.lit("")) != "")).withColumn("k", overlap_length(F.col("__a"), F.col("__b"), reach, least))
    hit = F.col("k") > 0
    out = pairs.agg(
        F.count("*").alias("total_compared"), F.count_if(hit).alias("overlapping_pairs"), F.avg(F.when(hit, F.col("k"))).alias("avg_overlap_chars"),
        F.avg(F.when(hit, word_count(F.right(F.col("__a"), F.col("k"))))).alias("avg_overlap_words"),
    )
    rate = F.when(F.col("total_compared") > 0, F.col("overlapping_pairs") / F.col("total_compared")).otherwise(0.0)
    return out.select((F.col("overlapping_pairs") > 0).alias("has_overlap"), "total_compared", "overlapping_pairs", rate.alias("overlap_rate"), "avg_overlap_chars", "avg_overlap_words")


def quick_overlap(df: DataFrame, order: str, text: str = "text", reach: int = 100, most: int = 80) -> DataFrame:
    """has_overlap: whether a suffix (up to `most` characters) of the first row starts the second; null with fewer than two rows."""
    pair = df.select(order, text).orderBy(order).limit(2).agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("p"))  # two rows
    a, b = F.get("p", F.lit(0))[text], F.get("p", F.lit(1))[text]
    return pair.select(F.when(F.size("p") == 2, overlap_length(F.right(a, F.lit(reach)), b, most, 1) > 0).alias("has_overlap"))


def sampled_pairs(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The rows at the first, middle and last n places of the table's order, where overlaps are sampled."""
    from loamline.operators.shards import row_numbers

    numbered = row_numbers(df, order)
    total = numbered.agg(F.count("*")).first()[0]
    mid = total // 2
    at = F.col("row_index")
    return numbered.where((at < n) | at.between(mid - n // 2, mid - n // 2 + n - 1) | (at >= total - 1 - n) & (at < total - 1))


def head(df: DataFrame, order: str, n: int = 3) -> DataFrame:
    return df.orderBy(order).limit(n)


def tail(df: DataFrame, order: str, n: int = 3) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """stage, rows and mean characters of each stage's table, one scan each."""
    parts = [d.agg(F.lit(name).alias("stage"), F.count("*").alias("n"), F.avg(F.length("text")).alias("mean_chars")) for name, d in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
