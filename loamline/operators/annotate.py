"""Categories, annotation records, exact-size samples, and instruction records from annotated tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline.functions.quality import METRICS

GENERAL = "general"
# The default categories and their keywords, in order.
CATEGORIES: dict[str, tuple[str, ...]] = {
    "general": (),
    "finance": ("financial", "investment", "trading", "market", "stock"),
    "health": ("medical", "health", "disease", "treatment", "patient"),
    "technology": ("software", "programming", "algorithm", "computer", "AI"),
    "science": ("research", "experiment", "theory", "hypothesis", "data"),
}


def category_score(c: Column, keywords: Sequence[str]) -> Column:
    """How many of the keywords occur in the lower-cased text as substrings."""
    low, total = F.lower(c), F.lit(0)
    for word in keywords:
        total = total + F.coalesce(low.contains(word.lower()).cast("int"), F.lit(0))
    return total


def category(c: Column, categories: Mapping[str, Sequence[str]] = CATEGORIES, auto: bool = True) -> Column:
    """The category with the highest score, the earlier of equals; general without a hit or if auto is off."""
    scored = [(name, category_score(c, words)) for name, words in categories.items() if words]
    if not auto or not scored:
        return F.lit(GENERAL)
    best = F.greatest(*[s for _, s in scored]) if len(scored) > 1 else scored[0][1]
    out = F.when(best == 0, GENERAL)
    for name, s in scored:
        out = out.when(s == best, name)
    return out


def categorise(df: DataFrame, categories: Mapping[str, Sequence[str]] = CATEGORIES, auto: bool = True, text: str = "text") -> DataFrame:
    return df.withColumn("niche", category(F.col(text), categories, auto))


def annotation_records(chunks: DataFrame, exported: Column | None = None, key: str = "chunk_id") -> DataFrame:
    """id, text, niche and the metadata struct; quality_metrics is part of it only if the chunks carry the metrics."""
    have = set(chunks.columns)
    pick = lambda name, kind: (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
    fields = [pick("source_file", "string"), pick("filename", "string"), pick("language", "string"), pick("word_count", "long"), (exported if exported is not None else F.lit(None).cast("timestamp")).alias("export_timestamp")]
    if have.issuperset(METRICS):
        fields.append(F.struct(*METRICS).alias("quality_metrics"))
    return chunks.select(F.col(key).alias("id"), "text", "niche", F.struct(*fields).alias("metadata"))


def task_records(records: DataFrame) -> DataFrame:
    """data: struct<text, id, niche> with '' and general for nulls."""
    blank = lambda c, d: F.coalesce(F.col(c).cast("string"), F.lit(d)).alias(c)
    return records.select(F.struct(blank("text", ""), blank("id", ""), blank("niche", GENERAL)).alias("data"))


def stratified_sample(df: DataFrame, by: str, key: str, rate: float, seed: str = "sample") -> DataFrame:
    """Exactly floor(n · rate) rows of each stratum, without replacement: those with the least hash of seed and key.

    Hashes are ranked in slices of the hash's range, so that no stratum meets in one task: counts per slice give each slice's
    offset. A rate of 1 or more keeps all rows.
    """
    from pyspark.sql import Window

    if rate >= 1:
        return df
    if rate < 0:
        raise ValueError("rate must not be negative")
    hashed = df.withColumn("__h", F.xxhash64(F.lit(seed), F.col(key).cast("string"))).withColumn("__slice", F.shiftright("__h", 52))
    counts = hashed.groupBy(by, "__slice").agg(F.count("*").alias("__n"))
    placed = counts.select(
        F.col(by).alias("__by"), F.col("__slice").alias("__s"),
        (F.sum("__n").over(Window.partitionBy(by).orderBy("__slice")) - F.col("__n")).alias("__before"),
        F.floor(F.sum("__n").over(Window.partitionBy(by)) * F.lit(float(rate))).alias("__take"),
    ).where("__before < __take")
    near = hashed.join(placed, F.col(by).eqNullSafe(F.col("__by")) & (F.col("__slice") == F.col("__s")))
    ranked = near.withColumn("__rank", F.row_number().over(Window.partitionBy(by, "__slice").orderBy("__h", F.col(key).cast("string"))))
    return ranked.where(F.col("__before") + F.col("__rank") <= F.col("__take")).select(df.columns)


VALUE = T.StructType([T.StructField("text", T.ArrayType(T.StringType())), T.StructField("choices", T.ArrayType(T.StringType())), T.StructField("rating", T.LongType())])
TASK = T.StructType([
    T.StructField("data", T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("niche", T.StringType())])),
    T.StructField("annotations", T.ArrayType(T.StructType([
        T.StructField("created_at", T.StringType()),
        T.StructField("result", T.ArrayType(T.StructType([T.StructField("from_name", T.StringType()), T.StructField("value", VALUE)]))),
    ]))),
])


def sft_records(tasks: DataFrame) -> DataFrame:
    """id, instruction, input (the item input_context), response, niche, quality_rating, original_text, annotation_timestamp of annotated tasks.

    The last annotation counts, and in it the last item of each name. Missing or empty values give '' (niche: general, rating: null).
    Tasks without annotations give no row.
    """
    last = tasks.where(F.size("annotations") > 0).select("data", F.element_at("annotations", -1).alias("a"))
    item = lambda name: F.try_element_at(F.filter("a.result", lambda x: x["from_name"] == name), F.lit(-1))
    first = lambda name, part, default: F.coalesce(F.when(F.get(item(name)["value"][part], F.lit(0)) != "", F.get(item(name)["value"][part], F.lit(0))), F.lit(default))
    blank = lambda c, d: F.coalesce(F.when(c != "", c), F.lit(d))
    return last.select(
        F.coalesce("data.id", F.lit("")).alias("id"),
        first("instruction", "text", "").alias("instruction"),
        first("input_context", "text", "").alias("input"),
        first("response", "text", "").alias("response"),
        blank(first("niche", "choices", ""), GENERAL).alias("niche"),
        item("quality")["value"]["rating"].alias("quality_rating"),
        F.coalesce("data.text", F.lit("")).alias("original_text"),
        F.coalesce("a.created_at", F.lit("")).alias("annotation_timestamp"),
    )


def validate_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """total, valid, invalid and rate of JSON lines: valid where instruction and response are non-empty strings.

    Blank and malformed lines are invalid. rate: valid / total, 0 without lines.
    """
    parsed = F.from_json(F.col(column), "instruction string, response string")
    ok = (F.coalesce(parsed["instruction"], F.lit("")) != "") & (F.coalesce(parsed["response"], F.lit("")) != "")
    out = lines.agg(F.count("*").alias("total"), F.count_if(ok).alias("valid"))
    return out.select("total", "valid", (F.col("total") - F.col("valid")).alias("invalid"), F.when(F.col("total") > 0, F.col("valid") / F.col("total")).otherwise(0.0).alias("rate"))


def count_by(df: DataFrame, column: str = "niche") -> DataFrame:
    """Rows per value; null counts as general."""
    return df.groupBy(F.coalesce(F.col(column), F.lit(GENERAL)).alias(column)).agg(F.count("*").alias("n"))


def completion(total: Column, annotated: Column) -> Column:
    return F.when(total > 0, annotated / total).otherwise(0.0)
