"""Shards: schema presets, consecutive slices of a fixed or size-based row count, and their metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.session import materialise

# The column presets of a shard.
PRESETS: dict[str, tuple[str, ...]] = {
    "minimal": ("text",),
    "basic": ("id", "text"),
    "standard": ("id", "text", "source_file", "language", "word_count"),
    "full": ("id", "text", "source_file", "filename", "file_type", "language", "chunk_index", "word_count", "char_count", "chunking_method", "chunking_timestamp", "unique_words", "unique_ratio", "repetition_ratio", "alpha_ratio", "readability_score"),
}
CODECS = ("snappy", "gzip", "none", "zstd", "lz4")
SAMPLE_ROWS, LEAST_ROWS = 100, 100


@dataclass(frozen=True)
class ShardConfig:
    schema: str = "minimal"
    custom: tuple[str, ...] = ()
    max_rows: int | None = None
    max_mb: float = 500.0
    compression: str = "snappy"

    def __post_init__(self) -> None:
        if self.compression not in CODECS:
            raise ValueError(f"compression must be one of {CODECS} (this Spark has no brotli codec)")


def select_preset(df: DataFrame, schema: str = "minimal", custom: Sequence[str] = ()) -> DataFrame:
    """The preset's columns that df has, in the preset's order; all columns for an unknown preset."""
    names = custom if schema == "custom" else PRESETS.get(schema)
    return df if names is None else df.select([c for c in names if c in df.columns])


def flatten(chunks: DataFrame) -> DataFrame:
    """Nested metadata (and quality_metrics in it) as flat columns."""
    out = chunks
    if "metadata" in out.columns:
        inner = out.schema["metadata"].dataType.names
        out = out.select(*[c for c in out.columns if c != "metadata" and c not in inner], "metadata.*")
    if "quality_metrics" in out.columns:
        inner = out.schema["quality_metrics"].dataType.names
        out = out.select(*[c for c in out.columns if c != "quality_metrics" and c not in inner], "quality_metrics.*")
    return out


def row_numbers(df: DataFrame, order: str) -> DataFrame:
    """Add row_index, gapless from 0 in the order of a column, without a single-task window.

    Rows are dealt by range, ranked within their partition, and shifted by the rows of the partitions before. Ties are ordered
    by a hash of the row, so that one repeated value does not fall into a single range. The dealt rows are a table in the
    shared folder: ranges come from a sample, and a second one could differ.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if not kind.startswith(("map", "variant"))])
    dealt = materialise(df.withColumn("__tie", tie).repartitionByRange(order, "__tie").withColumn("__part", F.spark_partition_id()), "ranges")
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy(order, "__tie")))
    counts = ranked.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))  # one row a partition
    return ranked.join(before, "__part").withColumn("row_index", F.col("__before") + F.col("__rank") - 1).drop("__part", "__rank", "__before", "__tie")


def rows_per_shard(df: DataFrame, config: ShardConfig, order: str, text: str = "text") -> int:
    """max_rows, or (null or 0) as many rows of the mean size of the first SAMPLE_ROWS as fit max_mb, LEAST_ROWS at least."""
    if config.max_rows:
        return config.max_rows
    size = df.orderBy(order).limit(SAMPLE_ROWS).agg(F.avg(F.octet_length(text))).first()[0]
    return max(LEAST_ROWS, int(config.max_mb * 1024 * 1024 / size)) if size else LEAST_ROWS


def assign_shard(df: DataFrame, rows: int, order: str) -> DataFrame:
    """Add row_index and shard_index: consecutive slices of `rows` rows; the last is short."""
    if rows < 1:
        raise ValueError("rows must be positive")
    return row_numbers(df, order).withColumn("shard_index", F.floor(F.col("row_index") / rows).cast("long"))


def write_shards(df: DataFrame, path: str, config: ShardConfig, order: str) -> DataFrame:
    """Write one folder a shard (shard_index=n) with the preset's columns and return the shard's metadata."""
    rows = rows_per_shard(df, config, order)
    placed = assign_shard(df, rows, order)
    names = select_preset(df, config.schema, config.custom).columns
    out = placed.select(*names, "shard_index")
    out.repartition("shard_index").write.mode("overwrite").option("compression", config.compression).partitionBy("shard_index").parquet(path)
    return shard_metadata(placed, config.compression)


def shard_metadata(placed: DataFrame, compression: str = "snappy", created: Column | None = None) -> DataFrame:
    """total_chunks, total_shards, compression, created_at and the schema as a map: one row."""
    kinds = F.create_map(*[F.lit(x) for pair in placed.dtypes for x in pair]) if placed.dtypes else F.create_map()
    return placed.agg(F.count("*").alias("total_chunks"), F.count_distinct("shard_index").alias("total_shards")).select(
        "total_chunks", "total_shards", F.lit(compression).alias("compression"), (created if created is not None else F.lit(None).cast("timestamp")).alias("created_at"), kinds.alias("schema")
    )


def list_shards(spark: SparkSession, path: str) -> DataFrame:
    """path, size and modification time of the shard files, by name; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("length").alias("bytes"), "modificationTime").orderBy("path")
