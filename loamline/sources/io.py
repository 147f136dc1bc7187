"""Readers and writers of chunks, JSON lines and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", T.StructType([
        *[T.StructField(c, T.StringType()) for c in ("source_file", "filename", "file_type", "language")],
        T.StructField("chunk_index", T.LongType()), T.StructField("total_chunks", T.LongType()), T.StructField("chunking_method", T.StringType()),
        T.StructField("chunking_timestamp", T.StringType()), T.StructField("word_count", T.LongType()), T.StructField("char_count", T.LongType()),
    ])),
])


#: The column that holds what could not be read.
CORRUPT = "corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_chunks(spark: SparkSession, path: str, schema: T.StructType = CHUNK, keep_corrupt: bool = False) -> DataFrame:
    """Chunk files, one JSON object each, at any depth. Files that are no JSON are dropped, or with keep_corrupt stay as rows
    whose content is in corrupt_record (null in the others)."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if keep_corrupt:
        return reader.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return reader.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; a line that is no JSON is a row with the line in corrupt_record (null in the others), so nothing is lost or unnoticed."""
    return spark.read.schema(_with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_json_lines(records: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines with explicit nulls; `by` makes a folder for each value and keeps the column in the lines as well."""
    writer = (records.withColumn(f"{by}_folder", F.coalesce(F.col(by), F.lit("general"))) if by else records).write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(f"{by}_folder") if by else writer).json(path)


def join_sidecars(bodies: DataFrame, metadata: DataFrame, stem: str = "stem") -> DataFrame:
    """Text rows with their metadata rows, by stem; rows without metadata drop out."""
    return bodies.join(metadata, stem, "inner")


def write_successful(rows: DataFrame, path: str, success: str, text: str = "text") -> None:
    """Rows of a stage that succeeded and have a text, as Parquet."""
    rows.where(F.col(success) & F.col(text).isNotNull() & (F.col(text) != "")).write.mode("overwrite").parquet(path)
