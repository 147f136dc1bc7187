"""The stateless stages on streams, and exact deduplication within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.functions.chunking import ChunkConfig, chunk
from loamline.functions.cleaning import CleanConfig, clean
from loamline.functions.quality import QualityConfig, gate_reason, with_metrics


def clean_stream(docs: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    return clean(docs, config)


def chunk_stream(docs: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    return chunk(docs, config)


def quality_stream(docs: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    return with_metrics(docs).withColumn("reason", gate_reason(config))


def dedup_stream(docs: DataFrame, time: str, delay: str, text: str = "text") -> DataFrame:
    """The first arrival of each text within the watermark; state is dropped once the delay has passed."""
    return docs.withColumn("text_sha256", F.sha2(F.col(text), 256)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_sha256"])
