"""Sharding by weighted rendezvous hashing of a stable record key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard 0..n-1 with the least -ln(u) / weight, u being the key's uniform hash for that shard.

    Only the key and a shard's own number and weight enter its figure, so another shard takes keys only into itself, and
    a changed weight moves keys only to or from that shard. A shard's share is its weight over the sum. Ties go to the
    lower number. A null key counts as one key of its own.
    """
    if not weights or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must be at least 0 and one above 0")
    name = F.coalesce(key.cast("string"), F.lit("\x00null"))
    figures = []
    for shard, weight in enumerate(weights):
        if weight:
            bits = F.shiftrightunsigned(F.xxhash64(name, F.lit(f"shard {shard}")), 11).cast("double")  # 53 bits
            u = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
            figures.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("figure"), F.lit(shard).alias("shard")))
    return (F.least(*figures) if len(figures) > 1 else figures[0]).getField("shard")


def assign_shards(df: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 8, grown: Sequence[float] | None = None) -> DataFrame:
    """key, size, text_crc32, shard, slot and grown_shard (null without `grown`) for every row.

    size: UTF-8 bytes of the text plus 1 (null: 1). slot: gapless from 0 in each shard. Rows that are equal in
    everything keep a slot each. Slots are numbered inside each input partition and shifted by the rows that the
    partitions before it have in the shard, so neither a hot key nor a whole shard ever meets in one task. Columns
    besides key and text are ignored.
    """
    grown_shard = rendezvous_shard(F.col("key"), grown) if grown is not None else F.lit(None).cast("int")
    rows = df.select(
        F.col(f"`{key}`").alias("key"),
        (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = rows.select("*", rendezvous_shard(F.col("key"), weights).alias("shard"), grown_shard.alias("grown_shard"), F.monotonically_increasing_id().alias("at"))
    rows = materialise(rows, "shards").withColumn("part", F.shiftright("at", 33))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    inside = rows.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "part").orderBy("at")))
    return inside.join(before, ["shard", "part"]).select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).alias("slot"), "grown_shard")
