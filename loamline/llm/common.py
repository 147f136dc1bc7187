"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loamline.session import small_batches, spread


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset a local session gets a temporary one; on a cluster this is an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="loamline-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one job in the shared folder: written, read again, and removed once no later step reads them.

    A table cuts the lineage and outlives lost executors. What a returned frame still reads must not be dropped.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/loamline/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """A single table of that kind."""
    return Scratch(df.sparkSession, name).write(df, "0")


def release_memory() -> None:
    """Give a worker's free memory back to the system, so that workers kept for later tasks stay small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def crc_of_id(column: Column) -> Column:
    """crc32 of an id as text, unsigned; null ids count as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str | None]], dict[str, Sequence]]],
    fields: Sequence[tuple[str, T.DataType]],
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Append columns computed from a text column, batch by batch in Python.

    make() runs once a task and returns a function from the texts of a batch to the new columns. keep names the
    input columns that stay (all by default); an input column that has the name of a new one gives way to it.
    """
    small_batches(df.sparkSession)
    new = [name for name, _ in fields]
    stay = [c for c in (df.columns if keep is None else keep) if c not in new]
    source = df.select(*[F.col(f"`{c}`") for c in stay], F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(n, t) for n, t in fields]])
    kinds = {n: to_arrow_type(t) for n, t in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            out = function(batch.column(len(stay)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(stay))], *[pa.array(out[n], type=kinds[n]) for n in new]],
                names=[*stay, *new],
            )
        del function
        release_memory()

    return source.mapInArrow(run, schema)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{table}.parquet"))


class BoundedCache(dict):
    """Word → value, computed once by `rule` and forgotten when `limit` words are held; bounds a worker's memory."""

    def __init__(self, rule: Callable, limit: int = 200_000):
        super().__init__()
        self.rule, self.limit = rule, limit

    def __missing__(self, key):
        value = self[key] = self.rule(key)
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()
