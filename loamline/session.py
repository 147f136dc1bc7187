"""A session with the settings that the operators expect."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows and bytes an Arrow batch carries to Python at most: keeps a batch of long texts within a worker's memory.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def get_spark(app: str = "loamline", master: str | None = None, **conf: str) -> SparkSession:
    """The running session, or a new one: UTC, adaptive execution with skew handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch, unless the session already has tighter bounds."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key))
        if not now or not 0 < int(now[1]) <= most:  # a size with a unit is replaced too
            spark.conf.set(key, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, for tables that cut a lineage: spark.checkpoint.dir. Where it is unset a local
    session (tests) gets one of this machine; on a cluster this is an error."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="loamline-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again: what is used several times is made once, and a
    lost executor costs no more than its own tasks."""
    path = f"{shared_folder(df.sparkSession)}/loamline/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables from the first size up to the second are dealt out to all cores.
SPREAD_BYTES = (1 << 20, 64 << 20)


def spread(df: DataFrame) -> DataFrame:
    """A table that is small but no trifle, dealt out to all cores, since such a table is often a single file of one row group,
    which one task would work through. Larger tables have splits enough and are read as they are. The rows stay the same."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if SPREAD_BYTES[0] <= size <= SPREAD_BYTES[1] and cores > 1 else df
