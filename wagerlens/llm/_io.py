"""Shared folder, staging and Arrow helpers of the corpus operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch: shuffle files go when the execution that made them ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only on one machine (a local master, as in tests) a temporary folder is made where
    the session names none; a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        named = "file://" + tempfile.mkdtemp(prefix="wagerlens-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


#: Bytes of an Arrow batch and rows of a column batch of the scan, where the session has Spark's defaults.
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b"), "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512")}


def small_batches(spark: SparkSession) -> None:
    """Batches for rows that hold whole texts: both sides of a Python worker keep a batch or
    two in memory, and a scan keeps a vector of texts. Settings of the user's own stay."""
    for name, (default, small) in _BATCHES.items():
        if spark.conf.get(name) in (default, default.rstrip("b")):
            spark.conf.set(name, small)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/wagerlens/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a reader of it.

    Cuts the lineage: a lost executor costs a re-read, not a re-computation. The plan's
    shuffle files are dropped when it is written; nothing else can read them.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


_held: dict = {}


def held(key, make):
    """One encoder per worker process: another one takes its place."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def trim() -> None:
    """Give memory that a task is done with back to the system: workers are reused, or idle."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_column(df: DataFrame, name: str = "text"):
    """The column ``name`` as string, also where the table holds bytes."""
    return df[name].cast("string")


def slices(batch, column: int, budget: int):
    """Slices of an Arrow batch whose strings in ``column`` take about ``budget`` bytes.

    A longer string is a slice of its own, so memory follows the budget and the longest text.
    """
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    lo = 0
    while lo < len(sizes):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), budget, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... in the given order, by range partitions and their totals.

    The partitions are written once, so that their bounds stay what they are.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = stage(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()), "numbered")
    within = Window.partitionBy("__part").orderBy(*order)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbers = ranged.withColumn("__row", F.row_number().over(within) - 1).join(F.broadcast(totals), "__part")
    return stage(numbers.withColumn(name, (F.col("__row") + F.col("__before")).cast("long")).drop("__part", "__row", "__before"), "numbered")
