"""What several operators of this subpackage share: the shared folder, slices of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; the folder may lie in a store that only Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder's URI below spark.checkpoint.dir, which driver and executors share.

    Only where the setting is absent in local mode (tests) a folder of this machine is set; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        base = f"file:///tmp/granary-checkpoints-{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/granary-{uuid.uuid4().hex}"


def written(df: DataFrame, spark: SparkSession, keep: list[str] | None = None) -> DataFrame:
    """df as a table in the shared folder: its lineage is cut and its files outlive executors."""
    path = shared_dir(spark)
    df.write.parquet(path)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_anew(grouped: DataFrame, *keys: str) -> DataFrame:
    """An aggregate's rows behind a shuffle of their own. A join on its keys would else take over the aggregate's partitions,
    and adaptive execution could not split those of a key that very many rows of the other side have."""
    return grouped.repartition(F.xxhash64(*keys))


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders that written() has made."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def swept(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that are over: it does so once the driver's JVM has collected what refers to them, which
    a driver with memory to spare puts off for long. What the last step made is let go by the first collection and found by the second, a moment later."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.2)
    spark.sparkContext._jvm.System.gc()


def released() -> None:
    """Gives back to the system what the allocators of a Python worker keep for later; the worker outlives its task, beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, mb: float = 8) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of at most so many rows and about so many MB (one row at least). At their end memory is released."""
    for b in batches:
        at = 0
        each = max(1, b.nbytes // max(1, b.num_rows))
        step = max(1, min(rows, int(mb * 1e6 / each)))
        while at < b.num_rows:
            yield b.slice(at, step)
            at += step
    released()
