"""Folders of the session's shared store: checkpoints, intermediate tables, small files with atomic replacement."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpointing(spark: SparkSession) -> str:
    """Sets the checkpoint folder to the one that spark.checkpoint.dir names; only in local mode (tests) may one of this machine stand in."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not folder and not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    folder = folder or f"file:///tmp/granary-checkpoints-{os.getuid()}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str = "granary") -> str:
    """The name of a folder that does not exist yet."""
    return f"{checkpointing(spark)}/{name}-{uuid.uuid4().hex}"


def put(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """df as a table of the shared folder: computed once, its lineage cut, its files safe from lost executors."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, *paths: str) -> bool:
    """Deletes folders or files with all they hold; whether there was any."""
    gone = False
    for path in paths:
        fs, p = _fs(spark, path)
        gone |= bool(fs.delete(p, True))
    return gone


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time in ms) of what a folder holds, by name; nothing if there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of all files below a folder; 0 if there is none."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """One small JSON file, written beside its place and renamed."""
    part = f"{path}.{uuid.uuid4().hex[:8]}.part"
    fs, p = _fs(spark, part)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(value, indent=2, ensure_ascii=False, default=str).encode()))
    out.close()
    _, target = _fs(spark, path)
    if not fs.rename(p, target):
        fs.delete(target, False)
        if not fs.rename(p, target):
            raise OSError(f"cannot write {path}")


def read_json(spark: SparkSession, path: str) -> object | None:
    """What write_json() wrote; None if there is no such file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])
