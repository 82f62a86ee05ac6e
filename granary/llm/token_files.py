"""Flat token files: ids as unsigned integers, 64-bit document offsets beside them.

A folder holds, for each partition p in the order of the keys, three files without headers, little-endian:

    p.ids       the ids of its documents one after another, 16 or 32 bits each
    p.offsets   documents + 1 unsigned 64-bit numbers: where each document starts in p.ids, in ids
    p.keys      the documents' keys, signed 64-bit, rising; a null key is the smallest number

and index.json, which gives each partition's count of documents and ids and its base: the ids of all documents
before it, a prefix sum over the partitions. A reader maps the files and finds a document by two offsets.

Tasks write to a name of their own and rename, so one that is run again leaves the same files.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices
from .tokenizing import encoder

NULL_KEY = -(1 << 63)
#: Documents that one reading step takes.
BLOCK = 16_384


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def mapped(fs: pafs.FileSystem, path: str, dtype: np.dtype, start: int, count: int) -> np.ndarray:
    """`count` numbers of a file from number `start`: memory-mapped if the file is local, else read in that range."""
    if count == 0:
        return np.empty(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r", start * dtype.itemsize, (count,))
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_at(count * dtype.itemsize, start * dtype.itemsize), dtype)


def write_tokens(docs: DataFrame, uri: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int | None = 0) -> list[dict]:
    """Writes the folder and returns its partitions; the driver gets three numbers for each.

    Null texts are empty and hold the end id alone. Documents that share a key stay apart, in an order by content; keys are
    whole numbers, null ones come first. A very long text is encoded whole, in a batch of its own. Other columns are not read, whatever their names.
    An empty table writes an index without partitions.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    order = rows.repartitionByRange("key").sortWithinPartitions("key", F.crc32(F.col("text").cast("binary")), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, (fs, folder) = encoder(tokenizer), opened(uri)
        context = TaskContext.get()
        part = context.partitionId()
        names = {k: f"{folder}/{part:06d}.{k}" for k in ("ids", "offsets", "keys")}
        files = None
        docs_n = tokens = 0
        for b in slices(batches, 8192, 4):
            if files is None:
                fs.create_dir(folder, recursive=True)
                files = {k: fs.open_output_stream(f"{n}.{context.taskAttemptId()}") for k, n in names.items()}
                files["offsets"].write(np.zeros(1, "<u8").tobytes())
            ids, counts = e.ids(b.column(1).to_pylist(), end)
            files["ids"].write(ids.tobytes())
            files["offsets"].write((np.cumsum(counts) + tokens).astype("<u8").tobytes())
            files["keys"].write(np.array([NULL_KEY if k is None else k for k in b.column(0).to_pylist()], "<i8").tobytes())
            docs_n, tokens = docs_n + len(counts), tokens + len(ids)
        if files is not None:
            for k, f in files.items():
                f.close()
                fs.move(f"{names[k]}.{context.taskAttemptId()}", names[k])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([docs_n], pa.int64()), pa.array([tokens], pa.int64()), pa.array([e.dtype.str])], ["part", "docs", "tokens", "dtype"])

    parts = sorted(map(tuple, order.mapInArrow(write, "part int, docs long, tokens long, dtype string").collect()))
    bases = np.cumsum([0] + [p[2] for p in parts]).tolist()
    index = [{"part": p, "docs": d, "tokens": t, "dtype": kind, "base": base} for (p, d, t, kind), base in zip(parts, bases, strict=False)]
    fs, folder = opened(uri)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/index.json") as f:
        f.write(json.dumps(index).encode())
    return index


def read_index(uri: str) -> list[dict]:
    fs, folder = opened(uri)
    with fs.open_input_file(f"{folder}/index.json") as f:
        return json.loads(f.read())


def read_documents(spark: SparkSession, uri: str, key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """A row for each document of the files: key, start (ids before it in all files), n_tokens, ids_crc32 and ids (binary, 32 bits each)."""
    steps = [(p["part"], p["base"], p["dtype"], at, min(block, p["docs"] - at), p["docs"]) for p in read_index(uri) for at in range(0, p["docs"], block)]
    plan = spark.createDataFrame(steps, "part int, base long, dtype string, at long, n long, docs long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = opened(uri)
        for b in batches:
            for part, base, kind, at, n, _ in zip(*(c.to_pylist() for c in b.columns), strict=True):
                name = f"{folder}/{part:06d}"
                offsets = np.array(mapped(fs, f"{name}.offsets", np.dtype("<u8"), at, n + 1)).astype(np.int64)
                keys = np.array(mapped(fs, f"{name}.keys", np.dtype("<i8"), at, n))
                for i in range(0, n, 512):
                    o = offsets[i : i + 513]
                    ids = mapped(fs, f"{name}.ids", np.dtype(kind), int(o[0]), int(o[-1] - o[0])).astype("<u4")
                    docs = [ids[s:t].tobytes() for s, t in zip(o - o[0], o[1:] - o[0], strict=False)]
                    k = keys[i : i + 512]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k, pa.int64(), mask=k == NULL_KEY), pa.array(o[:-1] + base), pa.array(np.diff(o)), pa.array([zlib.crc32(d) for d in docs], pa.int64()), pa.array(docs, pa.binary())],
                        [key, "start", "n_tokens", "ids_crc32", "ids"],
                    )

    return plan.mapInArrow(read, f"`{key}` long, start long, n_tokens long, ids_crc32 long, ids binary")
