"""Exact deduplication by Grace hashing.

Plan, in two rounds so that a text which a third of all rows carry never meets in one task:

1.  Each input partition removes its own repeats (`grace_groups`): a row for each distinct text
    and partition goes on, with the count and the best key of the rows that it stands for.
2.  Those are dealt out by a hash of the text, and every task runs `grace_groups` again.

`grace_groups` streams its rows into an open-addressing table that compares complete contents. When
the contents outgrow the memory limit, it partitions what it holds and all that follows into spill
files by other bits of the hash, and recurses into each file until it fits. Files live in the task's own temporary folder and
are gone when the task ends; a lost executor only loses tasks that Spark runs again.

Every document then gets its group by an equi-join on the digest of its text; both sides are plain
shuffles, whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

import hashlib
import pickle
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a table may hold before its rows go to spill files.
TABLE_BYTES = 48 << 20
#: Spill files of each level of recursion.
FANOUT = 16
#: After so many levels the hash has no bits left; what is left in a file is compared in memory.
LEVELS = 15


class ContentTable:
    """Open addressing with linear probing; a slot holds a group's number, groups compare by content."""

    def __init__(self, slots: int = 1024):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.rows: list[list] = []  # content, best key, count
        self.bytes = 0

    def add(self, h: int, content: bytes, key, count: int) -> None:
        mask = len(self.slots) - 1
        at = h & mask
        while (g := self.slots[at]) >= 0:
            if self.hashes[g] == h and self.rows[g][0] == content:
                row = self.rows[g]
                if row[1] is None or key is not None and key > row[1]:
                    row[1] = key
                row[2] += count
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.rows)
        self.hashes.append(h)
        self.rows.append([content, key, count])
        self.bytes += len(content) + 200
        if 2 * len(self.rows) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for g, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = g


def content_hash(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little")


def grace_groups(
    rows: Iterator[tuple], limit: int = TABLE_BYTES, level: int = 0, hash_of: Callable[[bytes], int] = content_hash
) -> Iterator[tuple]:
    """(content, key, count) rows to one (content, largest key, sum of counts) for each distinct content.

    A null key is smaller than all others. Memory stays near `limit` plus one row; once the table is
    full, its groups and all later rows are partitioned into FANOUT files by four bits of the hash that this
    level alone uses, and each file is read back through a table of its own.
    """
    table, files, folder = ContentTable(), [], None
    # the table's own address takes the low bits; levels take four bits each, from the top
    part = lambda h: (h >> (60 - 4 * level)) & (FANOUT - 1)
    try:
        for content, key, count in rows:
            h = hash_of(content)
            if files:
                pickle.dump((content, key, count), files[part(h)], 5)
                continue
            table.add(h, content, key, count)
            if table.bytes > limit and len(table.rows) > 1 and level < LEVELS:
                folder = tempfile.mkdtemp(prefix="grace-")
                files = [open(f"{folder}/{i}", "w+b") for i in range(FANOUT)]  # noqa: SIM115
                for g, row in zip(table.hashes, table.rows, strict=True):
                    pickle.dump(tuple(row), files[part(g)], 5)
                table = ContentTable()
        if not files:
            yield from map(tuple, table.rows)
            return
        for i, f in enumerate(files):
            f.seek(0)
            yield from grace_groups(_unpickled(f), limit, level + 1, hash_of)
            f.close()
            files[i] = None
            shutil.os.unlink(f"{folder}/{i}")
    finally:
        for f in files:
            if f is not None:
                f.close()
        if folder:
            shutil.rmtree(folder, ignore_errors=True)


def _unpickled(f) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


GROUPS = "content binary, best long, n long"


def _grouped(limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)

        out: list[tuple] = []
        size = 0
        for g in grace_groups(rows(), limit):
            out.append(g)
            size += len(g[0])
            if size > 8 << 20 or len(out) >= 4096:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    c, k, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()), pa.array(k, pa.int64()), pa.array(n, pa.int64())], ["content", "best", "n"])


def text_groups(docs: DataFrame, content: Column, key: Column, limit: int = TABLE_BYTES) -> DataFrame:
    """A row for each distinct content: content, best (the largest key, null if all are), n (rows)."""
    run = _grouped(limit)
    rows = docs.select(F.encode(F.coalesce(content, F.lit("")), "UTF-8").alias("content"), key.cast("long").alias("best"), F.lit(1).cast("long").alias("n"))
    return rows.mapInArrow(run, GROUPS).repartition(F.xxhash64("content")).mapInArrow(run, GROUPS)


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", normalised: Column | None = None, limit: int = TABLE_BYTES) -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256; no row is dropped.

    Texts are equal when their (normalised) characters are; null counts as empty. Of equal texts the row with
    the largest key stays; rows with a null key stay only if no row of the group has one, and rows
    that repeat the kept key (fully repeated rows) are all `kept`. Columns of docs with clashing names are replaced.
    An empty table gives an empty result. Keys are whole numbers or null. A very long text is held whole, beyond `limit` if need be.
    """
    content = F.coalesce(F.col(f"`{text}`") if normalised is None else normalised, F.lit(""))
    made = ["keep_id", "group_size", "kept", "text_sha256"]
    digest = F.sha2(content.cast("binary"), 256)
    groups = text_groups(docs, content, F.col(f"`{key}`"), limit).select(F.sha2("content", 256).alias("text_sha256"), F.col("best").alias("keep_id"), F.col("n").alias("group_size"))
    left = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], digest.alias("text_sha256"))
    return left.join(groups, "text_sha256").withColumn("kept", F.col(f"`{key}`").eqNullSafe(F.col("keep_id")))


def drop_exact(docs: DataFrame, text: str = "text", key: str = "doc_id", limit: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with the columns of docs, whatever their names; of fully repeated rows one stays.

    Rows are matched to the groups by key and digest, so that no join key is held by a group of copies. Null texts count as
    empty; keys are whole numbers, a null one stays only where a group has no other. An empty table gives an empty result.
    """
    best = lambda k: [F.coalesce(k, F.lit(0)).alias("key"), k.isNull().alias("none")]
    by = ["key", "none", "digest"]
    groups = text_groups(docs, F.col(f"`{text}`"), F.col(f"`{key}`"), limit).select(*best(F.col("best")), F.sha2("content", 256).alias("digest"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *best(F.col(f"`{key}`").cast("long")), F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256).alias("digest"))
    return rows.join(groups, by, "left_semi").dropDuplicates(by).select("row.*")
