"""Packing by the sum-of-squares rule: few sequences, little padding, no document cut without need.

Documents become pieces of at most `capacity` tokens (only longer ones are cut). A piece goes to the
open sequence whose choice makes the sum of squares of N(g) smallest, N(g) being how many open
sequences have a gap of g tokens; when none has room, a new sequence opens. Pieces come longest first,
which lets the rule fill all but the last few sequences to the brim.

The rule needs one list of gaps, so pieces are dealt into groups of GROUP at random and each group is
packed by one task; a group wastes a sequence or so (below 0.1 %), whatever the size of the corpus. Only
lengths move between machines, never texts or ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written
from .tokenizing import encoder

GROUP = 8192
TAKEN = np.int64(1) << 62


class SumOfSquares:
    """Places pieces one by one; memory is bounded by the sequences that are open."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity, np.int64)  # open sequences by gap, from 0 (closed, never counted)
        self.open: list[list[int]] = [[] for _ in range(capacity)]
        self.sequences = 0

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        c, n = self.capacity, self.count
        if not 0 < length <= c:
            raise ValueError(f"a piece has 1 to {c} tokens, not {length}")
        if length < c:
            # from gap g to gap g - length the sum changes by 2 (N(g - length) - N(g) + 1), or 1 - 2 N(g) when it closes
            change = np.where(n[length:] > 0, 2 * (n[: c - length] - n[length:] + 1), TAKEN)
            if n[length]:
                change[0] = 1 - 2 * n[length]
            at = int(change.argmin())
            if change[at] < TAKEN:
                gap = length + at
                sequence = self.open[gap].pop()
                n[gap] -= 1
                self._leave(sequence, at)
                return sequence, c - gap
        sequence = self.sequences
        self.sequences += 1
        self._leave(sequence, c - length)
        return sequence, 0

    def _leave(self, sequence: int, gap: int) -> None:
        if gap:
            self.open[gap].append(sequence)
            self.count[gap] += 1


def pack(lengths: Iterable[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece, in the order given; pieces are placed longest first."""
    lengths = list(lengths)
    found: list = [None] * len(lengths)
    packer = SumOfSquares(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found[i] = packer.place(lengths[i])
    return found


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int, key: str = "doc_id", text: str = "text", end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for each piece; the end id closes each document, so a null or empty text has one token."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer)
        for b in slices(batches, 8192, 4):
            ids, counts = e.ids(b.column(1).to_pylist(), end)
            ids = ids.astype("<u4")
            cuts = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), cuts)
            piece = np.arange(len(doc)) - (np.cumsum(cuts) - cuts)[doc]
            start = piece * capacity
            length = np.minimum(capacity, counts[doc] - start)
            at = (np.cumsum(counts) - counts)[doc] + start
            crc = [zlib.crc32(ids[a:z]) for a, z in zip(at.tolist(), (at + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")).mapInArrow(cut, PIECES)


def pack_pieces(pieces: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """pieces (a table that was written; its `length` is 1 to capacity) with sequence_id and offset.

    A sequence's pieces follow each other without gaps from offset 0. Columns with these names are replaced; an empty table
    gives an empty result.
    """
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*[F.col(f"`{c}`") for c in names])
    groups = max(1, -(-pieces.count() // group))
    # positions in a written table are the same at each reading, also for rows that repeat
    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    order = dealt.repartition("__group").sortWithinPartitions("__group", F.col("length").desc(), *[f"`{c}`" for c in names if c != "length"])
    at, last = names.index("length"), len(names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, now = None, None
        for b in batches:
            sequence, offset = [], []
            for length, g in zip(b.column(at).to_pylist(), b.column(last).to_pylist(), strict=True):
                if packer is None or g != now:
                    packer, now = SumOfSquares(capacity), g
                s, o = packer.place(length)
                sequence.append((g << 32) + s)
                offset.append(o)
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*names, "sequence_id", "offset"])

    return spark.createDataFrame([], schema) if not names else order.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenises, cuts and packs documents: a row for each piece. The pieces (without ids) are written to the shared folder once.

    A null or empty text is one piece of one token; a very long one is encoded whole and cut. Rows that repeat a key or a whole document
    are packed each by itself, and pieces of equal length have no set order. Keys are whole numbers or null. Other columns are not read,
    whatever their names. An empty table gives an empty result.
    """
    return pack_pieces(written(document_pieces(docs, tokenizer, capacity, key, text), docs.sparkSession), capacity)
