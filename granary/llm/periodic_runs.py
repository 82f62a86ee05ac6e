"""Periodic runs of words by harmonic grid probing.

A run of period p and at least 4 * p words has at least three multiples of p among the places whose word equals the one p further on. So for each
period only the words at 0, p, 2p, ... are compared (n / p of them; n log n over all periods), and only where three neighbours agree are the
places around them compared, in chunks of growing size, until both ends are known. Grid points within a run whose period divides p are
skipped: a longer run of period p over them would be that run. Periods ascend, so each run is found at its smallest one.

The texts of a slice are probed together: their word numbers lie one after another, a number of its own behind each text, which no run crosses.
Texts of like length share a slice's pass, so that short texts are not probed for the periods of long ones. Nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: The contract's words: anything but the blank and the controls 9 to 13.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
REPEATS, LEAST = 4, 6


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, compared in chunks that double."""
    at, size = 0, 32
    while at < len(a):
        differ = a[at : at + size] != b[at : at + size]
        if differ.any():
            return at + int(differ.argmax())
        at, size = at + size, min(2 * size, 1 << 16)
    return len(a)


def runs_of(w: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run in a sequence of numbers, ordered by start and period.

    A run has its smallest period, at least 4 periods and 6 elements. longest: no run has more elements than this.
    """
    n = len(w) if longest is None else min(longest, len(w))
    found: list[tuple[int, int, int]] = []  # start, end, period
    for p in range(1, n // REPEATS + 1):
        grid = w[::p]
        same = grid[:-1] == grid[1:]
        hit = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if not len(hit):
            continue
        hit = hit * p
        cover = sorted((s, e) for s, e, q in found if p % q == 0 and e - s > p)
        starts = [s for s, _ in cover]
        k, new = 0, []
        while k < len(hit):
            at = int(hit[k])
            c = bisect_right(starts, at) - 1
            if c >= 0 and at + p < cover[c][1]:
                # both words lie within a run whose period divides p
                k = int(np.searchsorted(hit, cover[c][1] - p))
                continue
            right = at + _reach(w[at:-p], w[at + p :])
            left = at - _reach(w[:at][::-1], w[p : at + p][::-1])
            if right + p - left >= max(LEAST, REPEATS * p):
                new.append((left, right + p, p))
            k = int(np.searchsorted(hit, max(right, at + 1)))
        found += new
    return sorted((s, e - s, p) for s, e, p in found)


def _numbered(texts: list[str | None]) -> tuple[list[list[str]], list[np.ndarray]]:
    """Each text's words and their numbers, equal for equal words of the slice."""
    words = [WORD.findall(t or "") for t in texts]
    flat = pa.chunked_array([pa.array(x, pa.large_string()) for x in words] or [pa.array([], pa.large_string())]).combine_chunks()
    ids = pc.dictionary_encode(flat).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.cumsum([0] + [len(x) for x in words])
    return words, [ids[cuts[i] : cuts[i + 1]] for i in range(len(words))]


def _all_runs(ids: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, those of like length probed together."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in ids]
    classes: dict[int, list[int]] = {}
    for i, w in enumerate(ids):
        if len(w) >= LEAST:
            classes.setdefault(len(w).bit_length(), []).append(i)
    for members in classes.values():
        parts, starts, at = [], [], 0
        for k, i in enumerate(members):
            parts += [ids[i], np.array([-1 - k])]
            starts.append(at)
            at += len(ids[i]) + 1
        for s, n, p in runs_of(np.concatenate(parts), max(len(ids[i]) for i in members)):
            k = bisect_right(starts, s) - 1
            out[members[k]].append((s - starts[k], n, p))
    return out


def _collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run has behind its first period, joined by blanks."""
    if not runs:
        return " ".join(words)
    keep = np.ones(len(words), bool)
    for s, n, p in runs:
        keep[s + p : s + n] = False
    return " ".join(compress(words, keep.tolist()))


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words (long), runs (every run by start, then period) and collapsed (the text without repeats).

    A run is a stretch of words that repeats with a smallest period q, at least four times and over six words, and that no neighbour extends.
    Null and empty texts, and texts of white space, have no words, no runs and an empty collapsed text; texts of any length are one row's
    work. Repeated rows give repeated rows, an empty table an empty one. Columns of docs with these three names are replaced, others kept.
    """
    rest = docs.drop("n_words", "runs", "collapsed")
    kept = [c for c in rest.columns]
    # the columns travel as they are, under numbers, so that no name clashes
    rows = rest.toDF(*[f"c{i}" for i in range(len(kept))]).withColumn("t", F.col(f"c{kept.index(text)}").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("t").schema) + f", n_words bigint, runs {RUNS}, collapsed string"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words, ids = _numbered(b.column(b.num_columns - 1).to_pylist())
            found = _all_runs(ids)
            made = [
                pa.array([len(x) for x in words], pa.int64()),
                pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found], kind),
                pa.array([_collapsed(x, r) for x, r in zip(words, found, strict=True)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], [*b.schema.names[:-1], "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema).toDF(*kept, "n_words", "runs", "collapsed")


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) in which the texts of every tenth key (by its crc32 h) repeat: with g = h / 10, each word i >= a becomes word
    a + (i - a) % p of the text's n, a = g % n, p = 1 + (n - a) / (3 + g % 8). Null keys count as the empty string."""
    h = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.when(h % 10 == 0, F.floor(h / 10)).cast("long").alias("g"))
    words = F.regexp_extract_all(F.coalesce("t", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = rows.withColumn("w", F.when(F.col("g").isNotNull(), words)).withColumn("a", F.when(F.size("w") > 0, F.col("g") % F.size("w")))
    rows = rows.withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    a, p = F.col("a"), F.col("p")
    moved = F.transform("w", lambda w, i: F.when(i < a, w).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return rows.select(F.col("k").alias(key), F.when(a.isNotNull(), F.array_join(moved, " ")).otherwise(F.col("t")).alias(text))
