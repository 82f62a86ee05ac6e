"""Digests and signatures of texts."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .text import once

#: Of the placeholder identifier: characters of the raw text that it covers.
PLACEHOLDER_CHARS = 512
#: Bits of a SimHash: 15 hexadecimal digits of a word's md5.
SIMHASH_BITS = 60
SIMHASH_WORDS = 2000
ASCII_WORD, WORD = r"[A-Za-z0-9_]{2,}", r"\w{2,}"


def sha256(c: Column) -> Column:
    """32 bytes."""
    return F.unhex(F.sha2(c.cast("binary"), 256))


def placeholder_id(c: Column) -> Column:
    return sha256(F.substring(c, 1, PLACEHOLDER_CHARS))


def dup_group_id(digest: Column) -> Column:
    """The digest's first 8 bytes as a signed number; all 64 bits are kept."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def dup_group_unsigned(digest: Column) -> Column:
    """The same bytes as an unsigned number."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, 10).cast("decimal(20,0)")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def simhash(c: Column, ascii_words: bool = False, limit: int | None = SIMHASH_WORDS) -> Column:
    """Each bit is the majority over a text's words (lower case, with multiplicity) of that bit of their hashes; ties are 0.

    Hashes are stable across processes. A text without words has no signature: null, which matches nothing.
    """
    pattern = re.compile(ASCII_WORD if ascii_words else WORD)

    @F.arrow_udf(LongType())
    def run(texts: pa.Array) -> pa.Array:
        seen: dict[str, int] = {}

        def hashed(w: str) -> int:
            if len(seen) > 200_000:
                seen.clear()
            if (h := seen.get(w)) is None:
                h = seen[w] = int(hashlib.md5(w.encode()).hexdigest()[:15], 16)
            return h

        bits = np.arange(SIMHASH_BITS, dtype=np.int64)

        def one(t: str | None) -> int | None:
            words = pattern.findall((t or "").lower())[:limit]
            if not words:
                return None
            h = np.array([hashed(w) for w in words], np.int64)
            votes = (h[:, None] >> bits & 1).sum(0) * 2 > len(h)
            return int((votes.astype(np.int64) << bits).sum())

        return pa.array([one(t) for t in texts.to_pylist()], pa.int64())

    return once(run)(c)


def gram_hashes(text: str, n: int = 5) -> np.ndarray:
    """64-bit hashes of a text's distinct n-grams, side by side; a text shorter than n is one gram."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    grams = points[: len(points) // n * n].reshape(-1, n) if len(points) >= n else points[None, :]
    h = np.full(len(grams), grams.shape[1] + 1, np.uint64)
    for j in range(grams.shape[1]):
        h = (h ^ grams[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def minhash_rows(permutations: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of the permutations h -> h * a + b modulo 2 ** 64."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, permutations, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 1 << 64, permutations, dtype=np.uint64)


def minhash(c: Column, n: int = 5, permutations: int = 128) -> Column:
    """MinHash of a text's character n-grams, side by side (a shorter text is one gram); null for null. Values have 63 bits."""
    a, b = minhash_rows(permutations)

    @F.arrow_udf(ArrayType(LongType()))
    def run(texts: pa.Array) -> pa.Array:
        def one(t: str | None):
            if t is None:
                return None
            h = gram_hashes(t, n)
            least = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
            for s in range(0, len(h), 1024):
                least = np.minimum(least, (h[s : s + 1024, None] * a + b).min(0))
            return (least >> np.uint64(1)).astype(np.int64)

        return pa.array([one(t.as_py()) for t in texts], pa.list_(pa.int64()))

    return once(run)(c)


def bands(threshold: float, permutations: int) -> tuple[int, int]:
    """(bands, rows) that make the sum of the areas of wrong candidates and missed pairs smallest (both weigh a half)."""
    s = (np.arange(1000) + 0.5) / 1000
    best = (np.inf, 1, 1)
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            p = 1 - (1 - s**r) ** b
            wrong = p[s < threshold].sum() + (1 - p[s >= threshold]).sum()
            best = min(best, (wrong, b, r))
    return best[1], best[2]


def band_hashes(signature: Column, number: int, rows: int) -> Column:
    """A hash of each band's rows."""
    return F.transform(F.sequence(F.lit(0), F.lit(number - 1)), lambda i: F.xxhash64(i, F.slice(signature, i * rows + 1, F.lit(rows))))
