"""Scalar text functions as Column expressions; Python runs only where Spark has no function."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: White space as Python's regular expressions know it; Java's Unicode class lacks the four separators.
WHITE = r"(?U)[\s\x1c-\x1f]+"
TAG = r"<[^>]+>"


def once(function: Callable) -> Callable:
    """A Python function that the optimiser keeps in its place. It would otherwise copy the call into a filter on the result, and run it twice for every row."""
    return function.asNondeterministic()


def collapse_white(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, WHITE, " "))


def sanitize(c: Column) -> Column:
    """Tags become a space, white space is collapsed."""
    return collapse_white(F.regexp_replace(c, TAG, " "))


@F.arrow_udf(StringType())
def _nfc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


def nfc(c: Column) -> Column:
    """Unicode NFC. ASCII texts, which it never changes, do not go to Python."""
    return F.coalesce(once(_nfc)(F.when(c.rlike(r"[^\x00-\x7f]"), c)), c)


@F.arrow_udf(DoubleType())
def _entropy(texts: pa.Array) -> pa.Array:
    def one(t: str | None) -> float | None:
        if not t:
            return None if t is None else 0.0
        n = np.unique(np.frombuffer(t.encode("utf-32-le"), np.uint32), return_counts=True)[1]
        return float(np.log2(len(t)) - (n * np.log2(n)).sum() / len(t)) + 0.0

    return pa.array([one(t) for t in texts.to_pylist()], pa.float64())


def char_entropy(c: Column) -> Column:
    """Shannon entropy of the characters in bits; 0 for an empty text, null for null."""
    return once(_entropy)(c)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once; an expression inside a lambda is otherwise computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeats(order: Column, once: bool) -> Column:
    """How many elements of a sorted array have no equal neighbour (once), or have one."""
    twice = lambda a: F.filter(a, lambda g, i: F.coalesce(g == F.get(a, i - 1), F.lit(False)) | F.coalesce(g == F.get(a, i + 1), F.lit(False)))
    return let(order, lambda a: F.size(a) - F.size(twice(a)) if once else F.size(twice(a)))


def repeat_ratio(c: Column, n: int = 10, chars: int = 5000) -> Column:
    """Of the n-character grams side by side in the first `chars` characters, the share whose gram occurs more than once."""
    t = F.substring(c, 1, chars)
    grams = let(t, lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.length(x) - n, F.lit(0)), F.lit(n)), lambda i: F.substring(x, i + 1, F.lit(n))))
    return F.when(F.length(t) < 2 * n, 0.0).otherwise(let(F.array_sort(grams), lambda o: repeats(o, once=False) / F.size(o)))


def chunks(c: Column, size: int = 512, overlap: int = 0) -> Column:
    """Windows of `size` characters of the text with white space collapsed; none for an empty text, all of it if size <= 0."""
    if size > 0 and not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    none = F.array().cast("array<string>")
    if size <= 0:
        return let(collapse_white(c), lambda t: F.when(F.length(t) > 0, F.array(t)).otherwise(none))
    cut = lambda t: F.transform(F.sequence(F.lit(0), F.length(t) - 1, F.lit(size - overlap)), lambda i: F.substring(t, i + 1, F.lit(size)))
    return let(collapse_white(c), lambda t: F.when(F.length(t) > 0, cut(t)).otherwise(none))


def path_segment(c: Column) -> Column:
    """A safe folder name: lower case, white space and slashes as _, "unknown" for nothing."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"(?U)[\s/\\]+", "_")
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit("unknown")).otherwise(s)


def language(c: Column, default: str = "en") -> Column:
    """Two letters in lower case; the default for shorter or missing values."""
    return F.when(F.length(c) >= 2, F.lower(F.substring(c, 1, 2))).otherwise(F.lit(default))


def slashes(c: Column) -> Column:
    """Paths with forward slashes."""
    return F.replace(c, F.lit("\\"), F.lit("/"))


def clamp_long(c: Column) -> Column:
    """A decimal or double as a 64-bit integer, at the borders if it lies beyond."""
    return F.greatest(F.least(c.cast("decimal(38,0)"), F.lit((1 << 63) - 1).cast("decimal(38,0)")), F.lit(-(1 << 63)).cast("decimal(38,0)")).cast("long")
