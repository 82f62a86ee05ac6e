"""Personal data: detectors, signals and redaction."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

# The detectors' patterns and confidences, in the order of registration.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = r"(?<!\d)(?:\+?\d{1,3}[\s-]?)?(?:\d[\s-]?){9,12}(?!\d)"
AADHAAR = r"(?<!\d)(?:\d{4}[\s-]?){2}\d{4}(?!\d)"


@dataclass(frozen=True)
class Detector:
    kind: str
    pattern: str
    confidence: float


_detectors: dict[str, Detector] = {}


def register_detector(detector: Detector) -> None:
    """Adds a detector; a kind that is known stays as it is."""
    _detectors.setdefault(detector.kind, detector)


def detectors() -> list[Detector]:
    return list(_detectors.values())


for _d in (Detector("email", EMAIL, 0.99), Detector("phone", PHONE, 0.85), Detector("aadhaar", AADHAAR, 0.95)):
    register_detector(_d)


def java(pattern: str) -> str:
    r"""A pattern for Java with Python's classes: \d and \s know all of Unicode."""
    return "(?U)" + pattern.replace(r"[\s-]", r"[\s\x1c-\x1f-]")


def has(c: Column, kind: str) -> Column:
    return c.rlike(java(_detectors[kind].pattern))


def kinds(c: Column, threshold: float) -> Column:
    """The distinct kinds found with at least that confidence, in alphabetical order."""
    found = [F.when(c.rlike(java(d.pattern)), F.lit(d.kind)) for d in detectors() if d.confidence >= threshold]
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_compact(F.array(*found))) if found else none


def first_kind(c: Column, threshold: float, wanted: list[str]) -> Column:
    """The first kind, in the order of registration, that is found and wanted; null if there is none."""
    found = [F.when(c.rlike(java(d.pattern)), F.lit(d.kind)) for d in detectors() if d.confidence >= threshold and d.kind in wanted]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def signals_of(text: str, found: list[Detector]) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, confidence) of all matches, detector by detector."""
    return [(d.kind, *m.span(), d.confidence) for d in found for m in re.finditer(d.pattern, text)]


SIGNALS = "array<struct<kind:string,start:int,end:int,confidence:double>>"


def signals(c: Column) -> Column:
    """Spans of all matches as an array of structs."""
    found = detectors()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("confidence", pa.float64())]))

    @F.arrow_udf(SIGNALS)
    def run(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "confidence")
        return pa.array([[dict(zip(names, s, strict=True)) for s in signals_of(t or "", found)] for t in texts.to_pylist()], kind)

    return once(run)(c)


def redacted(text: str, spans: list[tuple[str, int, int, float]], mask: Callable[[str], str] = lambda kind: f"<PII:{kind.upper()}>") -> str:
    """The text with spans masked. Of overlapping spans the most confident gives the mask for all that they cover (the first of equals)."""
    merged: list[list] = []
    for kind, start, end, confidence in sorted(spans, key=lambda s: (s[1], s[2])):
        if merged and start < merged[-1][2]:
            last = merged[-1]
            last[2] = max(last[2], end)
            if confidence > last[3]:
                last[0], last[3] = kind, confidence
        else:
            merged.append([kind, start, end, confidence])
    parts, at = [], 0
    for kind, start, end, _ in merged:
        parts += [text[at:start], mask(kind)]
        at = end
    return "".join([*parts, text[at:]])


def redact(c: Column, threshold: float, wanted: list[str] | None = None) -> Column:
    """Matches of the wanted kinds (empty or None: all) masked. Texts without any do not go to Python."""
    found = [d for d in detectors() if d.confidence >= threshold and (not wanted or d.kind in wanted)]
    if not found:
        return c
    if len(found) == 1:
        return F.regexp_replace(c, java(found[0].pattern), f"<PII:{found[0].kind.upper()}>")

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else redacted(t, signals_of(t, found)) for t in texts.to_pylist()], pa.string())

    hit = c.rlike(java("|".join(f"(?:{d.pattern})" for d in found)))
    return F.coalesce(once(run)(F.when(hit, c)), c)
