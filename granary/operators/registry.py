"""Stages and tokenizers by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dedup, gates

Stage = Callable[..., DataFrame]

_stages: dict[str, Stage] = {
    "license_gate": gates.license_gate,
    "sanitize": gates.sanitize,
    "unicode_normalize": gates.unicode_normalize,
    "exact_dedup": dedup.exact_dedup,
    "quality_gate": gates.quality_gate,
    "pii_gate": gates.pii_gate,
    "pii_policy_gate": gates.pii_policy_gate,
    "curriculum_eligibility": gates.curriculum_eligibility,
    "near_dup_minhash": dedup.near_dup_minhash,
    "semantic_simhash": gates.semantic_simhash,
    "tokenize": gates.tokenize,
    "domain_tagging": gates.domain_tagging,
    "global_dedup": dedup.global_dedup,
}
#: The order in which stages are meant to run; others run as listed, with a warning.
CANONICAL = ["license_gate", "sanitize", "unicode_normalize", "exact_dedup", "near_dup_minhash", "semantic_simhash", "global_dedup", "quality_gate", "domain_tagging", "pii_policy_gate", "curriculum_eligibility", "tokenize"]

_tokenizers: dict[str, Callable[[Column], Column]] = {"words": gates.tokens_of, "white": lambda c: F.filter(F.split(c, r"\s+"), lambda x: x != "")}


def register_stage(name: str, stage: Stage) -> None:
    if name in _stages:
        raise ValueError(f"stage {name} is registered already")
    _stages[name] = stage


def register_transform(name: str, function: Callable[[str], str]) -> None:
    """A Python function on texts as a stage. A document for which it raises is rejected as RUNTIME_ERROR, once, with the error; the others go on."""
    register_stage(name, lambda df, idx: gates.python_stage(df, idx, name, function))


def unregister_stage(name: str) -> None:
    _stages.pop(name, None)


def get_stage(name: str) -> Stage:
    if name not in _stages:
        raise ValueError(f"unknown stage {name}; there are {', '.join(sorted(_stages))}")
    return _stages[name]


def list_stages() -> list[str]:
    return sorted(_stages)


def register_tokenizer(name: str, encode: Callable[[Column], Column]) -> None:
    """encode: a text column to an array of tokens or ids, as built-in functions or an Arrow UDF."""
    if name in _tokenizers:
        raise ValueError(f"tokenizer {name} is registered already")
    _tokenizers[name] = encode


def get_tokenizer(name: str | None) -> Callable[[Column], Column] | None:
    return _tokenizers.get(name)


def out_of_order(names: list[str]) -> list[tuple[str, str]]:
    """Neighbours in the list that the canonical order has the other way round."""
    at = {n: i for i, n in enumerate(CANONICAL)}
    known = [n for n in names if n in at]
    return [(a, b) for a, b in zip(known, known[1:], strict=False) if at[a] > at[b]]
