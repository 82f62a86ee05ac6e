"""Row operators: gates that reject and transforms that annotate.

A stage takes and returns a DataFrame of documents. Rejected rows stay, with `rejection` (stage, position, reason,
detail) set by the first stage that rejected them; a null rejection means that the row is alive. Stages leave dead rows as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, pii, text

REJECTION = "struct<stage:string,stage_idx:int,reason_code:string,reason_detail:string>"

#: The default policies.
ALLOWED_LICENSES = ["CC0", "CC-BY", "CC-BY-SA", "CC-BY-NC", "Public-Domain"]
DISALLOWED_LICENSES = ["CC-NC", "CC-ND", "All-Rights-Reserved", "Proprietary", "Unknown"]
MIN_CHARS, MIN_ENTROPY, MAX_ENTROPY = 200, 3.5, 7.8
PII_MODE, PII_THRESHOLD = "redact", 0.9
DROP_KINDS, REDACT_KINDS = ["aadhaar"], ["email", "phone", "aadhaar"]
WINDOWS, MIN_TOKENS_RATIO, MAX_REPETITION = [4096, 16384, 65536, 262144], 0.9, 0.35
RISKY_WINDOW = 65536


@dataclass(frozen=True)
class LicensePolicy:
    allowed: list[str] = field(default_factory=lambda: list(ALLOWED_LICENSES))
    disallowed: list[str] = field(default_factory=lambda: list(DISALLOWED_LICENSES))


@dataclass(frozen=True)
class QualityPolicy:
    min_chars: int = MIN_CHARS
    min_entropy: float = MIN_ENTROPY
    max_entropy: float = MAX_ENTROPY


@dataclass(frozen=True)
class PiiPolicy:
    enabled: bool = True
    mode: str = PII_MODE
    threshold: float = PII_THRESHOLD
    drop_kinds: list[str] = field(default_factory=lambda: list(DROP_KINDS))
    redact_kinds: list[str] = field(default_factory=lambda: list(REDACT_KINDS))


@dataclass(frozen=True)
class CurriculumPolicy:
    windows: list[int] = field(default_factory=lambda: list(WINDOWS))
    min_tokens_ratio: float = MIN_TOKENS_RATIO
    max_repetition: float = MAX_REPETITION


def alive() -> Column:
    """Rows that no stage has rejected."""
    return F.col("rejection").isNull()


def rejecting(df: DataFrame, stage: str, idx: int, reason: Column, detail: Column | None = None) -> DataFrame:
    """Alive rows with a reason become rejected."""
    verdict = F.struct(F.lit(stage).alias("stage"), F.lit(idx).cast("int").alias("stage_idx"), reason.alias("reason_code"), (F.lit(None).cast("string") if detail is None else detail).alias("reason_detail"))
    return df.withColumn("rejection", F.when(alive() & reason.isNotNull(), verdict).otherwise(F.col("rejection")))


def marked(df: DataFrame, marker: Column | str) -> DataFrame:
    """Alive rows get a marker at the end of transform_chain; a null marker adds nothing."""
    m = F.lit(marker) if isinstance(marker, str) else marker
    return df.withColumn("transform_chain", F.when(alive() & m.isNotNull(), F.array_append("transform_chain", m)).otherwise(F.col("transform_chain")))


def changed(df: DataFrame, **values: Column) -> DataFrame:
    """Alive rows get new values."""
    return df.withColumns({k: F.when(alive(), v).otherwise(F.col(k)) for k, v in values.items()})


# -- decisions as columns -------------------------------------------------------------------------


def license_reason(license: Column, policy: LicensePolicy = LicensePolicy()) -> Column:
    """Null if the license passes. Matching is exact; an empty list of allowed ones allows all that are not disallowed."""
    out = F.when(license.isNull(), "LICENSE_UNKNOWN").when(license.isin(policy.disallowed), "LICENSE_DISALLOWED")
    return out.when(~license.isin(policy.allowed), "LICENSE_NOT_ALLOWED") if policy.allowed else out


def quality_reason(chars: Column, entropy: Column, policy: QualityPolicy = QualityPolicy()) -> Column:
    return F.when(chars < policy.min_chars, "TOO_SHORT").when(~entropy.between(policy.min_entropy, policy.max_entropy), "ENTROPY_OUT_OF_RANGE")


def rejection_category(code: Column) -> Column:
    """The folder of a rejection: duplicates, pii (licenses too), corrupt or low_quality."""
    c = F.upper(F.coalesce(code, F.lit("")))
    any_of = lambda *words: F.lit(False) if not words else F.expr("false") | c.rlike("|".join(words))
    return F.when(any_of("DUP"), "duplicates").when(any_of("PII", "LICENSE"), "pii").when(any_of("RUNTIME", "CORRUPT", "ERROR"), "corrupt").otherwise("low_quality")


# -- stages ---------------------------------------------------------------------------------------


def license_gate(df: DataFrame, idx: int, policy: LicensePolicy = LicensePolicy()) -> DataFrame:
    license = F.col("license")
    detail = F.when(license.isNull(), "missing license metadata").otherwise(F.concat(F.lit("license="), license))
    return marked(rejecting(df, "license_gate", idx, license_reason(license, policy), detail), "license_gate_v1")


def sanitize(df: DataFrame, idx: int) -> DataFrame:
    return marked(changed(df, text=text.sanitize(F.col("text"))), "sanitize_v1")


def unicode_normalize(df: DataFrame, idx: int, enabled: bool = True) -> DataFrame:
    if not enabled:
        return df
    with_new = df.withColumn("__nfc", text.nfc(F.when(alive(), F.col("text"))))
    marker = F.when(F.col("__nfc") == F.col("text"), "unicode_nfc_unchanged_v1").otherwise("unicode_nfc_normalized_v1")
    return changed(marked(with_new, marker), text=F.col("__nfc")).drop("__nfc")


def min_length(df: DataFrame, n: int) -> DataFrame:
    """Shorter texts go without a rejection, as at a source."""
    return df.where(F.length("text") >= n)


def pii_policy_gate(df: DataFrame, idx: int, policy: PiiPolicy = PiiPolicy()) -> DataFrame:
    """Modes: drop and redact reject texts with a kind to drop; redact masks the rest; allow only flags."""
    if not policy.enabled:
        return df
    t = F.col("text")
    found = pii.kinds(t, policy.threshold)
    df = changed(df, pii_flag=F.size(found) > 0, pii_types=found)
    any_found = F.coalesce(F.col("pii_flag"), F.lit(False))
    if policy.mode in ("drop", "redact"):
        kind = pii.first_kind(t, policy.threshold, policy.drop_kinds)
        df = rejecting(df, "pii_policy_gate", idx, F.concat(F.lit("PII_"), F.upper(kind)), F.lit("policy_drop"))
    df = marked(df, F.when(~any_found, "pii_none_v1").otherwise("pii_redacted_v1" if policy.mode == "redact" else "pii_allowed_v1"))
    if policy.mode == "redact":
        df = df.withColumn("text", F.coalesce(pii.redact(F.when(alive() & any_found, t), policy.threshold, policy.redact_kinds), t))
    return df


def pii_gate(df: DataFrame, idx: int, drop: bool = True) -> DataFrame:
    """The older gate: e-mail addresses only, dropped or flagged."""
    hit = pii.has(F.col("text"), "email")
    if drop:
        return marked(rejecting(df, "pii_gate", idx, F.when(hit, "PII_EMAIL"), F.lit("email detected")), "pii_gate_v1")
    return marked(changed(df, pii_flag=hit, pii_types=F.when(hit, F.array(F.lit("email"))).otherwise(F.array().cast("array<string>"))), "pii_gate_v1")


def quality_gate(df: DataFrame, idx: int, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Sets chars and bytes_utf8, and the entropy of texts that are long enough."""
    t = F.col("text")
    df = changed(df, chars=F.length(t).cast("long"), bytes_utf8=F.octet_length(t).cast("long"))
    df = df.withColumn("entropy", F.coalesce(text.char_entropy(F.when(alive() & (F.col("chars") >= policy.min_chars), t)), F.col("entropy")))
    chars, entropy = F.col("chars"), F.col("entropy")
    detail = F.when(chars < policy.min_chars, F.concat(F.lit("chars="), chars)).otherwise(F.format_string("entropy=%.3f", entropy))
    return marked(rejecting(df, "quality_gate", idx, quality_reason(chars, entropy, policy), detail), "quality_gate_v1")


def curriculum_eligibility(df: DataFrame, idx: int, policy: CurriculumPolicy = CurriculumPolicy()) -> DataFrame:
    """Marks the windows that a text fills, those that repetition makes risky, and the repetition ratio; rejects nothing."""
    df = df.withColumn("__ratio", text.repeat_ratio(F.when(alive(), F.col("text"))))
    ratio = F.col("__ratio")
    fits = F.array_compact(F.array(*[F.when(F.col("tokens") >= int(w * policy.min_tokens_ratio), F.lit(w)) for w in policy.windows]))
    risky = F.filter(fits, lambda w: (w >= RISKY_WINDOW) & (ratio > policy.max_repetition))
    named = lambda name, a: F.when(F.size(a) > 0, F.concat(F.lit(f"{name}="), F.array_join(a.cast("array<string>"), ",")))
    df = marked(marked(df, named("eligible_windows", fits)), named("risky_windows", risky))
    return marked(df, F.format_string("rep_ratio=%.3f", ratio)).drop("__ratio")


def tokens_of(c: Column) -> Column:
    """The built-in tokenizer: words and single other characters, without white space."""
    return F.regexp_extract_all(c, F.lit(r"(?U)(\w+|[^\w\s])"), 1)


def hapax_score(tokens: Column) -> Column:
    """1 - 0.2 * (types that occur once / types), null without tokens."""
    types = F.size(F.array_distinct(tokens))
    return F.when(types > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - text.repeats(F.array_sort(tokens), once=True) / types * 0.2)))


def tokenize(df: DataFrame, idx: int, tokenizer: str | None = "words") -> DataFrame:
    """Counts tokens with a registered tokenizer; one that is not registered leaves a marker only."""
    from .registry import get_tokenizer

    encode = get_tokenizer(tokenizer)
    if encode is None:
        return marked(df, "tokenize_skipped_no_adapter")
    ids = encode(F.when(alive(), F.col("text")))
    df = df.withColumn("__ids", ids)
    df = changed(df, tokens=F.size("__ids").cast("long"), quality_score=F.coalesce(hapax_score(F.col("__ids")), F.col("quality_score")))
    return marked(df.drop("__ids"), "tokenize_v1")


def semantic_simhash(df: DataFrame, idx: int, ascii_words: bool = False) -> DataFrame:
    """Marks the SimHash signature of the text's first words in hexadecimal digits."""
    df = df.withColumn("__sig", hashing.simhash(F.when(alive(), F.col("text")), ascii_words))
    return marked(df, F.concat(F.lit("simhash64="), F.lower(F.lpad(F.hex("__sig"), 16, "0")))).drop("__sig")


def python_stage(df: DataFrame, idx: int, name: str, function: Callable[[str], str]) -> DataFrame:
    """A text transform of yours, called for each alive text. A row for which it raises is rejected as RUNTIME_ERROR with the error; the run goes on."""

    @F.arrow_udf("struct<text:string,error:string>")
    def run(texts: pa.Array) -> pa.Array:
        def one(t: str | None) -> dict:
            if t is None:
                return {"text": None, "error": None}
            try:
                return {"text": function(t), "error": None}
            except Exception as e:
                return {"text": t, "error": str(e) or type(e).__name__}

        return pa.array([one(t) for t in texts.to_pylist()], pa.struct([("text", pa.string()), ("error", pa.string())]))

    df = df.withColumn("__new", text.once(run)(F.when(alive(), F.col("text"))))
    error = F.col("__new.error")
    df = rejecting(df, "runtime_error", idx, F.when(error.isNotNull(), "RUNTIME_ERROR"), error)
    return marked(changed(df, text=F.col("__new.text")).drop("__new"), f"{name}_v1")


def domain_tagging(df: DataFrame, idx: int, classifier=None, keywords: dict[str, list[str]] | None = None, threshold: float = 0.5, top: int = 5) -> DataFrame:
    """Marks the domains of a text: those of the `top` that a classifier (Column -> array of (label, score)) scores above the threshold, or those with a keyword."""
    t = F.col("text")
    if classifier is not None:
        best = F.slice(F.array_sort(classifier(F.when(alive(), t)), lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(0)), 1, top)
        tags = F.transform(F.filter(best, lambda x: x["score"] > threshold), lambda x: F.regexp_replace(x["label"], "^__label__", ""))
    elif keywords:
        tags = F.array_compact(F.array(*[F.when(t.rlike("(?iU)\\b(" + "|".join(w) + ")\\b"), F.lit(k)) for k, w in sorted(keywords.items())]))
    else:
        tags = F.array().cast("array<string>")
    return marked(df, F.when(F.size(tags) > 0, F.concat(F.lit("domain_tags_"), F.array_join(tags, ","), F.lit("_v1"))).otherwise("domain_tags_none_v1"))
