"""The documents' schema and the way from raw records to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import hashing, text
from .operators.gates import REJECTION

RAW = "raw_id string, text string, source string, url string, license string, created_at string, extra map<string,string>, source_file string, source_line bigint, seq bigint"

#: Columns of the corpus in their order (fixed).
CORPUS = {
    "doc_id": "binary", "source": "string", "lang": "string", "text": "string", "url": "string", "license": "string", "license_version": "string", "source_file": "string",
    "tokens": "bigint", "chars": "bigint", "bytes_utf8": "bigint", "entropy": "float", "ppl": "float", "quality_score": "float", "dup_group_id": "bigint",
    "pii_flag": "boolean", "pii_types": "array<string>", "policy_version": "string", "transform_chain": "array<string>", "created_at_ms": "bigint", "data_tag": "string",
}
DEFAULTS = {"lang": "en"}


def from_raw(raw: DataFrame, policy_version: str = "policy_v0", data_tag: str | None = None, license: str | None = None, lang: str | None = None) -> DataFrame:
    """Documents of raw records. A missing license is the source's or "Unknown"; the identifier covers the head of the text until exact dedup replaces it.

    A record that its reader could not read (a column error) is rejected from the start."""
    extra = F.coalesce("extra", F.create_map().cast("map<string,string>"))
    get = lambda k: F.element_at(extra, k)
    null = lambda t: F.lit(None).cast(t)
    t = F.coalesce("text", F.lit(""))
    error = F.col("error") if "error" in raw.columns else F.lit(None).cast("string")
    # stage -1: before the first stage
    unread = F.struct(F.lit("source").alias("stage"), F.lit(-1).alias("stage_idx"), F.lit("CORRUPT_FILE").alias("reason_code"), error.alias("reason_detail"))
    return raw.select(
        hashing.placeholder_id(t).alias("doc_id"),
        "source",
        text.language(F.coalesce(get("language"), get("lang"), F.lit(lang)), "en").alias("lang"),
        t.alias("text"),
        "url",
        F.coalesce("license", F.lit(license), F.lit("Unknown")).alias("license"),
        get("license_version").alias("license_version"),
        F.coalesce("source_file", get("source_file"), get("pdf_file")).alias("source_file"),
        *[null(CORPUS[c] if CORPUS[c] != "float" else "double").alias(c) for c in ("tokens", "chars", "bytes_utf8", "entropy", "ppl", "quality_score", "dup_group_id")],
        F.lit(False).alias("pii_flag"),
        F.array().cast("array<string>").alias("pii_types"),
        F.lit(policy_version).alias("policy_version"),
        F.array().cast("array<string>").alias("transform_chain"),
        F.unix_millis(F.try_to_timestamp("created_at")).alias("created_at_ms"),
        F.coalesce(get("data_tag"), F.lit(data_tag)).alias("data_tag"),
        "raw_id",
        extra.alias("extra"),
        "seq",
        F.when(error.isNotNull(), unread).cast(REJECTION).alias("rejection"),
    )


def corpus(df: DataFrame, beside: list[str] | None = None) -> DataFrame:
    """Alive documents in the corpus columns: missing strings empty, missing times 0, extra fields as JSON; further columns beside them."""

    def one(c: str, kind: str) -> Column:
        if kind == "string" and c != "text":
            return F.coalesce(c, F.lit(DEFAULTS.get(c, ""))).alias(c)
        return (F.coalesce(c, F.lit(0)) if c == "created_at_ms" else F.col(c)).cast(kind).alias(c)

    return df.where("rejection is null").select(*[one(c, k) for c, k in CORPUS.items()], F.to_json("extra").alias("extra_metadata"), *(beside or []))


def metadata(df: DataFrame, version: str = "meta_v1") -> DataFrame:
    """The corpus without texts, with the schema's version."""
    return corpus(df).drop("text", "extra_metadata").withColumn("schema_version", F.lit(version))
