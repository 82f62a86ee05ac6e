"""Queries over the driver's tables, one or more for each operator, and DuckDB SQL for those that SQL can express.

`documents` has no license, so one is derived from its source; doc_id gives the order in which documents are seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, pii, text
from ..operators import dedup, gates, quantiles, registry, reports
from ..schema import from_raw, metadata
from ..sinks import writers
from ..sources import readers
from ..storage import listed, new_folder
from ..streaming import jobs
from .pipeline import apply_stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

STAGES = ["license_gate", "sanitize", "exact_dedup", "quality_gate", "pii_policy_gate"]
PRIORITY = ["src1", "src2", "src3"]
TYPES = (["books", "wiki", "web"], {"src0": "books", "src1": "wiki", "src2": "web", "src3": "web"})


def query(sql: str | None = None):
    """Registers a query under its function's name, with SQL that must give the same rows."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as raw records and from there in the engine's schema."""
    t = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    n = F.regexp_extract("source", r"(\d+)", 1).cast("int") % 6
    license = F.when(n == 0, "CC-BY").when(n == 1, "CC0").when(n == 2, "CC-BY-SA").when(n == 3, "All-Rights-Reserved").when(n == 4, "GPL")
    raw = t.select(F.col("doc_id").cast("string").alias("raw_id"), "text", "source", F.lit(None).cast("string").alias("url"), license.alias("license"), F.lit(None).cast("string").alias("created_at"), F.create_map(F.lit("language"), F.col("lang")).alias("extra"), F.concat(F.lit("in\\"), F.col("source"), F.lit(".jsonl")).alias("source_file"), F.col("doc_id").alias("source_line"), F.col("doc_id").alias("seq"))
    return from_raw(raw)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_stages(docs(spark, sf_dir), STAGES)


# SQL shared by the oracles
WHITE = r"[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
LICENSE = "CASE CAST(regexp_extract(source, '(\\d+)', 1) AS INT) % 6 WHEN 0 THEN 'CC-BY' WHEN 1 THEN 'CC0' WHEN 2 THEN 'CC-BY-SA' WHEN 3 THEN 'All-Rights-Reserved' WHEN 4 THEN 'GPL' ELSE 'Unknown' END"
REASON = "CASE WHEN license IN ('CC-NC','CC-ND','All-Rights-Reserved','Proprietary','Unknown') THEN 'LICENSE_DISALLOWED' WHEN license NOT IN ('CC0','CC-BY','CC-BY-SA','CC-BY-NC','Public-Domain') THEN 'LICENSE_NOT_ALLOWED' END"
SANITIZE = f"trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '{WHITE}', ' ', 'g'))"
ENTROPY = "(SELECT coalesce(log2(sum(n)) - sum(n * log2(n)) / sum(n), 0) FROM (SELECT count(*) AS n FROM unnest(string_split(t, '')) u(c) GROUP BY c))"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = r"(^|[^0-9])(?:\+?\d{1,3}[\s-]?)?(?:\d[\s-]?){8,11}\d[\s-]?($|[^0-9])"
AADHAAR = r"(^|[^0-9])(?:\d{4}[\s-]?){2}\d{4}($|[^0-9])"
#: The funnel of STAGES: every document with the stage and reason that rejected it.
FUNNEL = f"""
    a AS (SELECT doc_id, source, lang, {LICENSE} AS license, {SANITIZE} AS clean FROM documents),
    b AS (SELECT *, {REASON} AS lic FROM a),
    c AS (SELECT *, CASE WHEN lic IS NULL AND row_number() OVER (PARTITION BY lic IS NULL, clean ORDER BY doc_id) > 1 THEN 'DUP_EXACT' END AS dup FROM b),
    d AS (SELECT *, (SELECT coalesce(log2(sum(n)) - sum(n * log2(n)) / sum(n), 0) FROM (SELECT count(*) AS n FROM unnest(string_split(clean, '')) u(x) GROUP BY x)) AS entropy FROM c),
    e AS (SELECT *, CASE WHEN length(clean) < 200 THEN 'TOO_SHORT' WHEN entropy < 3.5 OR entropy > 7.8 THEN 'ENTROPY_OUT_OF_RANGE' END AS qual,
                 CASE WHEN regexp_matches(clean, '{AADHAAR}') THEN 'PII_AADHAAR' END AS per FROM d),
    f AS (SELECT *, CASE WHEN lic IS NOT NULL THEN 0 WHEN dup IS NOT NULL THEN 2 WHEN qual IS NOT NULL THEN 3 WHEN per IS NOT NULL THEN 4 END AS pos,
                 coalesce(lic, dup, qual, per) AS reason FROM e)"""
STAGE_NAME = "CASE pos WHEN 0 THEN 'license_gate' WHEN 2 THEN 'exact_dedup' WHEN 3 THEN 'quality_gate' WHEN 4 THEN 'pii_policy_gate' END"
CATEGORY = "CASE WHEN reason LIKE 'DUP%' THEN 'duplicates' WHEN reason LIKE 'PII%' OR reason LIKE 'LICENSE%' THEN 'pii' ELSE 'low_quality' END"


# -- gates and scalar functions -------------------------------------------------------------------


@query(f"WITH a AS (SELECT doc_id, {LICENSE} AS license FROM documents) SELECT doc_id, license, {REASON} AS reason FROM a")
def license_gate_decision(spark, sf):
    return docs(spark, sf).select(F.col("seq").alias("doc_id"), "license", gates.license_reason(F.col("license")).alias("reason"))


@query(f"WITH a AS (SELECT doc_id, {LICENSE} AS license FROM documents) SELECT doc_id FROM a WHERE {REASON} IS NULL")
def license_gate_accepted(spark, sf):
    return apply_stages(docs(spark, sf), ["license_gate"]).where("rejection is null").select(F.col("seq").alias("doc_id"))


@query(f"SELECT doc_id, {SANITIZE} AS text FROM documents")
def sanitize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.sanitize(F.col("text")).alias("text"))


@query(f"SELECT page_id, {SANITIZE.replace('(text,', '(html,')} AS text FROM pages")
def sanitize_html_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.sanitize(F.col("html")).alias("text"))


@query("SELECT doc_id, nfc_normalize(text || 'e' || chr(769)) AS text, nfc_normalize(text) = text AS unchanged FROM documents")
def unicode_nfc(spark, sf):
    t = table(spark, sf, "documents")
    return t.select("doc_id", text.nfc(F.concat("text", F.lit("é"))).alias("text"), (text.nfc(F.col("text")) == F.col("text")).alias("unchanged"))


@query("SELECT doc_id, sha256(text) AS sha256_hex, substr(sha256(substr(text, 1, 512)), 1, 64) AS placeholder_hex FROM documents")
def doc_id_sha256(spark, sf):
    t = table(spark, sf, "documents")
    return t.select("doc_id", F.lower(F.hex(hashing.sha256(F.col("text")))).alias("sha256_hex"), F.lower(F.hex(hashing.placeholder_id(F.col("text")))).alias("placeholder_hex"))


@query("""WITH h AS (SELECT doc_id, CAST('0x' || substr(sha256(text), 1, 16) AS UBIGINT) AS u FROM documents)
    SELECT doc_id, CASE WHEN u >= 9223372036854775808::UBIGINT THEN CAST(CAST(u AS HUGEINT) - 18446744073709551616 AS BIGINT) ELSE CAST(u AS BIGINT) END AS dup_group_id FROM h""")
def dup_group_id(spark, sf):
    return table(spark, sf, "documents").select("doc_id", hashing.dup_group_id(hashing.sha256(F.col("text"))).alias("dup_group_id"))


@query(f"SELECT doc_id, regexp_matches(text, '{EMAIL}') AS email, regexp_matches(text, '{PHONE}') AS phone, regexp_matches(text, '{AADHAAR}') AS aadhaar FROM documents")
def pii_detect(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *[pii.has(F.col("text"), k).alias(k) for k in ("email", "phone", "aadhaar")])


@query(f"SELECT doc_id, regexp_matches(text, '{AADHAAR}') OR regexp_matches(text, '{EMAIL}') AS pii_flag, concat_ws(',', CASE WHEN regexp_matches(text, '{AADHAAR}') THEN 'aadhaar' END, CASE WHEN regexp_matches(text, '{EMAIL}') THEN 'email' END) AS pii_types FROM documents")
def pii_flag_types(spark, sf):
    d = apply_stages(docs(spark, sf), ["pii_policy_gate"], pii_policy_gate={"policy": gates.PiiPolicy(mode="allow")})
    return d.select(F.col("seq").alias("doc_id"), "pii_flag", F.array_join("pii_types", ",").alias("pii_types"))


@query(f"SELECT doc_id, regexp_replace(text, '{EMAIL}', '<PII:EMAIL>', 'g') AS text FROM documents")
def pii_redact_email(spark, sf):
    return table(spark, sf, "documents").select("doc_id", pii.redact(F.col("text"), 0.9, ["email"]).alias("text"))


@query()
def pii_redact_all(spark, sf):
    return table(spark, sf, "documents").select("doc_id", pii.redact(F.col("text"), 0.8).alias("text"), F.size(pii.signals(F.col("text"))).alias("n_signals"))


@query(f"SELECT doc_id, CASE WHEN regexp_matches(text, '{EMAIL}') THEN 'PII_EMAIL' END AS reason FROM documents")
def pii_gate_legacy(spark, sf):
    return apply_stages(docs(spark, sf), ["pii_gate"]).select(F.col("seq").alias("doc_id"), F.col("rejection.reason_code").alias("reason"))


@query(f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{AADHAAR}') THEN 'PII_AADHAAR' END AS reason,
    CASE WHEN regexp_matches(text, '{AADHAAR}') THEN NULL WHEN regexp_matches(text, '{EMAIL}') THEN 'pii_redacted_v1' ELSE 'pii_none_v1' END AS marker FROM documents""")
def pii_policy_decision(spark, sf):
    d = apply_stages(docs(spark, sf), ["pii_policy_gate"])
    return d.select(F.col("seq").alias("doc_id"), F.col("rejection.reason_code").alias("reason"), F.get("transform_chain", F.lit(0)).alias("marker"))


@query(f"SELECT doc_id, round({ENTROPY.replace('(t,', '(text,')}, 6) AS entropy FROM documents")
def char_entropy(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(text.char_entropy(F.col("text")), 6).alias("entropy"))


@query(f"""WITH e AS (SELECT doc_id, length(text) AS chars, strlen(text) AS bytes_utf8, {ENTROPY.replace('(t,', '(text,')} AS x FROM documents)
    SELECT doc_id, chars, bytes_utf8, CASE WHEN chars < 200 THEN NULL ELSE round(x, 6) END AS entropy, CASE WHEN chars < 200 THEN 'TOO_SHORT' WHEN x < 3.5 OR x > 7.8 THEN 'ENTROPY_OUT_OF_RANGE' END AS reason FROM e""")
def quality_gate(spark, sf):
    d = apply_stages(docs(spark, sf), ["quality_gate"])
    return d.select(F.col("seq").alias("doc_id"), "chars", "bytes_utf8", F.round("entropy", 6).alias("entropy"), F.col("rejection.reason_code").alias("reason"))


_GRAMS = "(SELECT substr(p, CAST(i * 10 + 1 AS INT), 10) AS g FROM range(length(p) // 10) r(i))"
_RATIO = f"CASE WHEN length(p) < 20 THEN 0.0 ELSE (SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS DOUBLE) / sum(n) FROM (SELECT count(*) AS n FROM {_GRAMS} GROUP BY g)) END"


@query(f"SELECT doc_id, round({_RATIO}, 6) AS repeat_ratio FROM (SELECT doc_id, substr(text, 1, 5000) AS p FROM documents)")
def repetition_ratio(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(text.repeat_ratio(F.col("text")), 6).alias("repeat_ratio"))


@query("""WITH t AS (SELECT doc_id, len(regexp_extract_all(text, '([0-9A-Za-z_\\x{c0}-\\x{24f}]+|[^0-9A-Za-z_\\x{c0}-\\x{24f}\\s])')) AS tokens FROM documents)
    SELECT doc_id, CAST(tokens AS BIGINT) AS tokens, CASE WHEN tokens >= 3686 THEN 'eligible_windows=4096' || CASE WHEN tokens >= 14745 THEN ',16384' ELSE '' END || CASE WHEN tokens >= 58982 THEN ',65536' ELSE '' END END AS windows FROM t""")
def curriculum_windows(spark, sf):
    d = apply_stages(docs(spark, sf), ["tokenize", "curriculum_eligibility"])
    return d.select(F.col("seq").alias("doc_id"), "tokens", F.get(F.filter("transform_chain", lambda m: F.startswith(m, F.lit("eligible_windows="))), F.lit(0)).alias("windows"))


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '([0-9A-Za-z_\\x{c0}-\\x{24f}]+|[^0-9A-Za-z_\\x{c0}-\\x{24f}\\s])')) AS w FROM documents),
    n AS (SELECT doc_id, w, count(*) AS n FROM t GROUP BY ALL)
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS tokens, round(1 - 0.2 * count(*) FILTER (n = 1) / count(*), 6) AS quality_score FROM n GROUP BY doc_id""")
def token_stats(spark, sf):
    d = apply_stages(docs(spark, sf), ["tokenize"])
    return d.where("tokens > 0").select(F.col("seq").alias("doc_id"), "tokens", F.round("quality_score", 6).alias("quality_score"))


@query(r"""WITH t AS (SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)\b(licensed|license)\b') THEN 'law' END, CASE WHEN regexp_matches(text, '(?i)\b(http|https|www)\b') THEN 'web' END) AS tags FROM documents)
    SELECT doc_id, CASE WHEN tags = '' THEN 'domain_tags_none_v1' ELSE 'domain_tags_' || tags || '_v1' END AS marker FROM t""")
def domain_tags(spark, sf):
    words = {"law": ["licensed", "license"], "web": ["http", "https", "www"]}
    d = apply_stages(docs(spark, sf), ["domain_tagging"], domain_tagging={"keywords": words})
    return d.select(F.col("seq").alias("doc_id"), F.element_at("transform_chain", -1).alias("marker"))


@query("SELECT doc_id, left(lower(lang), 2) AS lang, CAST(strlen(text) AS BIGINT) AS bytes_utf8 FROM documents")
def language_and_bytes(spark, sf):
    return docs(spark, sf).select(F.col("seq").alias("doc_id"), "lang", F.octet_length("text").cast("long").alias("bytes_utf8"))


@query("SELECT doc_id FROM documents WHERE length(text) >= 200")
def min_text_length(spark, sf):
    return gates.min_length(docs(spark, sf), 200).select(F.col("seq").alias("doc_id"))


# -- deduplication --------------------------------------------------------------------------------


@query("SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS duplicate, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents")
def exact_dedup(spark, sf):
    d = apply_stages(docs(spark, sf), ["exact_dedup"], exact_dedup={"first_as": "first_id"})
    return d.select(F.col("seq").alias("doc_id"), F.col("rejection").isNotNull().alias("duplicate"), "first_id")


@query("SELECT text_sha256, n FROM (SELECT sha256(text) AS text_sha256, count(*) AS n FROM documents GROUP BY 1) WHERE n > 1")
def dup_group_sizes(spark, sf):
    d = table(spark, sf, "documents").groupBy(F.lower(F.hex(hashing.sha256(F.col("text")))).alias("text_sha256")).agg(F.count("*").alias("n"))
    return d.where("n > 1")


_CHUNKS = f"c AS (SELECT doc_id, trim(regexp_replace(text, '{WHITE}', ' ', 'g')) AS t FROM documents), k AS (SELECT doc_id, i AS chunk, sha256(trim(substr(t, CAST(i * 512 + 1 AS INT), 512))) AS hash FROM c, range((length(t) + 511) // 512) r(i))"


@query(f"WITH {_CHUNKS} SELECT doc_id, CAST(chunk AS INT) AS chunk, hash FROM k")
def chunk_explode(spark, sf):
    return dedup.chunk_hashes(table(spark, sf, "documents"), id="doc_id").select("doc_id", "chunk", "hash")


@query(f"WITH {_CHUNKS}, f AS (SELECT hash, min(doc_id) AS first FROM k GROUP BY hash) SELECT doc_id, count(*) AS links FROM k JOIN f USING (hash) WHERE doc_id > first GROUP BY doc_id")
def chunk_dup_links(spark, sf):
    h = dedup.chunk_hashes(table(spark, sf, "documents").withColumnRenamed("doc_id", "seq"))
    return dedup.chunk_links(h).select(F.col("seq").alias("doc_id"), "links")


_SIGS = """w AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9_]{2,}')[1:2000])) AS word FROM documents),
    m AS (SELECT doc_id, CAST('0x' || substr(md5(word), 1, 15) AS BIGINT) AS h, count(*) AS n FROM w GROUP BY ALL),
    b AS (SELECT doc_id, i, sum(CASE WHEN (h >> CAST(i AS INT)) & 1 = 1 THEN n ELSE -n END) > 0 AS bit FROM m, range(60) r(i) GROUP BY doc_id, i),
    s AS (SELECT doc_id, CAST(sum(CASE WHEN bit THEN CAST(1 AS BIGINT) << CAST(i AS INT) ELSE 0 END) AS BIGINT) AS sig FROM b GROUP BY doc_id)"""


@query(f"WITH {_SIGS} SELECT doc_id, sig FROM s")
def simhash_signature(spark, sf):
    return table(spark, sf, "documents").select("doc_id", hashing.simhash(F.col("text"), ascii_words=True).alias("sig")).where("sig is not null")


@query(f"WITH {_SIGS}, d AS (SELECT DISTINCT sig FROM s) SELECT x.sig AS a, y.sig AS b, CAST(bit_count(xor(x.sig, y.sig)) AS INT) AS distance FROM d x JOIN d y ON x.sig < y.sig AND bit_count(xor(x.sig, y.sig)) <= 3")
def simhash_pairs_h3(spark, sf):
    """Pairs of distinct signatures; simhash_signature has the members."""
    s = table(spark, sf, "documents").select(hashing.simhash(F.col("text"), ascii_words=True).alias("sig"))
    return dedup.hamming_pairs(s)


@query(f"WITH {_SIGS} SELECT doc_id, 'simhash64=' || printf('%016x', sig) AS marker FROM s")
def semantic_simhash(spark, sf):
    d = apply_stages(docs(spark, sf), ["semantic_simhash"], semantic_simhash={"ascii_words": True})
    return d.select(F.col("seq").alias("doc_id"), F.get("transform_chain", F.lit(0)).alias("marker")).where("marker is not null")


@query(f"""WITH a AS (SELECT doc_id, {LICENSE} AS license, text FROM documents), b AS (SELECT *, {REASON} AS lic, length(text) AS n, {ENTROPY.replace('(t,', '(text,')} AS x FROM a)
    SELECT doc_id, coalesce(lic, CASE WHEN n < 200 THEN 'TOO_SHORT' ELSE 'ENTROPY_OUT_OF_RANGE' END) AS reason,
           CASE WHEN lic IS NOT NULL THEN 'license=' || license WHEN n < 200 THEN 'chars=' || n ELSE printf('entropy=%.3f', x) END AS detail
    FROM b WHERE lic IS NOT NULL OR n < 200 OR x < 3.5 OR x > 7.8""")
def rejection_details(spark, sf):
    d = apply_stages(docs(spark, sf), ["license_gate", "quality_gate"]).where("rejection is not null")
    return d.select(F.col("seq").alias("doc_id"), F.col("rejection.reason_code").alias("reason"), F.col("rejection.reason_detail").alias("detail"))


def _without_e(t: str) -> str:
    if "@" in t:
        raise ValueError("an address")
    return t.replace("e", "3")


@query("""SELECT doc_id, CASE WHEN contains(text, '@') THEN 'RUNTIME_ERROR' END AS reason, CASE WHEN contains(text, '@') THEN 'an address' END AS detail,
    sha256(CASE WHEN contains(text, '@') THEN text ELSE replace(text, 'e', '3') END) AS text_sha256 FROM documents""")
def runtime_errors(spark, sf):
    """A registered transform that raises for some documents: these are rejected, the others go on."""
    if "without_e" not in registry.list_stages():
        registry.register_transform("without_e", _without_e)
    d = apply_stages(docs(spark, sf), ["without_e"])
    return d.select(F.col("seq").alias("doc_id"), F.col("rejection.reason_code").alias("reason"), F.col("rejection.reason_detail").alias("detail"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query()
def minhash_candidates(spark, sf):
    """Each bucket's first document with the others."""
    return dedup.minhash_pairs(dedup.minhash_bands(table(spark, sf, "documents").withColumnRenamed("doc_id", "seq")))


@query()
def near_dup_soft(spark, sf):
    d = apply_stages(docs(spark, sf), ["near_dup_minhash"])
    return d.select(F.col("seq").alias("doc_id"), F.get("transform_chain", F.lit(0)).alias("marker"))


@query()
def near_dup_hard(spark, sf):
    d = apply_stages(docs(spark, sf), ["near_dup_minhash"], near_dup_minhash={"hard_reject": True})
    return d.select(F.col("seq").alias("doc_id"), F.col("rejection.reason_code").alias("reason"))


@query()
def global_dedup_decisions(spark, sf):
    return dedup.global_decisions(table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "text")).withColumnRenamed("seq", "doc_id")


@query()
def global_dedup_metrics(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "text", "source")
    return reports.dedup_metrics(dedup.global_decisions(d, collisions=True))


@query("""WITH g AS (SELECT DISTINCT text, source FROM documents WHERE text IS NOT NULL AND source IS NOT NULL)
    SELECT a.source AS source_a, b.source AS source_b, count(*) AS groups FROM g a JOIN g b ON a.text = b.text AND a.source < b.source GROUP BY ALL""")
def source_collisions(spark, sf):
    """How many texts each two sources have in common."""
    t = table(spark, sf, "documents").where("text is not null")
    return reports.source_collisions(t.select(hashing.sha256(F.col("text")).alias("group"), "source"))


@query("SELECT DISTINCT source, CASE WHEN contains(source, 'src1') THEN 0 WHEN contains(source, 'src2') THEN 1 WHEN contains(source, 'src3') THEN 2 ELSE 3 END AS priority FROM documents")
def source_priority_rank(spark, sf):
    return table(spark, sf, "documents").select("source").distinct().select("source", dedup.priority_rank(F.col("source"), PRIORITY).alias("priority"))


@query("SELECT DISTINCT source, CASE source WHEN 'src0' THEN 0 WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 WHEN 'src3' THEN 2 ELSE 3 END AS type_priority FROM documents")
def type_priority_rank(spark, sf):
    return table(spark, sf, "documents").select("source").distinct().select("source", dedup.type_rank(F.col("source"), *TYPES).alias("type_priority"))


@query("""WITH r AS (SELECT doc_id, text, CASE source WHEN 'src0' THEN 0 WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 WHEN 'src3' THEN 2 ELSE 3 END AS t,
        CASE WHEN contains(source, 'src1') THEN 0 WHEN contains(source, 'src2') THEN 1 WHEN contains(source, 'src3') THEN 2 ELSE 3 END AS s FROM documents)
    SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY t, s, doc_id) AS n FROM r) WHERE n = 1""")
def priority_dedup(spark, sf):
    """Of equal texts the one of best type, source and place."""
    t = table(spark, sf, "documents")
    order = F.struct(dedup.type_rank(F.col("source"), *TYPES).alias("t"), dedup.priority_rank(F.col("source"), PRIORITY).alias("s"), F.col("doc_id"))
    return t.groupBy(hashing.sha256(F.col("text")).alias("h")).agg(F.min(order).alias("o")).select("o.doc_id")


# -- funnel and reports ---------------------------------------------------------------------------


@query(f"WITH {FUNNEL} SELECT doc_id, reason, pos AS stage_idx FROM f")
def pipeline_decisions(spark, sf):
    return staged(spark, sf).select(F.col("seq").alias("doc_id"), F.col("rejection.reason_code").alias("reason"), F.col("rejection.stage_idx").alias("stage_idx"))


@query(f"""WITH {FUNNEL} SELECT s AS stage, CAST(i AS INT) AS stage_idx, count(*) FILTER (pos IS NULL OR pos >= i) AS input_docs, count(*) FILTER (pos IS NULL OR pos > i) AS accepted_docs, count(*) FILTER (pos = i) AS rejected_docs
    FROM f, (VALUES ('license_gate', 0), ('sanitize', 1), ('exact_dedup', 2), ('quality_gate', 3), ('pii_policy_gate', 4)) v(s, i) GROUP BY s, i""")
def stage_funnel(spark, sf):
    return reports.stage_funnel(staged(spark, sf), STAGES)


@query(f"""WITH {FUNNEL} SELECT source, s AS stage, CAST(i AS INT) AS stage_idx, count(*) FILTER (pos IS NULL OR pos >= i) AS input_docs, count(*) FILTER (pos IS NULL OR pos > i) AS accepted_docs, count(*) FILTER (pos = i) AS rejected_docs
    FROM f, (VALUES ('license_gate', 0), ('sanitize', 1), ('exact_dedup', 2), ('quality_gate', 3), ('pii_policy_gate', 4)) v(s, i) GROUP BY source, s, i HAVING count(*) FILTER (pos IS NULL OR pos >= i) > 0""")
def stage_funnel_by_source(spark, sf):
    return reports.stage_funnel(staged(spark, sf), STAGES, ["source"])


@query(f"WITH {FUNNEL} SELECT {STAGE_NAME} AS stage, reason AS reason_code, count(*) AS rejected_docs FROM f WHERE pos IS NOT NULL GROUP BY ALL")
def rejection_breakdown(spark, sf):
    return reports.rejection_breakdown(reports.rejections(staged(spark, sf)))


@query(f"WITH {FUNNEL} SELECT {CATEGORY} AS category, count(*) AS rejected_docs FROM f WHERE pos IS NOT NULL GROUP BY ALL")
def rejection_category_counts(spark, sf):
    return reports.rejection_breakdown(reports.rejections(staged(spark, sf)), "category")


@query(f"WITH {FUNNEL}, n AS (SELECT {STAGE_NAME} AS stage, count(*) AS rejected_docs FROM f WHERE pos IS NOT NULL GROUP BY ALL) SELECT stage, rejected_docs, round(100.0 * rejected_docs / (SELECT sum(rejected_docs) FROM n), 6) AS share_pct FROM n")
def rejection_share(spark, sf):
    return reports.rejection_share(reports.rejections(staged(spark, sf))).withColumn("share_pct", F.round("share_pct", 6))


@query(f"WITH {FUNNEL} SELECT 'in/' || source || '.jsonl' AS source_file, {STAGE_NAME} AS stage, count(*) AS rejected_docs FROM f WHERE pos IS NOT NULL GROUP BY ALL")
def rejections_by_file(spark, sf):
    return reports.rejections_by_file(reports.rejections(staged(spark, sf)))


@query(f"WITH {FUNNEL} SELECT 'in/' || source || '.jsonl' AS source_file, count(*) AS processed, count(*) FILTER (pos IS NULL) AS written, count(*) FILTER (pos IS NOT NULL) AS rejected, source AS sources, round(100.0 * count(*) FILTER (pos IS NULL) / count(*), 6) AS success_pct FROM f GROUP BY source")
def per_source_stats(spark, sf):
    return reports.file_stats(staged(spark, sf)).withColumn("sources", F.array_join("sources", ",")).withColumn("success_pct", F.round("success_pct", 6))


@query(f"WITH {FUNNEL} SELECT count(*) AS processed, count(*) FILTER (pos IS NULL) AS written, count(*) FILTER (pos IS NOT NULL) AS rejected, round(100.0 * count(*) FILTER (pos IS NULL) / count(*), 6) AS success_rate_pct FROM f")
def run_totals(spark, sf):
    return reports.run_totals(staged(spark, sf)).withColumn("success_rate_pct", F.round("success_rate_pct", 6))


@query(f"WITH {FUNNEL} SELECT source, count(*) AS dropped_docs FROM f WHERE reason LIKE 'DUP%' GROUP BY source ORDER BY dropped_docs DESC, source LIMIT 20")
def top_duplicated_sources(spark, sf):
    return reports.top_duplicated_sources(reports.rejections(staged(spark, sf)))


@query(f"""WITH {FUNNEL}, s AS (SELECT s, i, count(*) FILTER (pos IS NULL OR pos >= i) AS n, count(*) FILTER (pos = i) AS r FROM f, (VALUES ('license_gate', 0), ('sanitize', 1), ('exact_dedup', 2), ('quality_gate', 3), ('pii_policy_gate', 4)) v(s, i) GROUP BY s, i)
    SELECT s AS stage, n AS input_docs, n - r AS accepted_docs, r AS rejected_docs, round(100.0 * (n - r) / n, 6) AS accept_pct, round(100.0 * r / n, 6) AS reject_pct FROM s""")
def stage_summary(spark, sf):
    e = reports.stage_summary(reports.stage_funnel(staged(spark, sf), STAGES, ["source"]))
    return e.withColumns({c: F.round(c, 6) for c in ("accept_pct", "reject_pct")})


@query("SELECT lang, round(quantile_cont(length(text), 0.5), 6) AS chars_p50, round(quantile_cont(length(text), 0.9), 6) AS chars_p90, round(quantile_cont(length(text), 0.99), 6) AS chars_p99 FROM documents GROUP BY lang")
def length_percentiles(spark, sf):
    p = reports.percentiles(table(spark, sf, "documents").select("lang", F.length("text").alias("chars")), "chars", ["lang"])
    return p.select("lang", *[F.round(c, 6).alias(c) for c in p.columns[1:]])


@query("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS value_p50, round(quantile_cont(value, 0.9), 6) AS value_p90, round(quantile_cont(value, 0.99), 6) AS value_p99,
    count(value) AS n, true AS merged_within_error FROM events GROUP BY event_type""")
def event_value_percentiles(spark, sf):
    """Exact percentiles, and whether those of stored daily sketches, merged, have ranks within twice the sketches' error."""
    e = table(spark, sf, "events").select("event_type", "value", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"))
    folder = new_folder(spark, "sketches")
    reports.daily_sketches(e, "value", ["event_type"]).write.partitionBy("date").parquet(folder)
    whole = quantiles.merged(spark.read.parquet(folder), ["event_type"])
    estimates = quantiles.estimates(whole, list(reports.PERCENTILES), ["event_type"], [f"q{i}" for i in range(len(reports.PERCENTILES))])
    n, off, near = F.count("value"), 2 * quantiles.ERROR, F.lit(True)
    for i, p in enumerate(reports.PERCENTILES):
        near &= (F.count_if(F.col("value") < F.col(f"q{i}")) <= n * (p + off)) & (F.count_if(F.col("value") <= F.col(f"q{i}")) >= n * (p - off))
    checked = e.join(estimates, "event_type").groupBy("event_type").agg(n.alias("n"), near.alias("merged_within_error"))
    exact = reports.percentiles(e, "value", ["event_type"]).join(checked, "event_type")
    return exact.select("event_type", *[F.round(c, 6).alias(c) for c in ("value_p50", "value_p90", "value_p99")], "n", "merged_within_error")


@query(f"WITH e AS (SELECT {ENTROPY.replace('(t,', '(text,')} AS x FROM documents) SELECT round(quantile_cont(x, 0.5), 6) AS entropy_p50, round(quantile_cont(x, 0.9), 6) AS entropy_p90, round(quantile_cont(x, 0.99), 6) AS entropy_p99 FROM e")
def entropy_percentiles(spark, sf):
    p = reports.percentiles(table(spark, sf, "documents").select(text.char_entropy(F.col("text")).alias("entropy")), "entropy")
    return p.select(*[F.round(c, 6).alias(c) for c in p.columns])


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS stage, 'events' AS source, CAST(count(*) AS BIGINT) AS input_docs, CAST(count(*) FILTER (value >= 50) AS BIGINT) AS accepted_docs, CAST(count(*) FILTER (value < 50) AS BIGINT) AS rejected_docs FROM events GROUP BY ALL""")
def daily_rollup(spark, sf):
    e = table(spark, sf, "events")
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    counts = F.create_map(F.lit("input_docs"), F.lit(1).cast("long"), F.lit("accepted_docs"), one(F.col("value") >= 50), F.lit("rejected_docs"), one(F.col("value") < 50))
    return reports.daily_rollup(e.select(F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"), F.col("event_type").alias("stage"), F.lit("events").alias("source"), counts.alias("counts"), F.create_map().cast("map<string,double>").alias("metrics"))).withColumn("date", F.col("date").cast("string"))


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (value >= 50) AS BIGINT) AS high, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY ALL""")
def late_events_rollup(spark, sf):
    """The events as a stream in about eight batches, dealt by hash, so that nearly every event of the later ones comes behind the watermark."""
    folder = new_folder(spark, "late")
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.when(F.col("value") >= 50, 1).otherwise(0).cast("long").alias("high"), F.col("user_id").alias("users"))
    e.withColumn("batch", F.pmod(F.xxhash64("event_id"), F.lit(8))).drop("event_id").write.partitionBy("batch").parquet(f"{folder}/in")
    files = -(-sum(n.endswith(".parquet") for k in range(8) for n, _, _ in listed(spark, f"{folder}/in/batch={k}")) // 8)
    stream = spark.readStream.schema("ts timestamp, event_type string, high long, users long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max(files, 1)).parquet(f"{folder}/in")
    jobs.corrected_rollup(stream, "ts", ["event_type"], f"{folder}/out", f"{folder}/progress", sums=["high", "users"]).awaitTermination()
    out = jobs.rollup_now(spark, f"{folder}/out", ["event_type"], ["high", "users"])
    return out.select(F.to_date("start").cast("string").alias("date"), "event_type", "n", "high", "users")


@query()
def analytics_events(spark, sf):
    e = reports.stage_events(staged(spark, sf), STAGES, "run", 0)
    return e.select("run_id", "stage", "source", F.to_json("counts").alias("counts"), F.to_json("rejection_breakdown").alias("rejection_breakdown"))


# -- projections of sinks and sources ---------------------------------------------------------------


@query(f"SELECT sha256(substr(text, 1, 512)) AS id, text, source, {LICENSE} AS license, lang AS language FROM documents")
def dolma_projection(spark, sf):
    d = writers.dolma_rows(docs(spark, sf))
    get = lambda k: F.get_json_object("metadata", f"$.{k}")
    return d.select("id", "text", get("source").alias("source"), get("license").alias("license"), get("language").alias("language"))


@query(f"WITH {FUNNEL} SELECT sha256(clean) AS doc_id, source, license, length(clean) AS chars, strlen(clean) AS bytes_utf8, round(CAST(entropy AS FLOAT), 3) AS entropy, 'meta_v1' AS schema_version FROM f WHERE pos IS NULL AND NOT regexp_matches(clean, '{EMAIL}')")
def metadata_projection(spark, sf):
    m = metadata(staged(spark, sf)).where("not pii_flag")
    return m.select(F.lower(F.hex("doc_id")).alias("doc_id"), "source", "license", "chars", "bytes_utf8", F.round(F.col("entropy"), 3).alias("entropy"), "schema_version")


@query("SELECT doc_id, 'main/' || lang AS subpath FROM documents WHERE source = 'src0' UNION ALL SELECT doc_id, source || '/' || lang FROM documents WHERE source <> 'src0'")
def structured_subpath(spark, sf):
    d = docs(spark, sf)
    return d.select(F.col("seq").alias("doc_id"), writers.subpath(d, {"src0": " Main "}).alias("subpath"))


@query("SELECT row_number() OVER (ORDER BY k, id) AS place, k AS source, id AS raw_id FROM (SELECT 'a_documents' AS k, doc_id AS id FROM documents UNION ALL SELECT 'b_benchmark', item_id FROM benchmark)")
def sources_union_priority_order(spark, sf):
    """Two tables as sources, the better ranked first; place is the order of seq (by ranges, so that no task sorts all)."""
    specs = [readers.SourceSpec("b_benchmark", "parquet", f"{sf}/benchmark.parquet", id_field="item_id"), readers.SourceSpec("a_documents", "parquet", f"{sf}/documents.parquet", id_field="doc_id")]
    u = readers.union_sources(spark, specs, rank=lambda s: s.name)
    key = F.struct("source", F.col("raw_id").cast("long").alias("raw_id")).alias("key")
    ranged = u.select(key).repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
    return numbered(ranged).select("place", "key.source", F.col("key.raw_id").alias("raw_id"))


def numbered(ranged: DataFrame) -> DataFrame:
    """place: 1, 2, ... over ranged partitions (part) in the order of key; starts come from the partitions' counts."""
    from pyspark.sql import Window

    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    starts = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    return ranged.withColumn("at", within).join(starts, "part").withColumn("place", F.col("start") + F.col("at"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place, length(coalesce(text, '')) AS chars, sha256(coalesce(text, '')) AS text_sha256, lang FROM documents")
def jsonl_lines(spark, sf):
    """The documents written as JSON lines in the order of doc_id and read back by byte ranges; place counts the lines of the source."""
    folder = new_folder(spark, "jsonl")
    t = table(spark, sf, "documents").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    t.select(F.to_json(F.struct(F.col("doc_id").alias("id"), "text", "lang"))).write.text(folder)
    rows = readers.read_source(spark, readers.SourceSpec("documents", "local_jsonl", folder, file_glob="*.txt"))
    return rows.select(F.col("raw_id").cast("long").alias("doc_id"), (F.col("seq") + 1).alias("place"), F.length("text").cast("long").alias("chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.col("extra")["lang"].alias("lang"))


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100")
def limit_docs(spark, sf):
    d = readers.read_source(spark, readers.SourceSpec("documents", "parquet", f"{sf}/documents.parquet", id_field="doc_id", limit_docs=100))
    return d.select(F.col("raw_id").cast("long").alias("doc_id"))


@query(r"""WITH h AS (SELECT url AS base, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']+)["'']', 1)) AS href FROM pages)
    SELECT DISTINCT regexp_extract(base, '^([a-zA-Z][a-zA-Z0-9_+.-]*://[^/?#]+)', 1) || href AS url FROM h WHERE regexp_matches(href, '^/[a-m]')""")
def url_extract_pages(spark, sf):
    """Links that match a pattern, joined to their page's host."""
    return readers.page_links(table(spark, sf, "pages"), pattern="^/[a-m]", suffix=".pdf")


@query()
def html_page_texts(spark, sf):
    return readers.read_source(spark, readers.SourceSpec("pages", "html_pages", f"{sf}/pages.parquet")).select(F.col("seq").alias("page_id"), "url", "text")


@query("SELECT conv_id, count(*) AS turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def conversation_docs(spark, sf):
    c = table(spark, sf, "conversations")
    line = F.concat("role", F.lit(": "), "text")
    g = c.groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("x"))
    return g.select("conv_id", "turns", F.array_join(F.col("x.line"), "\n").alias("text"))
