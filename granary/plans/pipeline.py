"""A run: sources, stages in the order listed, then every output from one plan.

Rejected documents stay in the DataFrame with the stage and reason that rejected them, so the corpus, the rejection log,
counters and reports are projections of the same rows.
"""

from __future__ import annotations

import logging
import time
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, reports
from ..operators.registry import get_stage, out_of_order
from ..schema import from_raw
from ..sinks import writers
from ..sources.readers import SourceSpec, read_source
from ..storage import delete, read_json, write_json
from . import ledger
from .config import RunConfig, fingerprint

log = logging.getLogger(__name__)


def ordered_sources(cfg: RunConfig) -> list[SourceSpec]:
    """The sources by priority, others as listed."""

    def rank(s: SourceSpec) -> tuple:
        place = lambda name, order: next((i for i, x in enumerate(order) if x.strip() and x.strip().lower() in (name or "").strip().lower()), len(order)) if order else 0
        return (place(cfg.source_types.get(s.name, "unknown"), cfg.type_priority) if cfg.type_priority else 0, place(s.name, cfg.source_priority))

    if not cfg.sources:
        raise ValueError("a run has at least one source")
    return sorted(cfg.sources, key=rank)


def read_documents(spark: SparkSession, cfg: RunConfig, s: SourceSpec, first_seq: int) -> DataFrame:
    raw = read_source(spark, s).withColumn("seq", F.col("seq") + F.lit(first_seq))
    return from_raw(raw, cfg.policy_version, s.data_tag or cfg.data_tag, s.license, s.language)


def documents(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """All sources' documents, by priority."""
    each = [read_documents(spark, cfg, s, i << 52) for i, s in enumerate(ordered_sources(cfg))]
    return reduce(DataFrame.unionByName, each)


def options(cfg: RunConfig, stage: str, unit: int | None = None) -> dict:
    """A stage's arguments: its policy, then what stage_options says. unit: whose fingerprints are a run of their own."""
    own = {"license_gate": {"policy": cfg.licenses}, "quality_gate": {"policy": cfg.quality}, "pii_policy_gate": {"policy": cfg.pii}, "curriculum_eligibility": {"policy": cfg.curriculum}, "unicode_normalize": {"enabled": cfg.unicode_normalize}, "tokenize": {"tokenizer": cfg.tokenizer}}.get(stage, {})
    if stage == "global_dedup" and cfg.fingerprints_path:
        store = fingerprints(SparkSession.getActiveSession(), cfg, unit)
        own = {"store": store, "types": (cfg.type_priority, cfg.source_types) if cfg.type_priority else None, "sources": cfg.source_priority}
    return own | cfg.stage_options.get(stage, {})


def fingerprints(spark: SparkSession, cfg: RunConfig, unit: int | None = None) -> dedup.FingerprintStore:
    return dedup.FingerprintStore(spark, cfg.fingerprints_path, run=cfg.run_id if unit is None else f"{cfg.run_id}-unit{unit}")


def ranked(cfg: RunConfig) -> bool:
    """Whether kept documents have passed the store's priorities, so that what they match there is superseded."""
    return "global_dedup" in cfg.stages and bool(cfg.type_priority or cfg.source_priority)


def apply_stages(df: DataFrame, names: list[str], cfg: RunConfig | None = None, unit: int | None = None, **given: dict) -> DataFrame:
    """df through stages in that order. given: arguments by stage, beside those of a configuration."""
    for a, b in out_of_order(names):
        log.warning("stage %s comes before %s; they are usually the other way round", a, b)
    for i, n in enumerate(names):
        df = get_stage(n)(df, i, **((options(cfg, n, unit) if cfg else {}) | given.get(n, {})))
    return df


def in_units(cfg: RunConfig) -> bool:
    """Whether stages can meet earlier documents through what earlier units have written: digests, or the fingerprint store."""
    return "near_dup_minhash" not in cfg.stages and ("global_dedup" not in cfg.stages or bool(cfg.fingerprints_path))


def process(spark: SparkSession, cfg: RunConfig, resume: str = "auto", named: str | None = None) -> tuple[str, list[dict]]:
    """Puts all documents through the stages; the folder of the result and the funnel, counted as it was written.

    The input is cut into units (at least one a source), done one after another; a run that was stopped goes on behind the last one that
    is done, with the result of an unbroken run. Stages that compare documents in other ways than through written digests need all
    of them at once: then the run is one unit. resume: auto and checkpoint go on, beginning forgets, ignore keeps no ledger and reads
    all input in one plan.
    """
    out = cfg.out_dir.rstrip("/")
    if resume == "ignore":
        path = f"{out}/work/{cfg.run_id}/unit=0"
        df, watch = reports.observed(apply_stages(documents(spark, cfg), cfg.stages, cfg), cfg.stages)
        delete(spark, f"{out}/work/{cfg.run_id}")
        df.write.parquet(path)
        if cfg.fingerprints_path:
            fingerprints(spark, cfg).add(spark.read.parquet(path).where("rejection is null"), supersede=ranked(cfg))
        return f"{out}/work/{cfg.run_id}", reports.funnel_of(watch.get, cfg.stages)
    run_id = ledger.run_named(spark, f"{out}/progress", cfg.run_id, resume, named)
    work, book = f"{out}/work/{run_id}", ledger.Ledger(spark, f"{out}/progress", run_id)
    if resume == "beginning" or resume == "auto" and book.finished():
        book.reset()
        delete(spark, work)
    sources = ordered_sources(cfg)
    units = book.plan(sources, cfg.unit_bytes, fingerprint([repr(sources), cfg.stages, cfg.stage_options, repr(cfg.licenses), repr(cfg.quality), repr(cfg.pii)]))
    if not in_units(cfg):
        units = [ledger.Unit(0, 0, 0, [])]
    done = book.done()
    for u in units:
        if u.number in done:
            log.info("unit %d of %d is done", u.number + 1, len(units))
            continue
        docs = read_documents(spark, cfg, u.spec(sources), u.first_seq) if in_units(cfg) else documents(spark, cfg)
        df = apply_stages(docs, cfg.stages, cfg, u.number if len(units) > 1 else None, **({"exact_dedup": {"store": _seen(spark, work, cfg.stages, u.number)}} if "exact_dedup" in cfg.stages and u.number else {}))
        df, watch = reports.observed(df, cfg.stages, f"unit-{u.number}")
        df = df.observe(seqs := Observation(f"seq-{u.number}"), F.max("seq").alias("last"))
        df.write.mode("overwrite").parquet(f"{work}/unit={u.number}")
        if cfg.fingerprints_path:
            fingerprints(spark, cfg, u.number if len(units) > 1 else None).add(spark.read.parquet(f"{work}/unit={u.number}").where("rejection is null"), supersede=ranked(cfg))
        write_json(spark, f"{work}/counts-{u.number}.json", watch.get)
        book.commit(u, watch.get["rows"], seqs.get["last"])
    counts = Counter()
    for u in units:
        counts.update(read_json(spark, f"{work}/counts-{u.number}.json"))
    return work, reports.funnel_of(counts, cfg.stages)


def _seen(spark: SparkSession, work: str, stages: list[str], unit: int) -> DataFrame:
    """(doc_id) of the documents of earlier units that the exact stage has let pass."""
    rows = spark.read.parquet(*[f"{work}/unit={k}" for k in range(unit)])
    return rows.where(F.col("rejection").isNull() | (F.col("rejection.stage_idx") > stages.index("exact_dedup"))).select("doc_id")


def run(spark: SparkSession, cfg: RunConfig, at_ms: int | None = None, resume: str = "auto", named: str | None = None) -> dict:
    """Runs a configuration, or goes on with it, and returns its manifest. Output of a run that is repeated is replaced, not added to."""
    at = int(time.time() * 1000) if at_ms is None else at_ms
    out = cfg.out_dir.rstrip("/")
    done, funnel = process(spark, cfg, resume, named)
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(done)
    writers.get_corpus_writer(cfg.corpus_format)(df, f"{out}/documents" if cfg.structured else f"{out}/docs", structured=cfg.structured, namespaces=cfg.namespaces, shard_docs=cfg.shard_docs, mode="overwrite")
    if cfg.metadata_format:
        writers.get_metadata_writer(cfg.metadata_format)(df, f"{out}/metadata", mode="overwrite")
    writers.write_rejections(df, f"{out}/rejected" if cfg.structured else f"{out}/rejections", "overwrite", cfg.structured, at)
    events = reports.stage_events(df, cfg.stages, cfg.run_id, at)
    events.withColumn("date", reports.utc_date(F.col("timestamp_ms"))).write.mode("overwrite").partitionBy("stage", "date").parquet(f"{out}/analytics/events")
    for name, value in writers.stats_reports(df).items():
        writers.write_json(spark, f"{out}/stats/{name}.json", value)
    manifest = {
        "run_id": cfg.run_id,
        "created_at_ms": at,
        "policy_version": cfg.policy_version,
        "sources": [s.name for s in cfg.sources],
        "totals": reports.run_totals(df).first().asDict(),
        "stages": funnel,
        "outputs": {"documents": f"{out}/documents" if cfg.structured else f"{out}/docs", "metadata": f"{out}/metadata", "rejections": f"{out}/rejected" if cfg.structured else f"{out}/rejections", "analytics": f"{out}/analytics/events"},
    }
    writers.write_json(spark, f"{out}/manifest.json", manifest)
    if resume != "ignore":
        ledger.Ledger(spark, f"{out}/progress", done.rsplit("/", 1)[-1]).finish()
    return manifest
