"""Aggregations over documents with rejections, over events and over decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import slashes
from . import quantiles
from .gates import rejection_category

PERCENTILES = (0.5, 0.9, 0.99)


def stage_funnel(df: DataFrame, stages: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., stage, stage_idx, input_docs, accepted_docs, rejected_docs) in one pass; stages without input have no row."""
    at = F.col("rejection.stage_idx")
    counts = [F.struct(F.lit(s).alias("stage"), F.lit(i).alias("stage_idx"), F.count_if(at.isNull() | (at >= i)).alias("input_docs"), F.count_if(at == i).alias("rejected_docs")) for i, s in enumerate(stages)]
    rows = df.groupBy(*(by or [])).agg(F.array(*counts).alias("c")).select(*(by or []), F.explode("c").alias("c")).select(*(by or []), "c.*")
    return rows.where("input_docs > 0").select(*(by or []), "stage", "stage_idx", "input_docs", (F.col("input_docs") - F.col("rejected_docs")).alias("accepted_docs"), "rejected_docs")


def observed(df: DataFrame, stages: list[str], name: str = "funnel") -> tuple[DataFrame, Observation]:
    """df, whose next action also counts what stage_funnel counts; the observation's `get` waits for it. No second pass, no shuffle."""
    watch = Observation(name)
    at = F.col("rejection.stage_idx")
    counts = [F.count_if(at == i).alias(f"rejected_{i}") for i in range(len(stages))]
    return df.observe(watch, F.count("*").alias("rows"), F.count_if(at < 0).alias("unread"), *counts), watch


def funnel_of(counts: dict[str, int], stages: list[str]) -> list[dict]:
    """The funnel of an observation's counts, in the order of the stages."""
    out, left = [], counts["rows"] - counts["unread"]
    for i, s in enumerate(stages):
        gone = counts[f"rejected_{i}"]
        if left:
            out.append({"stage": s, "stage_idx": i, "input_docs": left, "accepted_docs": left - gone, "rejected_docs": gone})
        left -= gone
    return out


def rejections(df: DataFrame, at_ms: int | None = None) -> DataFrame:
    """The rejection log: a row for each rejected document."""
    now = F.unix_millis(F.current_timestamp()) if at_ms is None else F.lit(at_ms).cast("long")
    r = F.col("rejection")
    return df.where(r.isNotNull()).select(F.lower(F.hex("doc_id")).alias("doc_id"), "source", "source_file", r["stage"].alias("stage"), F.lit("reject").alias("decision"), r["reason_code"].alias("reason_code"), r["reason_detail"].alias("reason_detail"), now.alias("ts_ms"), rejection_category(r["reason_code"]).alias("category"))


def rejection_breakdown(log: DataFrame, *keys: str) -> DataFrame:
    """Counts by keys (stage and reason_code by default), the largest first."""
    keys = keys or ("stage", "reason_code")
    return log.groupBy(*keys).agg(F.count("*").alias("rejected_docs")).orderBy(F.desc("rejected_docs"), *keys)


def rejection_share(log: DataFrame, key: str = "stage") -> DataFrame:
    """Counts by key and each one's percentage of all."""
    n = log.groupBy(key).agg(F.count("*").alias("rejected_docs"))
    return n.withColumn("share_pct", 100.0 * F.col("rejected_docs") / F.sum("rejected_docs").over(Window.partitionBy()))


def rejections_by_file(log: DataFrame) -> DataFrame:
    return log.groupBy(slashes(F.col("source_file")).alias("source_file"), "stage").agg(F.count("*").alias("rejected_docs"))


def stage_summary(events: DataFrame) -> DataFrame:
    """Sums of stage events with the percentages accepted and rejected (0 without input)."""
    s = events.groupBy("stage").agg(*[F.sum(c).alias(c) for c in ("input_docs", "accepted_docs", "rejected_docs")])
    pct = lambda c: F.coalesce(F.try_divide(100.0 * F.col(c), F.col("input_docs")), F.lit(0.0))
    return s.withColumns({"accept_pct": pct("accepted_docs"), "reject_pct": pct("rejected_docs")})


def file_stats(df: DataFrame) -> DataFrame:
    """Documents processed, written and rejected by file, with the sources it belongs to."""
    alive = F.col("rejection").isNull()
    s = df.groupBy(slashes(F.coalesce("source_file", F.lit("unknown"))).alias("source_file")).agg(F.count("*").alias("processed"), F.count_if(alive).alias("written"), F.count_if(~alive).alias("rejected"), F.array_sort(F.collect_set("source")).alias("sources"))
    return s.withColumn("success_pct", 100.0 * F.col("written") / F.col("processed"))


def run_totals(df: DataFrame) -> DataFrame:
    alive = F.col("rejection").isNull()
    s = df.agg(F.count("*").alias("processed"), F.count_if(alive).alias("written"), F.count_if(~alive).alias("rejected"))
    return s.withColumn("success_rate_pct", F.coalesce(F.try_divide(100.0 * F.col("written"), F.col("processed")), F.lit(0.0)))


def percentiles(df: DataFrame, metric: str, by: list[str] | None = None, exact: bool = True) -> DataFrame:
    """<metric>_p50, _p90 and _p99 by group: exact with linear interpolation, or the values that a sketch of one pass gives."""
    names = [f"{metric}_p{round(100 * q)}" for q in PERCENTILES]
    if exact:
        return quantiles.exact(df, metric, list(PERCENTILES), by, names)
    return quantiles.estimates(quantiles.sketches(df, metric, by), list(PERCENTILES), by, names)


def utc_date(ms: Column) -> Column:
    """The date of epoch milliseconds; sessions run in UTC."""
    return F.to_date(F.timestamp_millis(ms))


def daily_rollup(events: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Sums by (UTC date, stage, source); of metrics the latest value."""
    latest = [F.max_by(F.col("metrics")[m], "timestamp_ms").alias(m) for m in metrics or []]
    return events.groupBy(utc_date(F.col("timestamp_ms")).alias("date"), "stage", "source").agg(*[F.sum(F.coalesce(F.col("counts")[c], F.lit(0))).alias(c) for c in ("input_docs", "accepted_docs", "rejected_docs")], *latest)


def daily_sketches(values: DataFrame, metric: str, keys: list[str], at: str = "timestamp_ms") -> DataFrame:
    """(date, keys..., n, sketch): a quantile sketch of the metric for each UTC date, which merge over any dates (quantiles.merged)."""
    return quantiles.sketches(values.withColumn("date", utc_date(F.col(at))), metric, ["date", *keys])


def stage_events(df: DataFrame, stages: list[str], run_id: str, at_ms: int, layer: str = "pipeline") -> DataFrame:
    """Analytics events of a run: a row for each stage and source, counts, metrics and reasons as maps."""
    f = stage_funnel(df, stages, ["source"])
    reasons = df.where("rejection is not null").groupBy("source", F.col("rejection.stage").alias("stage"), F.col("rejection.reason_code").alias("reason")).agg(F.count("*").alias("n"))
    maps = reasons.groupBy("source", "stage").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("rejection_breakdown"))
    counts = F.create_map(*[x for c in ("input_docs", "accepted_docs", "rejected_docs") for x in (F.lit(c), F.col(c))])
    return f.join(maps, ["source", "stage"], "left").select(F.lit(run_id).alias("run_id"), "stage", "source", F.lit(layer).alias("layer"), F.lit(at_ms).cast("long").alias("timestamp_ms"), counts.alias("counts"), F.create_map().cast("map<string,double>").alias("metrics"), F.coalesce("rejection_breakdown", F.create_map().cast("map<string,bigint>")).alias("rejection_breakdown"))


def dedup_metrics(decisions: DataFrame) -> DataFrame:
    """One row of totals, hits by type and rates over decisions (action, match_type, ..., collides: whether a dropped one's matches come from several sources)."""
    hit = lambda t: F.count_if((F.col("action") == "drop") & (F.col("match_type") == t))
    s = decisions.agg(F.count("*").alias("total_checked"), F.count_if(F.col("action") == "drop").alias("total_dropped"), F.count_if(F.col("action") == "keep").alias("total_kept"), F.count_if(F.col("action") == "keep_link").alias("total_kept_linked"), hit("simhash").alias("simhash_hits"), hit("minhash").alias("minhash_hits"), hit("chunk_hash").alias("chunk_hash_hits"), F.count_if(F.col("collides") if "collides" in decisions.columns else F.lit(False)).alias("cross_dataset_collisions"))
    rate = lambda c: F.coalesce(F.try_divide(100.0 * F.col(c), F.col("total_checked")), F.lit(0.0))
    return s.withColumns({"duplication_rate_pct": rate("total_dropped"), "cross_dataset_collision_rate_pct": rate("cross_dataset_collisions")})


def source_sets(members: DataFrame, group: str = "group", source: str = "source") -> DataFrame:
    """(group, word, bits): the sources of each match group as bit sets, 64 of them in a word, numbered by name.

    Sets of parts of the data merge by bit_or. A source's number comes from the table of sources, which has a row each.
    """
    rows = members.select(F.col(group).alias("group"), F.col(source).alias("source")).where("group is not null and source is not null")
    at = F.row_number().over(Window.orderBy("source")) - 1
    numbers = rows.select("source").distinct().withColumn("number", at)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("number") % 64)
    return rows.join(numbers, "source").groupBy("group", F.floor(F.col("number") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))


def source_collisions(members: DataFrame, group: str = "group", source: str = "source") -> DataFrame:
    """(source_a, source_b, groups), a < b: how many match groups of members (group, source) have documents of both.

    Groups with the same set of sources are counted before sets are taken apart, so pairs are made of distinct sets, never of documents.
    """
    rows = members.select(F.col(group).alias("group"), F.col(source).alias("source")).where("group is not null and source is not null")
    names = rows.select("source").distinct().withColumn("number", F.row_number().over(Window.orderBy("source")) - 1)
    words = source_sets(members, group, source).groupBy("group").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("set"))
    sets = words.groupBy("set").agg(F.count("*").alias("groups"))
    has = lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", w["bits"], i) == 1), lambda i: w["word"] * 64 + i)
    sources = sets.select("groups", F.flatten(F.transform("set", has)).alias("of")).where(F.size("of") > 1)
    pairs = sources.select("groups", F.posexplode("of").alias("i", "a"), "of").select("groups", "a", F.explode(F.slice("of", F.col("i") + 2, F.size("of"))).alias("b"))
    sums = pairs.groupBy("a", "b").agg(F.sum("groups").alias("groups"))
    named = lambda side, name: names.select(F.col("number").alias(side), F.col("source").alias(name))
    return sums.join(named("a", "source_a"), "a").join(named("b", "source_b"), "b").select("source_a", "source_b", "groups")


def top_duplicated_sources(log: DataFrame, n: int = 20) -> DataFrame:
    """The sources with the most duplicates rejected; ties by name."""
    return log.where(F.col("category") == "duplicates").groupBy("source").agg(F.count("*").alias("dropped_docs")).orderBy(F.desc("dropped_docs"), "source").limit(n)


def shard_counts(spark: SparkSession, path: str) -> DataFrame:
    """(folder, files, bytes, largest) of what was written below a folder, from the listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest"))


def tail(log: DataFrame, n: int, by: str = "ts_ms") -> DataFrame:
    """The last n rows of a log, the newest first; ties by document."""
    return log.orderBy(F.desc(by), "doc_id").limit(n)


def source_status(config: DataFrame, progress: DataFrame, manifest: DataFrame) -> DataFrame:
    """Configured sources (source, files), progress (source, shard_idx) and manifest (source, written) side by side: queued, processing or complete."""
    j = config.join(progress, "source", "full_outer").join(manifest, "source", "full_outer")
    done = (F.col("files") == F.col("shard_idx")) | F.col("written").isNotNull() & F.col("files").isNull()
    return j.withColumn("status", F.when(F.coalesce(done, F.lit(False)), "complete").when(F.coalesce("shard_idx", F.lit(0)) > 0, "processing").otherwise("queued"))


def throughput(processed: int, started_ms: int, updated_ms: int, total: int | None = None) -> dict:
    """Documents a second, and the seconds that the rest takes."""
    s = max(0.0, (updated_ms - started_ms) / 1000)
    rate = processed / s if s else 0.0
    left = None if total is None or not rate else max(0, total - processed) / rate
    return {"docs_per_s": rate, "eta_s": left, "eta": None if left is None else f"{int(left // 3600)}h {int(left % 3600 // 60)}m {int(left % 60)}s"}


def line_counts(lines: DataFrame) -> DataFrame:
    """Of JSON lines (value): total, empty, non-empty, valid and invalid."""
    empty = F.trim("value") == ""
    valid = ~empty & F.try_parse_json("value").isNotNull()
    return lines.agg(F.count("*").alias("total"), F.count_if(empty).alias("empty"), F.count_if(~empty).alias("non_empty"), F.count_if(valid).alias("valid"), F.count_if(~empty & ~valid).alias("invalid"))
