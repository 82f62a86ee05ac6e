"""Structured Streaming: documents in micro-batches with remembered fingerprints, and rollups of events."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import hashing
from ..operators import reports
from ..operators.dedup import FingerprintStore
from ..plans.pipeline import apply_stages
from ..storage import listed, read_json, write_json

RESUME_MODES = ("auto", "beginning", "checkpoint", "ignore")


def stream_table(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100, glob: str | None = None) -> DataFrame:
    """A folder of Parquet files as a stream."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (r.option("pathGlobFilter", glob) if glob else r).parquet(path)


def dedup_stream(docs: DataFrame, text: str = "text", time: str | None = None, within: str | None = None) -> DataFrame:
    """The first document of each text. With an event time and a delay, state older than the watermark goes; without, it is kept for ever."""
    keyed = docs.withColumn("text_hash", hashing.sha256(F.col(text)))
    if time and within:
        return keyed.withWatermark(time, within).dropDuplicatesWithinWatermark(["text_hash"])
    return keyed.dropDuplicates(["text_hash"])


FIRST_SEEN = "text_hash binary, place bigint, time timestamp, first_place bigint, repeat boolean"


def first_seen_stream(docs: DataFrame, place: str, time: str, within: int, text: str = "text") -> DataFrame:
    """(text_hash, place, time, first_place, repeat): every document with the place of the first one of its text.

    The first is the one that came first: of an earlier batch, or of the smallest (time, place) within a batch. A text's state, three numbers, goes once
    the watermark (`within` seconds behind the latest time) is that far behind its last document, so state is bounded by the texts of that span; documents
    that come later than the watermark allows are dropped by it.
    """

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(parts)).sort_values(["time", "place"])
        first, last = state.get if state.exists else (None, 0)
        repeat = [first is not None] + [True] * (len(rows) - 1)
        first = int(rows["place"].iloc[0]) if first is None else first
        last = max(last, int(rows["time"].max().timestamp() * 1000))
        state.update((first, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + 1000 * within)
        yield pd.DataFrame({"text_hash": [key[0]] * len(rows), "place": rows["place"], "time": rows["time"], "first_place": first, "repeat": repeat})

    keyed = docs.select(hashing.sha256(F.col(text)).alias("text_hash"), F.col(place).cast("long").alias("place"), F.col(time).cast("timestamp").alias("time"))
    grouped = keyed.withWatermark("time", f"{within} seconds").groupBy("text_hash")
    return grouped.applyInPandasWithState(follow, FIRST_SEEN, "first_place bigint, last bigint", "append", GroupStateTimeout.EventTimeTimeout)


def rollup_stream(events: DataFrame, time: str, keys: list[str], late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Counts by window and keys; a window is final once the watermark has passed it."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("date"), *keys, "n")


def _same(a: DataFrame, b: DataFrame, keys: list[str]):
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def corrected_rollup(events: DataFrame, time: str, keys: list[str], out: str, checkpoint: str, sums: list[str] | None = None, late: int = 86_400, window: str = "1 day") -> StreamingQuery:
    """Counts (n) and sums by window and keys, in which no event is too late to count; events without a time are left out.

    Batch k adds its partial sums to out/parts/day=<of the window's start>/batch_id=<k>, and writes to out/versions/batch_id=<k> the windows it makes final,
    which the watermark (`late` seconds behind the latest time so far) passes with it, and as corrections, with their new totals, the windows that were
    final before and got events in it. A batch that is run again replaces what it wrote. It reads the days it makes final or corrects, and no others.
    """
    sums = sums or []
    group = ["start", "end", *keys]
    total = [F.sum(c).alias(c) for c in ("n", *sums)]

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _watermark(spark, out, late, number)
        batch = batch.observe(watch := Observation(f"latest-{number}"), F.max(F.unix_millis(F.col(time).cast("timestamp"))).alias("latest"))
        part = batch.groupBy(F.window(F.col(time).cast("timestamp"), window).alias("w"), *keys).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums])
        part = part.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", *sums, F.to_date("w.start").alias("day"), F.lit(number).alias("batch_id"))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(f"{out}/parts")
        write_json(spark, f"{out}/times/batch-{number:09d}.json", {"latest": watch.get["latest"]})
        after = _watermark(spark, out, late, number + 1)
        if after is None:
            return
        parts = spark.read.parquet(f"{out}/parts").where(F.col("batch_id") <= number)
        ms, days = F.unix_millis("end"), F.col("day")
        # a window that closes now starts on no day after the new watermark, nor more than its length before the old one
        closing = parts.where((ms <= after) & (days <= F.to_date(F.timestamp_millis(F.lit(after)))))
        if before is not None:
            closing = closing.where((ms > before) & (days >= F.to_date(F.timestamp_millis(F.lit(before)) - F.expr(f"interval {window}"))))
        kinds = [closing.groupBy(*group).agg(*total).withColumn("status", F.lit("final"))]
        if before is not None:
            touched = parts.where((F.col("batch_id") == number) & (ms <= before)).select(*group, "day").distinct()
            late_days = [r["day"] for r in touched.select("day").distinct().collect()]  # a row for each date
            if late_days:
                old = parts.where(F.col("day").isin(late_days))
                kinds.append(old.join(touched, _same(old, touched, group), "left_semi").groupBy(*group).agg(*total).withColumn("status", F.lit("correction")))
        reduce(DataFrame.unionByName, kinds).write.mode("overwrite").parquet(f"{out}/versions/batch_id={number}")

    return events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _watermark(spark: SparkSession, out: str, late: int, number: int) -> int | None:
    """The watermark in ms before a batch; None before the first event."""
    times = [read_json(spark, f"{out}/times/{n}")["latest"] for n, _, _ in listed(spark, f"{out}/times") if n.endswith(".json") and int(n[6:-5]) < number]
    times = [t for t in times if t is not None]
    return max(times) - 1000 * late if times else None


def rollup_now(spark: SparkSession, out: str, keys: list[str], sums: list[str] | None = None, late: int = 86_400) -> DataFrame:
    """(start, end, keys..., n, sums..., status): what corrected_rollup knows: of each final window the latest version, and the open ones so far (status "open")."""
    group, values = ["start", "end", *keys], ["n", *(sums or [])]
    parts, mark = spark.read.parquet(f"{out}/parts"), _watermark(spark, out, late, 1 << 60)
    is_open = F.unix_millis("end") > mark
    now = parts.where(is_open).groupBy(*group).agg(*[F.sum(c).alias(c) for c in values]).withColumn("status", F.lit("open"))
    if not listed(spark, f"{out}/versions"):
        return now
    last = spark.read.parquet(f"{out}/versions").groupBy(*group).agg(F.max_by(F.struct(*values, "status"), "batch_id").alias("v"))
    return now.unionByName(last.select(*group, "v.*"))


def checkpoint_path(base: str, run_id: str, mode: str = "auto", named: str | None = None) -> str:
    """Where a run's progress lies. auto goes on; beginning and ignore start anew in a folder of their own; checkpoint goes on from a named run."""
    if mode not in RESUME_MODES:
        raise ValueError(f"unknown resume mode {mode}; there are {', '.join(RESUME_MODES)}")
    if mode in ("beginning", "ignore"):
        import uuid

        return f"{base.rstrip('/')}/{run_id}-{uuid.uuid4().hex[:8]}"
    return f"{base.rstrip('/')}/{named or run_id if mode == 'checkpoint' else run_id}"


def list_checkpoints(spark: SparkSession, base: str) -> list[tuple[str, int]]:
    """(run, modification time in ms) of the runs with progress, newest first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)), key=lambda x: (-x[1], x[0]))


def reset_checkpoint(spark: SparkSession, base: str, run_id: str) -> bool:
    """Forgets a run's progress; whether there was any."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{run_id}")
    return p.getFileSystem(conf).delete(p, True)


def _name(checkpoint: str) -> str:
    """A stream's name, from the folder of its progress."""
    return checkpoint.rstrip("/").rsplit("/", 1)[-1]


def run_stream(docs: DataFrame, stages: list[str], out: str, checkpoint: str, prints: str | None = None, compact_every: int = 64, **given: dict) -> StreamingQuery:
    """Documents through stages, batch after batch, into out/batch_id=<n>; all that is there already counts as earlier.

    A batch that is run again replaces its own folder and does not see it, so each document is handled once. Batches are
    handled one after another, which is the order that "first seen is kept" needs.

    prints: the folder of a fingerprint store through which global_dedup meets near copies of earlier batches (and of other runs that share the
    store): a batch is decided against it and within itself, and the fingerprints of what stays are a run of their own, which a batch that is run again
    replaces. Every compact_every batches the folders of earlier ones are merged.
    """
    ranks = given.get("global_dedup", {})
    ranked = bool(ranks.get("types") or ranks.get("sources"))

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = None
        try:
            seen = spark.read.parquet(f"{out}/kept")
            earlier = seen.where(F.col("batch_id") < number)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        options = {**given}
        if "exact_dedup" in stages and earlier is not None:
            options["exact_dedup"] = {**options.get("exact_dedup", {}), "store": earlier.select("seen_id").withColumnRenamed("seen_id", "doc_id")}
        store = None
        if prints and "global_dedup" in stages:
            store = FingerprintStore(spark, prints, run=f"{_name(checkpoint)}-batch{number}")
            if number and number % compact_every == 0:
                store.compact(least=2)
            options["global_dedup"] = {**options.get("global_dedup", {}), "store": store}
        # counted by the first action, which is the write
        done, watch = reports.observed(apply_stages(batch, stages, **options), stages, f"batch-{number}")
        done = done.persist()
        done.write.mode("overwrite").parquet(f"{out}/batches/batch_id={number}")
        seen = done.where("rejection is null or rejection.stage <> 'exact_dedup'")
        seen.select(F.col("doc_id").alias("seen_id")).write.mode("overwrite").parquet(f"{out}/kept/batch_id={number}")
        done.unpersist()
        if store is not None:
            store.add(spark.read.parquet(f"{out}/batches/batch_id={number}").where("rejection is null"), supersede=ranked)
        write_json(spark, f"{out}/progress/batch-{number:09d}.json", watch.get)

    return docs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def funnel(spark: SparkSession, out: str, stages: list[str]) -> list[dict]:
    """The funnel of all batches that run_stream has written, from their counters alone."""
    counts: Counter = Counter()
    for name, _, _ in listed(spark, f"{out}/progress"):
        if name.endswith(".json"):
            counts.update(read_json(spark, f"{out}/progress/{name}"))
    return reports.funnel_of(counts, stages) if counts else []


def progress(query: StreamingQuery) -> dict:
    """Rows and rates of the last batch."""
    p = query.lastProgress
    return {} if p is None else {"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_s": p.get("processedRowsPerSecond")}
