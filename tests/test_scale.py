"""What lets runs grow: byte ranges, resumed runs, sketches, chains of near copies, counters, state."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary import storage
from granary.functions import hashing, text
from granary.operators import dedup, gates, quantiles, registry, reports
from granary.plans import config, ledger, pipeline
from granary.sinks import writers
from granary.sources import readers
from granary.streaming import jobs

PROSE = "A river runs past the old mill, where seven quiet boats wait for the morning wind to rise; nobody hurries. " * 3


# -- JSON lines by byte ranges --------------------------------------------------------------------


def test_one_file_has_many_readers(spark, tmp_path):
    r = random.Random(1)
    (tmp_path / "in" / "deep").mkdir(parents=True)
    want = []
    for name, n in (("b.jsonl", 3000), ("a.jsonl", 1), ("deep/c.jsonl", 700), ("empty.jsonl", 0), ("other.txt", 5)):
        lines = []
        for i in range(n):
            kind = r.random()
            lines.append("" if kind < 0.05 else "[1]" if kind < 0.1 else json.dumps({"id": f"{name}{i}", "text": "ä" * r.randrange(200)}, ensure_ascii=False))
            if kind >= 0.1 and name != "other.txt":
                want.append((f"{name}{i}", i + 1))
        body = "\n".join(lines) + ("\n" if n % 2 == 0 and n else "")
        (tmp_path / "in" / name).write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        splits = readers.text_splits(spark, [f"{tmp_path}/in"]).where(F.col("source_file").endswith("b.jsonl"))
        assert splits.select("split").distinct().count() > 20
        got = readers.read_source(spark, readers.SourceSpec("s", "local_jsonl", f"{tmp_path}/in")).collect()
        assert sorted((x["raw_id"], x["source_line"]) for x in got) == sorted(want)
        order = [x["source_file"].rsplit("/in/")[1] + ":" + str(x["source_line"]).zfill(6) for x in sorted(got, key=lambda x: x["seq"])]
        assert order == sorted(order) and len({x["seq"] for x in got}) == len(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    ids = lambda d: sorted(x["raw_id"] for x in readers.read_source(spark, readers.SourceSpec("s", "local_jsonl", d)).collect())
    one, two = f"{tmp_path}/in/a.jsonl", f"{tmp_path}/in/deep"
    assert ids([one, two, one]) == sorted(i for i, _ in want if not i.startswith("b.")) and ids(f"{tmp_path}/in/[ab].jsonl") == sorted(i for i, _ in want if i[0] in "ab")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ids(f"{tmp_path}/nowhere")
    with pytest.raises(ValueError, match="no dataset"):
        ids([])


# -- resumed runs ---------------------------------------------------------------------------------


def sources(folder, copies=1):
    for name, files in (("one", 3), ("two", 2)):
        (folder / name).mkdir(parents=True)
        for f in range(files):
            rows = [{"id": f"{name}{f}{i}", "text": f"{PROSE} Number {(7 * f + i) % 9}.", "license": "CC-BY"} for i in range(6)] + [{"text": "short", "license": "CC-BY"}, {"text": PROSE, "license": "GPL"}]
            (folder / name / f"{f}.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n")
    return [{"name": n, "kind": "local_jsonl", "dataset": str(folder / n)} for n in ("one", "two")]


def settings(tmp_path, out, **run):
    return config.parse({"run": {"run_id": "r", "out_dir": f"{tmp_path}/{out}", **run}, "sources": sources(tmp_path / "in") if not (tmp_path / "in").exists() else [{"name": n, "kind": "local_jsonl", "dataset": str(tmp_path / "in" / n)} for n in ("one", "two")], "policies": {}, "stages": ["license_gate", "sanitize", "exact_dedup", "quality_gate"]})


def result(spark, out):
    docs = sorted((r["source"], r["source_file"], r["text"]) for r in spark.read.parquet(f"{out}/docs").collect())
    log = sorted((r["source_file"], r["reason_code"], r["stage"]) for r in spark.read.json(f"{out}/rejections").collect())
    return docs, log


def test_a_killed_run_goes_on(spark, tmp_path, monkeypatch):
    whole = settings(tmp_path, "whole")
    plain = pipeline.run(spark, whole, at_ms=1, resume="ignore")
    cfg = settings(tmp_path, "out", checkpoint_every_bytes=1)
    commit, calls = ledger.Ledger.commit, []

    def dying(self, unit, rows, last):
        if len(calls) == 2:
            raise KeyboardInterrupt
        calls.append(unit.number)
        commit(self, unit, rows, last)

    monkeypatch.setattr(ledger.Ledger, "commit", dying)
    with pytest.raises(KeyboardInterrupt):
        pipeline.run(spark, cfg, at_ms=1)
    monkeypatch.undo()
    assert [(p["run"], p["units"], p["done"], p["rows"]) for p in ledger.progress(spark, f"{cfg.out_dir}/progress")] == [("r", 5, 2, 16)]
    # what is done is not opened again, and files that came later are not in the plan
    (tmp_path / "in" / "one" / "0.jsonl").write_text("not even json")
    (tmp_path / "in" / "one" / "9.jsonl").write_text('{"text": "later"}')
    kept = {n: at for n, _, at in storage.listed(spark, f"{cfg.out_dir}/work/r/unit=0")}
    manifest = pipeline.run(spark, cfg, at_ms=1)
    assert {n: at for n, _, at in storage.listed(spark, f"{cfg.out_dir}/work/r/unit=0")} == kept
    assert result(spark, cfg.out_dir) == result(spark, whole.out_dir)
    assert manifest["totals"] == plain["totals"] and manifest["stages"] == plain["stages"]
    seqs = [r["seq"] for r in spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{cfg.out_dir}/work/r").collect()]
    assert len(set(seqs)) == len(seqs) == 40
    # a finished run begins anew, another configuration does not go on with it
    again = pipeline.run(spark, cfg, at_ms=1)
    assert again["totals"]["processed"] == 33
    other = settings(tmp_path, "out", checkpoint_every_bytes=1)
    other.stages.remove("sanitize")
    with pytest.raises(ValueError, match="another configuration"):
        pipeline.run(spark, other, resume="checkpoint", named="r")
    assert ledger.run_named(spark, f"{cfg.out_dir}/progress", "x", "checkpoint", "r") == "r" == ledger.run_named(spark, f"{cfg.out_dir}/progress", "r", "checkpoint", "nothing")
    with pytest.raises(ValueError, match="unknown resume mode"):
        ledger.run_named(spark, "b", "r", "later")


def test_units_and_fingerprints(spark, tmp_path):
    """With a store, units are runs of their own to it; without one, stages that compare all documents get them in one unit."""
    cfg = settings(tmp_path, "out", checkpoint_every_bytes=1)
    cfg.stages[2] = "global_dedup"
    assert not pipeline.in_units(cfg)
    one = pipeline.run(spark, cfg, at_ms=1)
    assert len(ledger.progress(spark, f"{cfg.out_dir}/progress")) == 1
    cfg.fingerprints_path, cfg.out_dir = f"{tmp_path}/prints", f"{tmp_path}/out2"
    two = pipeline.run(spark, cfg, at_ms=1)
    assert one["totals"]["written"] == two["totals"]["written"] == 1  # all are near copies
    with_limit = [readers.SourceSpec("a", "local_jsonl", str(tmp_path / "in" / "one"), limit_docs=4), readers.SourceSpec("b", "local_jsonl", str(tmp_path / "in" / "one"))]
    assert [len(u.files) for u in ledger.cut(spark, with_limit, 1)] == [0, 1, 1, 1]
    sizes = [n for _, n in readers.source_files(spark, with_limit[0])]
    assert [len(u.files) for u in ledger.cut(spark, with_limit[1:], sizes[0] + sizes[1])] == [2, 1]


def test_checkpoints_of_the_command_line(spark, tmp_path, capsys):
    from granary.__main__ import main

    book = ledger.Ledger(spark, f"{tmp_path}/progress", "r1")
    specs = [readers.SourceSpec("a", "pdf", None), readers.SourceSpec("b", "pdf", None)]
    units = book.plan(specs, 10, "x")
    book.commit(units[0], 7, 6)
    assert main(["checkpoints", str(tmp_path)]) == 0 and "r1: 1 of 2 units, 7 rows" in capsys.readouterr().out
    assert book.plan(specs, 99, "x") == units and book.done()[0]["last_seq"] == 6
    assert main(["checkpoints", str(tmp_path), "--reset", "r1"]) == 0 and "forgotten" in capsys.readouterr().out and not book.done()


# -- quantiles ------------------------------------------------------------------------------------


@pytest.mark.parametrize("at_once", [1_000_000, 40])
def test_exact_quantiles(spark, at_once):
    r = np.random.default_rng(1)
    rows = [("even", float(x)) for x in r.normal(size=5000)] + [("copies", float(x)) for x in r.integers(0, 4, 3000)] + [("two", 1.0), ("two", 2.0), ("one", 7.0), ("none", None), (None, 3.5), (None, None)]
    rows += [("skewed", float(x)) for x in np.exp(r.normal(size=4000) * 4)]
    d = spark.createDataFrame(rows, "g string, x double").repartition(7)
    ps = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    names = [f"p{i}" for i in range(len(ps))]
    got = {x["g"]: [x[n] for n in names] for x in quantiles.exact(d, "x", ps, ["g"], names, at_once, 256, 0.04).collect()}
    assert len(got) == 7 and got.pop("none") == [None] * 6
    for g, values in got.items():
        own = np.array([x for k, x in rows if k == g and x is not None])
        assert np.allclose(values, np.quantile(own, ps), rtol=1e-12), g
    whole = quantiles.exact(d, "x", [0.5], None, ["m"], at_once).first()["m"]
    assert np.isclose(whole, np.median([x for _, x in rows if x is not None]))
    assert quantiles.exact(d.limit(0), "x", [0.5], ["g"], ["m"]).count() == 0


def test_brackets_that_miss_fall_back(spark):
    d = spark.range(1000).selectExpr("id % 2 g", "cast(id as double) x")
    got = {x["g"]: x["m"] for x in quantiles.exact(d, "x", [0.37], ["g"], ["m"], 10**6, 8, 0.0).collect()}
    assert all(np.isclose(got[g], np.quantile(np.arange(g, 1000, 2), 0.37)) for g in (0, 1))


def test_days_merge(spark, tmp_path):
    r = np.random.default_rng(2)
    rows = [(int(t), "ab"[i % 2], float(v)) for i, (t, v) in enumerate(zip(r.integers(0, 5 * 86_400_000, 6000), r.gamma(2, size=6000), strict=True))]
    events = spark.createDataFrame(rows, "timestamp_ms long, source string, v double").repartition(3)
    reports.daily_sketches(events, "v", ["source"]).write.partitionBy("date").parquet(f"{tmp_path}/days")
    days = spark.read.parquet(f"{tmp_path}/days")
    assert days.select("date").distinct().count() == 5
    for by in (["source"], None):
        out = quantiles.estimates(quantiles.merged(days, by), [0.1, 0.5, 0.99], by, ["a", "b", "c"]).collect()
        for x in out:
            own = np.sort([v for _, s, v in rows if not by or s == x["source"]])
            for name, p in (("a", 0.1), ("b", 0.5), ("c", 0.99)):
                assert abs(np.searchsorted(own, x[name]) / len(own) - p) <= 2 * quantiles.ERROR


# -- decisions, collisions, counters --------------------------------------------------------------


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n, tables = 100_000, []
    put = dedup.put
    monkeypatch.setattr(dedup, "put", lambda df, keep=None: tables.append(1) or put(df, keep))
    nodes = spark.range(n).withColumnRenamed("id", "seq")
    members = nodes.select("seq", F.col("seq").alias("bucket")).unionByName(nodes.where("seq > 0").select("seq", (F.col("seq") - 1).alias("bucket")))
    keep = dedup.greedy_keep(nodes, members)
    assert keep.where("keep = (seq % 2 = 0)").count() == n and len(tables) < 60


def test_greedy_of_random_buckets(spark):
    r = random.Random(3)
    for case in range(3):
        n = 60
        members = [(s, b) for b in range(45) for s in r.sample(range(n), r.choice([1, 2, 2, 2, 3, 9]))] + [(i, 1000 + i // 2) for i in range(20 * case)] + [(i + 1, 2000 + i) for i in range(10, 30)] + [(i, 2000 + i) for i in range(10, 30)]
        of = {}
        for s, b in members:
            of.setdefault(s, set()).add(b)
        taken, want = set(), set()
        for s in range(n):
            if not of.get(s, set()) & taken:
                want.add(s)
                taken |= of.get(s, set())
        got = dedup.greedy_keep(spark.range(n).withColumnRenamed("id", "seq"), spark.createDataFrame(members, "seq long, bucket long"))
        assert {x["seq"] for x in got.where("keep").collect()} == want


def test_the_store_signs_whole_texts(spark, tmp_path):
    """Two texts with 2000 words in common: both stay, in one run and in two."""
    head = " ".join(f"head{i % 700}" for i in range(2000))
    texts = [head + " " + " ".join(f"tail{i}x{j}" for j in range(6000)) for i in range(2)]
    d = spark.createDataFrame([(i, f"d{i}", t, "s") for i, t in enumerate(texts)], "seq long, doc_id string, text string, source string")
    store = dedup.FingerprintStore(spark, f"{tmp_path}/p", run="a")
    store.add(d.where("seq = 0"))
    later = dedup.FingerprintStore(spark, f"{tmp_path}/p", run="b")
    assert [r["keep"] for r in later.decide(d.where("seq = 1")).collect()] == [True]
    heads = dedup.FingerprintStore(spark, f"{tmp_path}/p", run="a", limit=2000)
    assert heads.version == "v2-2000-words" and heads.read("simhash").count() == 0
    heads.add(d.where("seq = 0"))
    assert [r["match_type"] for r in dedup.FingerprintStore(spark, f"{tmp_path}/p", run="b", limit=2000).decide(d.where("seq = 1")).collect()] == ["simhash"]
    assert later.read("simhash").count() == 1


def test_collisions(spark):
    r = random.Random(4)
    rows = [(r.randrange(40), f"s{r.randrange(70):02}") for _ in range(600)] + [(None, "s1"), (3, None)]
    got = {(x["source_a"], x["source_b"]): x["groups"] for x in reports.source_collisions(spark.createDataFrame(rows, "group int, source string").repartition(3)).collect()}
    sets = {}
    for g, s in rows:
        if g is not None and s is not None:
            sets.setdefault(g, set()).add(s)
    want = {}
    for s in sets.values():
        for a in s:
            for b in s:
                if a < b:
                    want[a, b] = want.get((a, b), 0) + 1
    assert got == want
    d = spark.createDataFrame([(0, PROSE, "a"), (1, PROSE + " Then it rained.", "b"), (2, "something else entirely that nobody has written " * 9, "c"), (3, PROSE, "c")], "seq long, text string, source string")
    m = reports.dedup_metrics(dedup.global_decisions(d, chunk=False, collisions=True)).first()
    assert m["total_checked"] == 4 and m["total_dropped"] >= 1 and m["cross_dataset_collisions"] == 0
    assert reports.dedup_metrics(spark.createDataFrame([("drop", "simhash", True), ("keep", None, False)], "action string, match_type string, collides boolean")).first()["cross_dataset_collision_rate_pct"] == 50


def raw(spark, texts):
    from granary.schema import RAW, from_raw

    return from_raw(spark.createDataFrame([(str(i), t, "s", None, "CC-BY", None, {}, "f", i, i) for i, t in enumerate(texts)], RAW))


def test_observed_counts_equal_the_funnel(spark):
    stages = ["license_gate", "exact_dedup", "quality_gate"]
    d = pipeline.apply_stages(raw(spark, [PROSE, PROSE, "short", PROSE + "x"]), stages)
    watched, watch = reports.observed(d, stages)
    watched.write.format("noop").mode("overwrite").save()
    assert reports.funnel_of(watch.get, stages) == [r.asDict() for r in reports.stage_funnel(d, stages).orderBy("stage_idx").collect()]


def test_python_functions_run_once_under_a_filter(spark):
    d = pipeline.apply_stages(raw(spark, [PROSE, "short"]), ["quality_gate", "pii_policy_gate"])
    for out in (reports.rejection_breakdown(reports.rejections(d)), d.where("rejection is null").select("doc_id", "entropy")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[0].count("_entropy(") <= 2 and plan.split("Initial Plan")[0].count("ArrowEvalPython") == 1, plan


def test_registered_transforms(spark):
    def strict(t):
        if "short" in t:
            raise ValueError("too plain")
        return t.upper()

    registry.register_transform("upper", strict)
    try:
        got = pipeline.apply_stages(raw(spark, ["abc", "short"]), ["upper", "exact_dedup"]).orderBy("seq").collect()
        assert [(r["text"], r["rejection"] and r["rejection"]["reason_detail"]) for r in got] == [("ABC", None), ("short", "too plain")]
    finally:
        registry.unregister_stage("upper")


# -- streams --------------------------------------------------------------------------------------


def stream(spark, path, batches, schema):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/{k:02}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}/in")


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_first_seen_equals_a_plain_loop(spark, tmp_path):
    r = random.Random(5)
    n, batches, place = 0, [], 0
    for k in range(4):
        rows = []
        for _ in range(25):
            rows.append((place, f"t{r.randrange(12)}", at(100 * k + r.randrange(90))))  # out of order within a batch
            place += 1
        batches.append(rows)
    docs = stream(spark, tmp_path, batches, "place long, text string, time timestamp")
    q = jobs.first_seen_stream(docs, "place", "time", 3600).writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).format("parquet").option("path", f"{tmp_path}/out").start()
    q.awaitTermination()
    first, want = {}, []
    for rows in batches:
        for p, t, when in sorted(rows, key=lambda x: (x[2], x[0])):
            want.append((p, first.setdefault(t, p), first[t] != p))
    got = [(x["place"], x["first_place"], x["repeat"]) for x in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == sorted(want) and n == 0


def test_state_of_old_texts_goes(spark, tmp_path):
    batches = [[(0, "a", at(0))], [(1, "b", at(10_000))], [(2, "c", at(20_000))], [(3, "a", at(20_001)), (4, "c", at(20_002))], [(5, "z", at(20_003))]]
    docs = stream(spark, tmp_path, batches, "place long, text string, time timestamp")
    q = jobs.first_seen_stream(docs, "place", "time", 600).writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).format("parquet").option("path", f"{tmp_path}/out").start()
    q.awaitTermination()
    got = {x["place"]: x["first_place"] for x in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 2, 5: 5}  # "a" was forgotten, "c" was not
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3


def test_streams_of_events_and_copies(spark, tmp_path):
    rows = [[(i, f"t{i % 3}", at(40_000 * (i % 4)), "ab"[i % 2]) for i in range(12)], [(12, "late", at(9 * 86_400), "a")]]
    schema = "place long, text string, time timestamp, kind string"
    docs = stream(spark, tmp_path, rows, schema)
    run = lambda df, name: df.writeStream.option("checkpointLocation", f"{tmp_path}/{name}c").trigger(availableNow=True).format("parquet").option("path", f"{tmp_path}/{name}").start().awaitTermination()
    run(jobs.rollup_stream(docs, "time", ["kind"]), "roll")
    got = {(str(x["date"]), x["kind"]): x["n"] for x in spark.read.parquet(f"{tmp_path}/roll").collect()}
    want = {}
    for _, _, t, k in rows[0]:
        want[str(t.date()), k] = want.get((str(t.date()), k), 0) + 1
    assert got == want
    run(jobs.dedup_stream(docs).select("place"), "once")
    run(jobs.dedup_stream(docs, time="time", within="1 day").select("place"), "within")
    for name in ("once", "within"):
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == 4


def test_counters_of_a_stream(spark, tmp_path):
    from granary.schema import RAW, from_raw

    rows = [[(str(i), PROSE if i % 3 else "short", "s", None, "CC-BY", None, {}, "f", i, i) for i in range(k, k + 4)] for k in (0, 4)]
    stages = ["exact_dedup", "quality_gate"]
    jobs.run_stream(from_raw(stream(spark, tmp_path, rows, RAW)), stages, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    want = [r.asDict() for r in reports.stage_funnel(spark.read.parquet(f"{tmp_path}/out/batches"), stages).orderBy("stage_idx").collect()]
    assert jobs.funnel(spark, f"{tmp_path}/out", stages) == want and want[0]["rejected_docs"] == 6


# -- what had no test -----------------------------------------------------------------------------


def test_small_reports(spark, tmp_path):
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    status = reports.source_status(t([("a", 2), ("b", 2), ("c", None)], "source string, files long"), t([("a", 2), ("b", 1)], "source string, shard_idx long"), t([("c", 5)], "source string, written long"))
    assert {r["source"]: r["status"] for r in status.collect()} == {"a": "complete", "b": "processing", "c": "complete"}
    big = [r[0] for r in spark.sql("select explode(array(1.0e30D, -1.0e30D, 5.0D)) x").select(text.clamp_long(F.col("x"))).collect()]
    assert big == [(1 << 63) - 1, -(1 << 63), 5]
    event = [("r", "quality_gate", "s", "pipeline", 86_400_000, {"input_docs": 2, "accepted_docs": 1, "rejected_docs": 1}, {"m": 1.5}, {})]
    events = t(event, "run_id string, stage string, source string, layer string, timestamp_ms long, counts map<string,long>, metrics map<string,double>, rejection_breakdown map<string,long>")
    writers.write_events(events, f"{tmp_path}/events")
    writers.write_events(events, f"{tmp_path}/events")
    again = writers.read_table(spark, f"{tmp_path}/events")
    writers.write_rollup(again, f"{tmp_path}/rollup")
    assert [(str(r["date"]), r["input_docs"]) for r in writers.read_table(spark, f"{tmp_path}/rollup").collect()] == [("1970-01-02", 4)]
    assert reports.daily_rollup(events, ["m"]).first()["m"] == 1.5
    shards = reports.shard_counts(spark, f"{tmp_path}/rollup").collect()
    assert sum(r["files"] for r in shards) >= 1 and all(r["bytes"] >= r["largest"] > 0 for r in shards)
    log = t([("a", 1), ("b", 3), ("c", 3)], "doc_id string, ts_ms long")
    assert [r["doc_id"] for r in reports.tail(log, 2).collect()] == ["b", "c"]
    (tmp_path / "c.yaml").write_text("a: [1]\n")
    (tmp_path / "e.yaml").write_text("")
    assert config.load_yaml(f"{tmp_path}/c.yaml") == {"a": [1]} and config.load_yaml(f"{tmp_path}/e.yaml") == {}
    found = t([("Bonjour à tous " * 9,), ("hi",), (None,)], "t string").select(readers.detect_language(F.col("t"), lambda x: "FRA")).collect()
    assert [r[0] for r in found] == ["fr", "en", "en"]


def test_pdf_defaults_of_the_configuration():
    cfg = config.parse({"run": {}, "policies": {}, "stages": [], "global": {"pdf": {"chunk_mode": "page", "extractor": "x", "nonsense": 1}}, "sources": [{"name": "a", "kind": "pdf", "extractor": "y"}, {"name": "b", "kind": "local_jsonl"}]})
    assert [(s.chunk_mode, s.extractor) for s in cfg.sources] == [("page", "y"), (None, None)]


def test_minhash_equals_a_plain_version(spark):
    texts = ["", "abc", PROSE, "日本語のテキスト、" * 7, None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(hashing.minhash(F.col("t"), 5, 16)).collect()]
    a, b = ([int(x) for x in row] for row in hashing.minhash_rows(16))
    for t, sig in zip(texts, got, strict=True):
        if t is None:
            assert sig is None
            continue
        grams = {t[i : i + 5] for i in range(0, len(t) // 5 * 5, 5)} if len(t) >= 5 else {t}
        hashes = []
        for g in grams:
            h = len(g) + 1
            for c in g:
                h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 % 2**64
                h ^= h >> 29
            hashes.append(h)
        assert sig == [min((h * x + y) % 2**64 for h in hashes) >> 1 for x, y in zip(a, b, strict=True)]


def test_near_dup_and_domain_stages(spark):
    d = raw(spark, [PROSE, PROSE + " And then.", "another text altogether, which has nothing in common with it " * 5])
    soft = gates_of(pipeline.apply_stages(d, ["near_dup_minhash"]))
    hard = gates_of(pipeline.apply_stages(d, ["near_dup_minhash"], near_dup_minhash={"hard_reject": True, "threshold": 0.5}))
    assert soft[2] == (None, "near_dup_minhash_v1") and hard[0][0] is None and hard[2][0] is None and hard[1][0] == "DUP_NEAR"
    label = lambda c: F.array(F.struct(F.lit("__label__water").alias("label"), F.when(c.contains("river"), 0.9).otherwise(0.1).alias("score")), F.struct(F.lit("__label__x").alias("label"), F.lit(0.4).alias("score")))
    assert [m for _, m in gates_of(gates.domain_tagging(d, 0, classifier=label))] == ["domain_tags_water_v1"] * 2 + ["domain_tags_none_v1"]


def gates_of(df):
    return [(r["rejection"] and r["rejection"]["reason_code"], r["transform_chain"][-1] if r["transform_chain"] else None) for r in df.orderBy("seq").collect()]
