"""The fingerprint store over several runs, streams that use it, rollups with late events."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from granary import storage
from granary.operators import dedup
from granary.schema import RAW, from_raw
from granary.sinks import writers
from granary.streaming import jobs

RANKS = {"sources": ["books", "wiki", "web"]}


def body(k, n=300):
    return " ".join(f"w{i}k{k}" for i in range(n))


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "seq long, doc_id string, text string, source string")


def run_of(spark, path, name, rows, ranks=RANKS):
    """One run: decide, then store what stays; the ids that stay."""
    docs, store = rows_of(spark, rows), dedup.FingerprintStore(spark, path, run=name)
    if store.read("exact") is None:
        kept = docs
    else:
        d = store.decide(docs, **ranks)
        kept = docs.join(d.where("keep"), "seq", "left_semi")
    ids = sorted(r["doc_id"] for r in kept.collect())
    store.add(kept, supersede=bool(ranks))
    return ids


def alive(spark, path):
    return {t: sorted({r["doc_id"] for r in dedup.FingerprintStore(spark, path).read(t).collect()}) for t in dedup.FingerprintStore.TABLES}


def test_a_better_document_supersedes(spark, tmp_path):
    path = f"{tmp_path}/p"
    assert run_of(spark, path, "a", [(0, "web0", body(0), "web"), (1, "web1", body(1), "web")]) == ["web0", "web1"]
    # run b: a better copy of web0 stays, an equal one of web1 goes
    assert run_of(spark, path, "b", [(0, "wiki0", body(0) + " more", "wiki"), (1, "web1b", body(1) + " more", "web"), (2, "web2", body(2), None)]) == ["web2", "wiki0"]
    assert set(map(tuple, alive(spark, path).values())) == {("web1", "web2", "wiki0")}
    notes = dedup.FingerprintStore(spark, path).superseded().collect()
    assert [tuple(r) for r in notes] == [("web0", "web", "wiki0")]
    # run c: wiki0 counts, not web0 behind it, and the best replaces it; web0 comes back, from a better source
    third = [(0, "wiki0c", body(0), "wiki"), (1, "web0", body(0), "books"), (2, "web2c", body(2), "web")]
    assert run_of(spark, path, "c", third) == ["web0", "web2c"]
    assert alive(spark, path)["exact"] == ["web0", "web1", "web2c"]
    # begun anew with nothing, it leaves nothing behind, its notes neither
    dedup.FingerprintStore(spark, path, run="c").add(rows_of(spark, []), supersede=True)
    assert set(map(tuple, alive(spark, path).values())) == {("web1", "web2", "wiki0")}


def test_compaction_keeps_what_counts(spark, tmp_path):
    path = f"{tmp_path}/p"
    for k in range(3):
        dedup.FingerprintStore(spark, path, run=f"r {k}/x").add(rows_of(spark, [(0, f"d{k}", body(k, 30), "web"), (1, f"e{k}", body(k + 10, 30), None)]))
    store = dedup.FingerprintStore(spark, path, run="r 2/x")
    dedup.FingerprintStore(spark, path, run="r 1/x").append("superseded", spark.createDataFrame([("e0", None, "run-r 0/x", "d1")], "doc_id string, source string, of_run string, by_doc_id string"))
    state = lambda: ({t: sorted(map(str, store.read(t).drop("run").distinct().collect())) for t in ("exact", "minhash")}, store.superseded().collect())
    before = state()
    assert len(before[0]["exact"]) == 3 and len(store.runs()) == 3 and store.compact(least=9) == 0 and store.compact(least=2, up_to=0) == 0
    assert store.compact(least=2) == 2 and len(store.runs()) == 2  # its own stays as it is
    assert state() == before and store._rows("superseded").count() == 0
    # a compaction that stopped before it deleted leaves rows twice; the next one removes them
    merged = next(x for x in store.runs() if x.startswith("run-merged"))
    spark.read.parquet(f"{path}/exact/fingerprint_version=v2/run={merged}").write.parquet(f"{path}/exact/fingerprint_version=v2/run=run-merged-again")
    assert store.read("exact").count() == 6 and store.compact(least=2) == 2 and store.read("exact").count() == 3 and state() == before


def test_chunks_of_earlier_documents_are_cut_out(spark):
    first, own = body(0, 400)[:1536], body(1, 400)[:1024]
    texts = [first, own + first[:512] + "the end", first[512:1024] + first[:512]]
    raw = spark.createDataFrame([(str(i), t, "s", None, "CC-BY", None, {}, "f", i, i) for i, t in enumerate(texts)], RAW)
    how = {"simhash": False, "minhash": False}
    plain = dedup.global_dedup(from_raw(raw), 0, **how).orderBy("seq").collect()
    cut = dedup.global_dedup(from_raw(raw), 0, drop_chunks=True, **how).orderBy("seq").collect()
    assert [r["text"] for r in plain] == texts and [r["text"] for r in cut] == [first, own + "the end", ""]
    assert [r["transform_chain"] for r in plain] == [r["transform_chain"] for r in cut]


def batches_of(spark, folder, batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(f"{folder}/in/{k:02}")
    return from_raw(spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in"))


def test_near_copies_in_a_stream(spark, tmp_path, monkeypatch):
    r, rows = random.Random(2), []
    for i in range(12):
        words = body(r.randrange(4)).split()
        words[r.randrange(300)] = f"new{i}"
        rows.append((str(i), " ".join(words), "s", None, "CC-BY", None, {}, "f", i, i))
    stages = ["exact_dedup", "global_dedup"]
    decisions = lambda df: sorted((x["seq"], x["rejection"]["reason_code"] if x["rejection"] else None, x["transform_chain"][-1]) for x in df.collect())
    whole = from_raw(spark.createDataFrame(rows, RAW))
    from granary.plans.pipeline import apply_stages

    want = decisions(apply_stages(whole, stages))
    assert {x[1] for x in want} == {None, "DUP_GLOBAL"}
    docs = batches_of(spark, tmp_path, [rows[:6], rows[6:]])
    start = lambda: jobs.run_stream(docs, stages, f"{tmp_path}/out", f"{tmp_path}/c", prints=f"{tmp_path}/prints", compact_every=1)
    # the second batch ends after its fingerprints are stored and before it is committed
    write, died = jobs.write_json, []

    def dying(spark, path, value):
        if path.endswith("batch-000000001.json") and not died:
            died.append(path)
            raise OSError("lost")
        write(spark, path, value)

    monkeypatch.setattr(jobs, "write_json", dying)
    try:
        start().awaitTermination()
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    assert died
    start().awaitTermination()
    assert decisions(spark.read.parquet(f"{tmp_path}/out/batches").drop("batch_id")) == want
    store = dedup.FingerprintStore(spark, f"{tmp_path}/prints")
    assert store.read("exact").count() == sum(x[1] is None for x in want) and len(store.runs()) == 2


def test_late_events_correct_rollups(spark, tmp_path):
    r, start, rows = random.Random(3), dt.datetime(2024, 1, 1), []
    for i in range(300):
        rows.append((start + dt.timedelta(seconds=r.randrange(6 * 86_400)), r.choice(["a", "b", None]), r.randrange(9)))
    rows += [(None, "a", 1)]
    r.shuffle(rows)
    schema = "time timestamp, kind string, size long"
    for k in range(5):
        spark.createDataFrame(rows[61 * k : 61 * (k + 1)], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k:02}")
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    jobs.corrected_rollup(events, "time", ["kind"], out, f"{tmp_path}/c", ["size"]).awaitTermination()
    plain, sizes, latest = Counter(), Counter(), max(t for t, _, _ in rows if t)
    for t, k, s in rows:
        if t:
            plain[t.date(), k] += 1
            sizes[t.date(), k] += s
    got = jobs.rollup_now(spark, out, ["kind"], ["size"]).collect()
    assert {(x["start"].date(), x["kind"]): (x["n"], x["size"]) for x in got} == {g: (plain[g], sizes[g]) for g in plain} and len(got) == len(plain)
    is_open = lambda day: dt.datetime.combine(day, dt.time()) + dt.timedelta(days=2) > latest
    assert all((x["status"] == "open") == is_open(x["start"].date()) for x in got)
    # a window is final once; what comes later for it is a correction of a later batch with a larger total
    seen = {}
    for x in spark.read.parquet(f"{out}/versions").orderBy("batch_id").collect():
        seen.setdefault((x["start"], x["kind"]), []).append((x["n"], x["status"]))
    assert any(len(v) > 1 for v in seen.values())
    assert all([n for n, _ in v] == sorted({n for n, _ in v}) for v in seen.values())
    # a batch that is run again replaces what it wrote
    before = sorted(map(str, spark.read.parquet(f"{out}/versions").collect()))
    storage.delete(spark, f"{tmp_path}/c/commits/4", f"{tmp_path}/c/commits/.4.crc")
    jobs.corrected_rollup(events, "time", ["kind"], out, f"{tmp_path}/c", ["size"]).awaitTermination()
    assert sorted(map(str, spark.read.parquet(f"{out}/versions").collect())) == before
