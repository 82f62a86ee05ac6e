import pytest
from pyspark.sql import functions as F

from granary.operators import dedup, gates, registry, reports
from granary.plans.pipeline import apply_stages
from granary.schema import from_raw

PROSE = "A river runs past the old mill, where seven quiet boats wait for the morning wind to rise; nobody hurries. " * 3


def raw(spark, rows):
    """rows: (license, text[, source])."""
    full = [(str(i), r[1], r[2] if len(r) > 2 else "s", None, r[0], None, {}, "f.jsonl", i, i) for i, r in enumerate(rows)]
    return from_raw(spark.createDataFrame(full, "raw_id string, text string, source string, url string, license string, created_at string, extra map<string,string>, source_file string, source_line bigint, seq bigint"))


def reasons(df):
    return [r[1] for r in sorted(df.select("seq", "rejection.reason_code").collect())]


def test_license(spark):
    licenses = [None, "", "Unknown", "cc-by", "CC-BY", "CC-NC", "GPL"]
    d = apply_stages(raw(spark, [(x, PROSE) for x in licenses]), ["license_gate"])
    assert reasons(d) == ["LICENSE_DISALLOWED", "LICENSE_NOT_ALLOWED", "LICENSE_DISALLOWED", "LICENSE_NOT_ALLOWED", None, "LICENSE_DISALLOWED", "LICENSE_NOT_ALLOWED"]
    free = gates.LicensePolicy(allowed=[])
    assert spark.range(1).select(gates.license_reason(F.lit("GPL"), free)).first()[0] is None
    assert spark.range(1).select(gates.license_reason(F.lit(None).cast("string"))).first()[0] == "LICENSE_UNKNOWN"


def test_sample_of_a_run(spark):
    """As the sample's decisions: too short, entropy 0 and bad licenses go, the rest stays; the first rejecting stage counts."""
    rows = [("CC-BY", PROSE + str(i)) for i in range(7)] + [("CC-BY", "hello world"), ("All-Rights-Reserved", PROSE), ("CC-BY", "a" * 256), ("CC-NC", PROSE), ("CC-ND", PROSE), ("Public-Domain", PROSE + "z")]
    d = apply_stages(raw(spark, rows), ["license_gate", "sanitize", "exact_dedup", "quality_gate", "pii_policy_gate"]).persist()
    assert reasons(d) == [None] * 7 + ["TOO_SHORT", "LICENSE_DISALLOWED", "ENTROPY_OUT_OF_RANGE", "LICENSE_DISALLOWED", "LICENSE_DISALLOWED", None]
    funnel = {r["stage"]: r for r in reports.stage_funnel(d, ["license_gate", "sanitize", "exact_dedup", "quality_gate", "pii_policy_gate"]).collect()}
    assert (funnel["license_gate"]["rejected_docs"], funnel["quality_gate"]["rejected_docs"], funnel["pii_policy_gate"]["accepted_docs"]) == (3, 2, 8)
    assert all(r["accepted_docs"] + r["rejected_docs"] == r["input_docs"] for r in funnel.values())
    short = d.where("rejection.reason_code = 'TOO_SHORT'").first()
    assert short["entropy"] is None and short["chars"] == 11


def test_quality_borders(spark):
    d = apply_stages(raw(spark, [("x", PROSE[:200]), ("x", PROSE[:199]), ("x", "ab" * 150)]), ["quality_gate"], quality_gate={"policy": gates.QualityPolicy(200, 1.0, 7.8)})
    assert reasons(d) == [None, "TOO_SHORT", None]


def test_pii_policy(spark):
    rows = [("x", "nothing"), ("x", "a@b.org and c@d.org"), ("x", "id 1234 5678 9012 here"), ("x", "call 9876543210")]
    d = apply_stages(raw(spark, rows), ["pii_policy_gate"]).persist()
    assert reasons(d) == [None, None, "PII_AADHAAR", None]
    got = {r["seq"]: r for r in d.collect()}
    assert got[1]["text"] == "<PII:EMAIL> and <PII:EMAIL>" and got[1]["pii_types"] == ["email"] and got[1]["transform_chain"] == ["pii_redacted_v1"]
    assert got[3]["text"] == "call 9876543210" and not got[3]["pii_flag"] and got[3]["transform_chain"] == ["pii_none_v1"]
    assert got[2]["rejection"]["reason_detail"] == "policy_drop"
    low = apply_stages(raw(spark, rows), ["pii_policy_gate"], pii_policy_gate={"policy": gates.PiiPolicy(threshold=0.8, drop_kinds=["phone"])})
    assert reasons(low) == [None, None, "PII_PHONE", "PII_PHONE"]
    kept = apply_stages(raw(spark, rows), ["pii_policy_gate"], pii_policy_gate={"policy": gates.PiiPolicy(mode="allow")})
    assert reasons(kept) == [None] * 4


def test_curriculum_and_tokenize(spark):
    rows = [("x", "word " * n) for n in (10, 3685, 3686, 58982)]
    d = apply_stages(raw(spark, rows), ["tokenize", "curriculum_eligibility"])
    got = [r["transform_chain"] for r in d.orderBy("seq").collect()]
    assert got[1][0] == "tokenize_v1" and not any(m.startswith("eligible") for m in got[1])
    assert "eligible_windows=4096" in got[2] and "eligible_windows=4096,16384,65536" in got[3] and "risky_windows=65536" in got[3]
    assert got[0][-1] == "rep_ratio=1.000"
    bare = apply_stages(raw(spark, rows[:1]), ["tokenize"], tokenize={"tokenizer": "absent"}).first()
    assert bare["transform_chain"] == ["tokenize_skipped_no_adapter"] and bare["tokens"] is None


def test_dead_rows_do_not_shadow(spark):
    """A rejected first copy does not count as seen; a copy that later gates reject does."""
    rows = [("GPL", PROSE), ("CC-BY", PROSE), ("CC-BY", PROSE), ("CC-BY", "short"), ("CC-BY", " short ")]
    d = apply_stages(raw(spark, rows), ["license_gate", "sanitize", "exact_dedup", "quality_gate"])
    assert reasons(d) == ["LICENSE_NOT_ALLOWED", None, "DUP_EXACT", "TOO_SHORT", "DUP_EXACT"]


def test_simhash_pairs_equal_brute_force(spark):
    import random

    random.seed(5)
    base = [random.getrandbits(60) for _ in range(30)]
    sigs = base + [b ^ sum(1 << random.randrange(60) for _ in range(k)) for b in base for k in (1, 3, 4)] + base[:5]
    got = {(r["a"], r["b"], r["distance"]) for r in dedup.hamming_pairs(spark.createDataFrame([(s,) for s in sigs], "sig long")).collect()}
    want = {(min(a, b), max(a, b), (a ^ b).bit_count()) for a in set(sigs) for b in set(sigs) if a < b and (a ^ b).bit_count() <= 3}
    assert got == want and want


@pytest.mark.parametrize("edges", [[(0, 1), (1, 2)], [(0, i) for i in range(1, 9)], [(i, j) for i in range(6) for j in range(i)], [(i, i + 1) for i in range(12)], []])
def test_greedy_equals_a_sequential_pass(spark, edges):
    n = 14
    near = {i: {b if a == i else a for a, b in edges if i in (a, b)} for i in range(n)}
    kept: set = set()
    for i in range(n):
        if not near[i] & kept:
            kept.add(i)
    nodes = spark.range(n).withColumnRenamed("id", "seq")
    got = dedup.greedy_keep(nodes, dedup.buckets_of_edges(spark.createDataFrame(edges, "a long, b long")))
    assert {r["seq"] for r in got.where("keep").collect()} == kept and got.count() == n


def test_global_decisions_equal_a_sequential_pass(spark):
    import random

    r = random.Random(2)
    base = [[r.choice("river mill boat wind quiet morning seven stone green far".split()) + str(r.randrange(9)) for _ in range(60)] for _ in range(5)]
    texts = [" ".join(w if r.random() > 0.03 else "other" for w in r.choice(base)) for _ in range(30)] + ["", "", "!!", " ".join(base[0]), " ".join(base[0])]
    docs = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    from granary.functions import hashing

    sig = {x["seq"]: x["s"] for x in docs.select("seq", hashing.simhash(F.col("text")).alias("s")).collect()}
    bands = {}
    for x in dedup.minhash_bands(docs).collect():
        bands.setdefault(x["seq"], set()).add((x["band"], x["hash"]))
    kept, want = [], {}
    for i in range(len(texts)):
        sim = any(sig[i] is not None and sig[j] is not None and (sig[i] ^ sig[j]).bit_count() <= 3 for j in kept)
        near = any(bands[i] & bands[j] for j in kept)
        want[i] = "simhash" if sim else "minhash" if near else None
        if not want[i]:
            kept.append(i)
    got = {x["seq"]: x["match_type"] for x in dedup.global_decisions(docs, chunk=False).collect()}
    assert got == want and {"simhash", "minhash", None} == set(want.values())


def test_priority(spark):
    rank = lambda s, o: spark.range(1).select(dedup.priority_rank(F.lit(s), o)).first()[0]
    order = ["Books", " ", "wiki"]
    assert [rank(x, order) for x in (" books", "my-wiki-dump", "web", None)] == [0, 2, 3, 3] and rank("x", []) == 0


def test_store(spark, tmp_path):
    docs = spark.createDataFrame([(0, "a", PROSE, "web"), (1, "b", PROSE + "An entirely different ending that goes on about winter. " * 9, "books")], "seq long, doc_id string, text string, source string")
    store = dedup.FingerprintStore(spark, str(tmp_path / "prints"))
    assert store.read("exact") is None
    store.add(docs.where("seq = 0"))
    d = {r["seq"]: (r["keep"], r["match_type"]) for r in store.decide(docs, sources=["books", "web"]).collect()}
    assert d[0] == (False, "simhash") and d[1][0]
    assert {r["seq"]: r["keep"] for r in store.decide(docs.withColumn("source", F.lit("books")), sources=["books", "web"]).collect()}[0]


def test_store_and_priorities_in_the_stage(spark, tmp_path):
    words = [f"w{i}" for i in range(400)]
    body = lambda k: " ".join(w + str(k) for w in words)
    first = raw(spark, [("x", body(0), "web"), ("x", body(1), "web")])
    store = dedup.FingerprintStore(spark, str(tmp_path / "prints"), run="a")
    store.add(first)
    later = raw(spark, [("x", body(0), "web"), ("x", body(1), "books"), ("x", body(2), "web"), ("x", body(2), "books")])
    how = {"sources": ["books", "web"]}
    b = dedup.FingerprintStore(spark, str(tmp_path / "prints"), run="b")
    # a copy of an earlier run's goes, unless its source is better; in the run the first stays
    assert reasons(dedup.global_dedup(later, 0, store=b, **how)) == ["DUP_GLOBAL", None, None, "DUP_GLOBAL"]
    # chunks of the earlier run link the copy that stays
    assert [r["transform_chain"][-1] for r in dedup.global_dedup(later, 0, store=b, **how).where("seq = 1").collect()] == [f"global_dedup_keep_link_chunks={-(-len(body(1)) // 512)}_v1"]
    # a run does not meet its own documents, and repeating it adds none
    assert reasons(dedup.global_dedup(first, 0, store=store)) == [None, None]
    n = store.spark.read.parquet(f"{store.path}/simhash").count()
    store.add(first)
    assert store.spark.read.parquet(f"{store.path}/simhash").count() == n == 2


def test_a_row_that_raises_is_rejected(spark):
    def strict(t):
        if t == "abc":
            raise ValueError("no abc")
        return t[:1]

    d = gates.python_stage(raw(spark, [("x", "abc"), ("x", "abcd"), ("x", "")]), 0, "strict", strict)
    got = d.orderBy("seq").select("text", "rejection.stage", "rejection.reason_code", "rejection.reason_detail").collect()
    assert [tuple(r) for r in got] == [("abc", "runtime_error", "RUNTIME_ERROR", "no abc"), ("a", None, None, None), ("", None, None, None)]


def test_registry():
    with pytest.raises(ValueError, match="unknown stage"):
        registry.get_stage("nope")
    registry.register_stage("mine", lambda df, idx: df)
    with pytest.raises(ValueError):
        registry.register_stage("mine", lambda df, idx: df)
    registry.unregister_stage("mine")
    assert registry.out_of_order(["quality_gate", "exact_dedup"]) == [("quality_gate", "exact_dedup")]


def test_global_decisions_read_whole_texts(spark):
    head = " ".join(f"head{i % 700}" for i in range(2000))
    rows = [(i, head + " " + " ".join(f"tail{i}x{j}" for j in range(6000))) for i in range(3)] + [(3, head)]
    d = spark.createDataFrame(rows, "seq long, text string")
    action = lambda **how: [r["action"] for r in dedup.global_decisions(d, minhash=False, chunk=False, **how).orderBy("seq").collect()]
    assert action() == ["keep"] * 4
    assert action(limit=dedup.hashing.SIMHASH_WORDS) == ["keep"] + ["drop"] * 3  # the reference's cap
