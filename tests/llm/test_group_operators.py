"""Exact and near deduplication, vectors, quality, sharding and the pipeline, held against brute force."""

import hashlib
import os
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import components, exact_dedup, omh_dedup, pq_dedup, quality_gam, sharding

WORDS = [a + b for a in "ba ke li mo nu sa te vi".split() for b in "ra den lin mor tus vel".split()]


def prose(seed, n):
    r = random.Random(seed)
    return [r.choice(WORDS) + str(r.randrange(30)) for _ in range(n)]


def edited(words, k, seed):
    r, out = random.Random(seed), list(words)
    for _ in range(k):
        at = r.randrange(len(out))
        out[at : at + r.randrange(2)] = [f"new{r.randrange(999)}"][: r.randrange(2)] or ["q"]
    return out


# -- exact ----------------------------------------------------------------------------------------


def test_grace_groups_spill_and_recurse(tmp_path, monkeypatch):
    import tempfile

    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    r = random.Random(1)
    rows = [(f"text {r.randrange(700)}".encode() * 20, r.choice([None, r.randrange(10_000)]), 1) for _ in range(4000)]
    want: dict = {}
    for c, k, n in rows:
        g = want.setdefault(c, [None, 0])
        g[0] = k if g[0] is None else max(g[0], k if k is not None else g[0])
        g[1] += n
    for limit in (1 << 30, 20_000, 500):
        got = list(exact_dedup.grace_groups(iter(rows), limit))
        assert {c: [k, n] for c, k, n in got} == want and len(got) == len(want)
    # one hash for all: contents still tell them apart, and the recursion ends
    assert len(list(exact_dedup.grace_groups(iter(rows[:300]), 500, hash_of=lambda c: 7))) == len({c for c, _, _ in rows[:300]})
    assert not os.listdir(tmp_path)


def test_exact_dedup(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "a"), (None, "z"), (7, "A"), (8, "a ")]
    d = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, keep_id string, kept boolean").repartition(4)
    got = sorted((r["doc_id"] or -1, r["text"] or "", r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(d, limit=1).collect())
    assert got == sorted([(1, "a", 2, 4, False), (2, "a", 2, 4, True), (2, "a", 2, 4, True), (3, "", 4, 2, False), (4, "", 4, 2, True), (-1, "a", 2, 4, False), (-1, "z", None, 1, True), (7, "A", 7, 1, True), (8, "a ", 8, 1, True)], key=lambda x: (x[0], x[1], x[2] or 0))
    sha = {r["text"]: r["text_sha256"] for r in exact_dedup.exact_dedup(d).collect()}
    assert sha["a"] == hashlib.sha256(b"a").hexdigest()
    kept = exact_dedup.drop_exact(d)
    assert kept.columns == d.columns and sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "z"), (2, "a"), (4, ""), (7, "A"), (8, "a ")]
    assert exact_dedup.exact_dedup(d.limit(0)).count() == 0 == exact_dedup.drop_exact(d.limit(0)).count()


# -- near duplicates ------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_alignment_equals_the_full_table():
    r = random.Random(3)
    for _ in range(3000):
        k = r.choice([2, 3, 8])
        a = [r.randrange(k) for _ in range(r.randrange(14))]
        b = list(a) if r.random() < 0.6 else [r.randrange(k) for _ in range(r.randrange(14))]
        for _ in range(r.randrange(5)):
            b.insert(r.randrange(len(b) + 1), r.randrange(k))
        d = distance(a, b)
        assert all(omh_dedup.within(a, b, n) == (d <= n) for n in range(8))
    a = prose(1, 900)
    assert omh_dedup.similar(a, edited(a, 60, 2)) and not omh_dedup.similar(a, prose(2, 900))


def test_words_and_shingles_equal_plain_ones():
    texts = ["Hello, World! hello", "", "  ", "###", "a b c d e f g", "é à ß", "x", "a a a a a a a a"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    words, counts = omh_dedup.word_hashes(raw, ends)
    plain = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower()) for t in texts]
    assert counts.tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len({*zip(flat, words.tolist(), strict=True)}) == len(set(flat)) == len(set(words.tolist()))
    found, each = omh_dedup.shingles(words, counts)
    assert each.tolist() == [max(1, n - 4) if n else 0 for n in counts]
    assert len(set(found[-4:].tolist())) == 4  # repeats of a shingle are labelled


def test_far_texts_have_no_link_to_near_ones():
    r = random.Random(6)
    seen = Counter()
    for _ in range(400):
        centre = [r.randrange(30) for _ in range(r.randint(4, 25))]

        def changed(words, share):
            out = list(words)
            for _ in range(int(share * len(words))):
                at = r.randrange(len(out) + 1)
                out[at : at + r.randrange(2)] = [r.randrange(30)] * r.randrange(2)
            return out

        others = [changed(centre, r.random()) for _ in range(8)]
        places = [omh_dedup.place(centre, x, 0.8) for x in others]
        seen.update(places)
        for x, p in zip(others, places, strict=True):
            assert (p == omh_dedup.NEAR) == (distance(centre, x) <= int(0.2 * max(len(centre), len(x)) + 1e-9))
            if p == omh_dedup.FAR:
                assert not any(omh_dedup.similar(x, y) for y, q in zip(others, places, strict=True) if q == omh_dedup.NEAR)
    assert min(seen.values()) > 100 and len(seen) == 3


def brute_classes(texts):
    """Smallest index reachable by copies and edit similarity of at least 0.8."""
    words = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower()) for t in texts]
    best = list(range(len(texts)))
    near = lambda i, j: (words[i] == words[j] if words[i] or words[j] else (texts[i] or "") == (texts[j] or "")) or bool(words[i] and words[j]) and distance(words[i], words[j]) <= int(0.2 * max(len(words[i]), len(words[j])) + 1e-9)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if near(i, j)]
    while True:
        before = list(best)
        for i, j in pairs:
            best[i] = best[j] = min(best[i], best[j])
        if best == before:
            return best


def near_texts():
    texts = []
    for s in range(8):
        base = prose(s, 60)
        texts += [" ".join(base)] + [" ".join(edited(base, 3, 50 + s * 9 + k)) for k in range(4)]
    chain = prose(77, 80)
    for k in range(5):  # neighbours are similar, the ends are not
        texts.append(" ".join(chain))
        chain = edited(chain, 9, k)
    shared = prose(99, 25)
    texts += [" ".join(shared + prose(200 + k, 60)) for k in range(12)]
    return texts + [texts[0].upper() + "!", None, "", "###", "$$$", "###", "one two", "One, two", "x " * 3000, "x " * 3100]


def test_near_classes_equal_brute_force(spark, monkeypatch):
    texts = near_texts()
    order = list(range(len(texts)))
    random.Random(5).shuffle(order)
    d = spark.createDataFrame([(i, texts[i], 1, b"") for i in order], "doc_id long, text string, node int, words binary").repartition(5)
    want = brute_classes([t if not (t or "").startswith("x x") else "x " * (150 if len(t) == 6000 else 155) for t in texts])
    for block in (2, 256):  # small blocks: several for each bucket
        monkeypatch.setattr(omh_dedup, "BLOCK", block)
        monkeypatch.setattr(omh_dedup, "HUB", 4 * block)
        out = omh_dedup.near_classes(d).collect()
        assert {r["doc_id"]: r["class_id"] for r in out} == dict(enumerate(want))
    sizes = Counter(want)
    assert all(r["class_size"] == sizes[r["class_id"]] and r["kept"] == (r["doc_id"] == r["class_id"]) for r in out)
    kept = omh_dedup.drop_near(d)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def scattered(words, k, seed):
    out = list(words)
    for i in random.Random(seed).sample(range(len(out)), k):
        out[i] = f"sub{seed}x{i}"
    return out


def test_near_classes_reach_the_stated_similarity(spark):
    """Links of short texts, and of longer ones with scattered edits down to similarity 0.8."""
    pairs = [(n, k) for n, k in ((5, 1), (9, 1), (10, 1), (12, 1), (14, 2), (19, 3), (40, 8), (63, 12), (100, 15), (100, 20), (400, 80)) for _ in range(10)]
    texts = []
    for s, (n, k) in enumerate(pairs):
        base = prose(5000 + s, n)
        texts += [" ".join(base), " ".join(scattered(base, k, s))]
    base = prose(9000, 9)
    texts += [" ".join(base), " ".join(base[:4] + base[5:])]  # one word less
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in omh_dedup.near_classes(d).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_keys_are_the_smallest_shingles_in_the_order_of_the_text():
    """Against a plain sort; texts whose blocks change places keep few keys, though they keep nearly all their shingles."""
    r = random.Random(8)
    texts = [[f"w{r.randrange(5000)}" for _ in range(n)] for n in (51, 64, 100, 600, 3000) + (600,) * 20]

    def keys(texts, length):
        raw = [" ".join(t).encode() for t in texts]
        found, n = omh_dedup.shingles(*omh_dedup.word_hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw])), omh_dedup.SHINGLE)
        return omh_dedup.sketches(found, n, 80, length), np.split(found, np.cumsum(n)[:-1])

    for length in (2, 3):
        got, found = keys(texts[:5], length)
        for i, f in enumerate(found):
            for s in range(0, 80, 9):
                value = omh_dedup.mix(f ^ omh_dedup.SEEDS[s])
                first = np.sort(np.argsort(value)[:length])
                want = omh_dedup.mix((value[first] * omh_dedup.PLACES[:length]).sum(dtype=np.uint64, keepdims=True) ^ omh_dedup.SEEDS[128 + s])
                assert got[i, s] == want[0]
    blocks = [[t[k : k + 30] for k in range(0, 600, 30)] for t in texts[5:]]
    mine, _ = keys(texts[5:], 2)
    turned, _ = keys([sum(b[::-1], []) for b in blocks], 2)
    shuffled, _ = keys([sum(r.sample(b, len(b)), []) for b in blocks], 2)
    assert (mine == turned).mean() < 0.1 and (mine == shuffled).mean() < 0.5


def test_clusters_replace_buckets_where_that_is_less_work(spark):
    many = [(b, n, n) for b in range(9) for n in range(30) if n == 0 or (b + n) % 3]  # the same texts again and again
    chain = [(100 + b, 1000 + b + i, 1000 + b + i) for b in range(20) for i in range(2)]
    rows = spark.createDataFrame(many + chain, "bucket long, node long, component long")
    got = omh_dedup.clustered(rows).collect()
    by = {}
    for r in got:
        by.setdefault(r["bucket"], set()).add(r["node"])
    assert sorted(map(len, by.values())) == [2] * 20 + [30] and len(got) == 70


def test_clusters_meet_under_the_hub_of_their_hubs(spark):
    """The same texts in buckets of three hubs, of which each other one lies in a bucket of the first, are compared once."""
    rows = [(h * 10 + b, n, n) for h in range(3) for b in range(9) for n in range(40) if n == h or n > 2 and (b + n) % 9 or (h, b) == (0, n)]
    got = omh_dedup.clustered(spark.createDataFrame(rows, "bucket long, node long, component long")).collect()
    assert len({r["bucket"] for r in got}) == 1 and len(got) == 40


def test_a_node_is_sent_once_to_each_block(spark, monkeypatch):
    monkeypatch.setattr(omh_dedup, "BLOCK", 64)
    rows = [(1, n, n // 2) for n in range(64)] + [(2, n, n // 2) for n in range(200)] + [(3, n, min(n, 50)) for n in range(150)] + [(4, n, 0) for n in range(9)]
    sent = omh_dedup.in_blocks(spark.createDataFrame(rows, "bucket long, node long, component long")).collect()
    assert Counter(r["bucket"] for r in sent) == {1: 64, 2: 200 * 4, 3: 50 * (1 + 2) + 100}
    units = {}
    for r in sent:
        units.setdefault((r["bucket"], r["left"], r["right"]), []).append(r)
    met = {(k[0], *sorted((a["node"], b["node"]))) for k, u in units.items() for a in u for b in u if a is not b and (k[1] == k[2] or a["side"] != b["side"])}
    inside = {(b, n, m) for b, n, c in rows for x, m, d in rows if b == x and n < m and c == d}
    assert met | inside == {(b, n, m) for b, n, _ in rows for x, m, _ in rows if b == x and n < m}


def test_small_buckets_are_not_parted_by_length(spark, monkeypatch):
    monkeypatch.setattr(omh_dedup, "BLOCK", 32)
    counts = [(n, 100 + 20 * n) for n in range(64)]
    members = spark.createDataFrame([(1, n, n) for n in range(32)] + [(2, n, n) for n in range(64)], "bucket long, node long, component long")
    got = omh_dedup.parted(members, spark.createDataFrame(counts, "node long, n int"), 0.8).collect()
    assert sum(r["bucket"] == 1 for r in got) == 32 and len(got) == 32 + 128
    by = {}
    for r in got:
        by.setdefault(r["bucket"], set()).add(r["node"])
    n = dict(counts)
    assert all(any({a, b} <= x for x in by.values()) for a in n for b in n if 0.8 * n[b] <= n[a] <= n[b])


def test_short_links_share_a_key():
    r = random.Random(3)
    for n in range(5, omh_dedup.SHORT):
        for k in {1, n // 5}:
            a = prose(n, n)
            for trial in range(10):
                b = list(a)
                at = range(2, n, max(2, n // k))[:k] if trial == 0 else r.sample(range(n), k)  # evenly spaced edits leave the shortest pieces
                for i in sorted(at, reverse=True):
                    b[i : i + 1] = [[f"q{trial}"], []][trial % 2]
                pair = [np.array([zlib.crc32(w.encode()) for w in t], np.uint64) for t in (a, b)]
                x, y = omh_dedup.keyed(np.concatenate(pair), np.array([len(p) for p in pair]))
                assert set(x.tolist()) & set(y.tolist()), (n, k, trial)


def test_shuffled_keys_are_gone_before_words_are_shuffled(spark, monkeypatch):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {n for i in range(found.size()) if (n := found.apply(i).getName()).startswith("shuffle_")}

    before, left, worded = files(), [], omh_dedup.worded

    def watched(*a):
        until = time.time() + 15
        while (now := files() - before) and time.time() < until:
            time.sleep(0.2)
        left.append(now)
        return worded(*a)

    monkeypatch.setattr(omh_dedup, "worded", watched)
    d = spark.createDataFrame([(i, " ".join(prose(i // 2, 80))) for i in range(40)], "doc_id long, text string").repartition(3)
    assert omh_dedup.near_classes(d).where("kept").count() == 20
    assert left == [set()]


def test_near_classes_of_odd_rows(spark):
    d = spark.createDataFrame([(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "z")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["class_id"] or -1, r["class_size"], r["kept"]) for r in omh_dedup.near_classes(d).collect())
    assert got == [(-1, -1, 1, True), (-1, 2, 3, False), (2, 2, 3, False), (2, 2, 3, True)]
    assert omh_dedup.near_classes(d.limit(0)).count() == 0


def test_drop_near_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "z"), (None, "z"), (0, "z y"), (3, None), (3, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in omh_dedup.drop_near(d).collect())
    assert got == [(False, 0, "z y"), (False, 1, "a b c d e f"), (False, 3, ""), (True, 0, "z")]


def test_block_bound_loses_nothing():
    rows = [(i, i, np.array([zlib.crc32(w.encode()) for w in re.findall(r"\w+", t)], "<u4").tobytes()) for i, t in enumerate(near_texts()) if t and re.search(r"\w", t) and len(t) < 2000]
    words = {i: np.frombuffer(b, "<u4").tolist() for i, _, b in rows}
    pairs = {(i, j) for i in words for j in words if i < j and distance(words[i], words[j]) <= int(0.2 * max(len(words[i]), len(words[j])) + 1e-9)}
    edges = omh_dedup.compare_blocks(rows, rows, 0.8)
    assert all((min(e), max(e)) in pairs for e in edges)
    up = {i: i for i in words}

    def root(x):
        return x if up[x] == x else root(up[x])

    for a, b in edges:
        up[root(a)] = root(b)
    assert all(root(i) == root(j) for i, j in pairs)


# -- components -----------------------------------------------------------------------------------


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(9, i) for i in range(9)] + [(20, 21), (22, 21), (5, 5)], []])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    best = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in edges:
        for a, b in edges:
            if a != b:
                best[a] = best[b] = min(best[a], best[b])
    assert got == best


# -- vectors --------------------------------------------------------------------------------------


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(12, 16))
    x = np.concatenate([base[r.integers(0, 12, 240)] + 0.25 * r.normal(size=(240, 16)), r.normal(size=(60, 16))]).astype(np.float32)
    x[5] = x[4]
    x[7] = 2 * x[6]
    rows = [(i, v.tolist(), 1, "n") for i, v in enumerate(x)]
    rows += [(900, None, 1, "n"), (901, [0.0] * 16, 1, "n"), (902, [float("nan")] * 16, 1, "n"), (903, [1.0] * 15 + [None], 1, "n"), (904, [], 1, "n"), (905, [1.0, 2.0], 1, "n"), (906, [float("inf")] * 16, 1, "n")]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int, n_links string").repartition(3)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    link = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    comp = np.arange(len(x))
    for _ in range(60):
        comp = np.minimum(comp, np.where(link, comp, 10**6).min(1))
    for how in ({"probes": "certain", "lists": 9, "block": 16}, {"lists": 5}):
        got = {v["vec_id"]: v for v in pq_dedup.near_vectors(d, 0.9, **how).collect()}
        assert len(got) == len(rows)
        links = np.array([got[i]["n_links"] for i in range(len(x))])
        if "probes" in how:  # certain probes: nothing is missed
            assert (links == link.sum(1)).all() and all(got[i]["component_id"] == comp[i] for i in range(len(x)))
        else:
            assert links.sum() >= 0.9 * link.sum() and (links <= link.sum(1)).all()
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] and got[i]["component_id"] == i for i in range(900, 907))
    assert pq_dedup.near_vectors(d.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(v["n_links"], v["component_id"]) for v in pq_dedup.near_vectors(twice).collect()] == [(3, 1)] * 4


def link_counts(x):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    return (u @ u.T >= 0.9).sum(1) - 1


def test_vectors_of_low_rank_lose_no_link(spark):
    """Links that point in few of the dimensions cross borders upright."""
    r = np.random.default_rng(4)
    x = (r.normal(size=(3000, 6)) @ r.normal(size=(6, 64))).astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    for how in ({}, {"lists": 23, "block": 200}):
        got = {v["vec_id"]: v["n_links"] for v in pq_dedup.near_vectors(d, 0.9, **how).collect()}
        assert [got[i] for i in range(len(x))] == link_counts(x).tolist()


def test_codes_are_read_before_vectors():
    """Estimates come from table lookups, off by what the codes miss at most; vectors are read of members that these leave."""
    r = np.random.default_rng(9)
    x = r.normal(size=(1500, 32))
    x[1400:] = x[:100] + r.normal(size=(100, 32)) * 0.1
    q = pq_dedup.Quantizer.fit(x, 7, 0.9)
    u = pq_dedup._unit(x)
    home, visits = q.lists(u)
    codes, missed = q.encode(u, home)
    which = int(np.bincount(home).argmax())
    at = np.flatnonzero(home == which)
    estimate = sum(t[codes[at, m]] for m, t in enumerate(q.tables(which, u)))
    assert (np.abs(estimate - u[at] @ u.T) <= missed[at, None] + 1e-5).all()
    read = []

    class Watched(pq_dedup.Rows):
        def unit(self, at):
            read.append(at)
            return super().unit(at)

    side = lambda kind, a: kind(a, np.ones(len(a), int), x[a], home[a], codes[a], missed[a], [visits[i] for i in a])
    for far, members in ((True, side(Watched, at)), (False, side(Watched, at))):
        read.clear()
        queries = side(pq_dedup.Rows, at)
        if far:
            queries.given = -queries.given
        found = list(pq_dedup.compare(q, which, 0.9, members, queries, not far, True))
        assert bool(found) != far and sum(len(a) for a in read) < (1 if far else len(at) // 2 + 200)


@pytest.mark.parametrize("rank,lists", [(64, 40), (12, 40), (6, 60), (2, 30)])
def test_measured_probes_reach_the_links(spark, rank, lists):
    """All links, of vectors whose links point in all dimensions or in few; probes of even vectors are short of the certain ones."""
    r = np.random.default_rng(rank)
    centres = r.normal(size=(60, rank))
    x = ((centres[r.integers(60, size=3000)] + r.normal(size=(3000, rank)) * 0.25) @ r.normal(size=(rank, 64))).astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist(), 1, 2) for i, v in enumerate(x)], "vec_id long, embedding array<float>, __embedding int, vector int")
    out = pq_dedup.near_vectors(d, 0.9, lists=lists)
    assert out.columns == ["vec_id", "embedding", "__embedding", "vector", "n_links", "component_id", "kept"]
    got = {v["vec_id"]: v["n_links"] for v in out.collect()}
    want = link_counts(x)
    have = np.array([got[i] for i in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.999 * want.sum() > 3000


def test_vectors_of_every_dimension_link(spark):
    r = np.random.default_rng(6)
    rows, want = [], []
    for n, d in ((300, 8), (150, 4), (40, 3), (2, 5), (1, 6)):
        x = r.normal(size=(n, d)).astype(np.float32)
        if n == 2:
            x[1] = x[0] * [1, 1, 1, 1, 1.01]
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(x)]
        want += link_counts(x).tolist()
    assert want[490:] == [1, 1, 0]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for how in ({}, {"block": 100}):  # one index and groups in a task; two indexes
        got = {v["vec_id"]: v["n_links"] for v in pq_dedup.near_vectors(d, 0.9, **how).collect()}
        assert [got[i] for i in range(len(rows))] == want


# -- quality --------------------------------------------------------------------------------------


def quality_rows(n=900):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = prose(i, 20 + i % 40)
        text = " ".join(x.upper() + "!!" for x in w) if bad and i % 8 else " ".join([w[0]] * 60) if bad else " ".join(w) + "."
        rows.append((i, text))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_learns_and_holds_out(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows + [(5000, None), (5001, ""), (None, "x"), (5002, "word " * 20_000)], "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(labels + [(1, 1, 0), (2, None, 0), (None, 0, 0), (7777, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_gam.train(docs, known)
    got = {r["doc_id"]: r for r in quality_gam.classified(docs, model).collect()}
    out = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(out)) for i, _ in rows) and 100 < len(out) < 350
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in out]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values()) and got[5000]["score"] == got[5001]["score"]
    # held-out labels change nothing
    flipped = known.withColumn("quality", F.when(quality_gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_gam.train(docs, flipped)
    assert again.intercept == model.intercept and all((a == b).all() for a, b in zip(again.tables, model.tables, strict=True))
    assert quality_gam.train(docs, known.limit(0)).score(np.zeros((1, len(quality_gam.NAMES))))[0] > 0.99
    assert quality_gam.classified(docs.limit(0), model).count() == 0


def plain_boosting(x, y, rounds, pair_rounds, pairs):
    """The same model in plain loops: borders, tables and the pairs' tables."""
    import math

    n, width = len(y), len(x[0])
    cuts = []
    for i in range(width):
        v = sorted(r[i] for r in x)
        cuts.append(sorted({v[math.ceil(q / quality_gam.BINS * (n - 1) - 1e-9)] for q in range(1, quality_gam.BINS)}))
    place = [[sum(c <= r[i] for c in cuts[i]) for i in range(width)] for r in x]
    total = [math.log(sum(y) / (n - sum(y)))] * n
    tables = [[0.0] * (len(c) + 1) for c in cuts]
    coarse = [[min(k * quality_gam.PAIR_BINS // len(t), quality_gam.PAIR_BINS - 1) for k in range(len(t))] for t in tables]
    value = lambda rows: sum(g for g, _ in rows) / (sum(h for _, h in rows) + quality_gam.RIDGE)
    gain = lambda rows: sum(g for g, _ in rows) ** 2 / (sum(h for _, h in rows) + quality_gam.RIDGE)

    def slopes():
        p = [1 / (1 + math.exp(-t)) for t in total]
        return [(a - b, b * (1 - b)) for a, b in zip(y, p, strict=True)]

    for _ in range(rounds):
        for i in range(width):
            cells = [(0.0, 0.0)] * len(tables[i])
            for r, (g, h) in zip(place, slopes(), strict=True):
                cells[r[i]] = (cells[r[i]][0] + g, cells[r[i]][1] + h)
            leaves = [(0, len(cells))]
            while len(leaves) < quality_gam.LEAVES:
                won, a, m, b = max(((gain(cells[a:m]) + gain(cells[m:b]) - gain(cells[a:b]), a, m, b) for a, b in leaves for m in range(a + 1, b)), default=(0, 0, 0, 0))
                if won <= 1e-9:
                    break
                leaves = [q for q in leaves if q != (a, b)] + [(a, m), (m, b)]
            step = {k: quality_gam.RATE * value(cells[a:b]) for a, b in leaves for k in range(a, b)}
            tables[i] = [t + step[k] for k, t in enumerate(tables[i])]
            total = [t + step[r[i]] for t, r in zip(total, place, strict=True)]

    def quadrants(i, j):
        cells: dict = {}
        for r, s in zip(place, slopes(), strict=True):
            cells.setdefault((coarse[i][r[i]], coarse[j][r[j]]), []).append(s)
        every = [s for c in cells.values() for s in c]
        best, steps = 0.0, lambda a, b: 0.0
        for p in range(1, quality_gam.PAIR_BINS):
            for q in range(1, quality_gam.PAIR_BINS):
                box: dict = {}
                for (a, b), c in cells.items():
                    box.setdefault((a >= p, b >= q), []).extend(c)
                won = sum(map(gain, box.values())) - gain(every)
                if won > best + 1e-12:
                    v = {k: value(c) for k, c in box.items()}
                    best, steps = won, lambda a, b, p=p, q=q, v=v: v.get((a >= p, b >= q), 0.0)
        return best, steps

    chosen = sorted(((quadrants(i, j)[0], i, j) for i in range(width) for j in range(i)), reverse=True)[:pairs]
    found = {(i, j): np.zeros((quality_gam.PAIR_BINS,) * 2) for _, i, j in chosen}
    for _ in range(pair_rounds):
        for (i, j), t in found.items():
            steps = quadrants(i, j)[1]
            t += [[quality_gam.RATE * steps(a, b) for b in range(quality_gam.PAIR_BINS)] for a in range(quality_gam.PAIR_BINS)]
            total = [v + quality_gam.RATE * steps(coarse[i][r[i]], coarse[j][r[j]]) for v, r in zip(total, place, strict=True)]
    return tables, found, [1 / (1 + math.exp(-t)) for t in total]


def test_boosting_equals_plain_loops(monkeypatch):
    monkeypatch.setattr(quality_gam, "ROUNDS", 6)
    monkeypatch.setattr(quality_gam, "PAIR_ROUNDS", 3)
    monkeypatch.setattr(quality_gam, "PAIRS", 2)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(160, 4))
    y = ((x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=160) / 2) > 0).astype(float)
    model = quality_gam.fit(x, y)
    tables, pairs, scores = plain_boosting(x.tolist(), y.tolist(), 6, 3, 2)
    assert [len(t) for t in tables] == [len(t) for t in model.tables]
    assert all(np.allclose(a, b) for a, b in zip(tables, model.tables, strict=True))
    assert list(pairs) == [(i, j) for i, j, _ in model.pairs] and all(np.allclose(pairs[i, j], t) for i, j, t in model.pairs)
    assert np.allclose(scores, model.score(x))


def test_scores_replace_columns_and_repeated_rows_stay(spark):
    rows, labels = quality_rows(200)
    d = spark.createDataFrame([(i, t, 9.0, "x") for i, t in rows + rows[:2]], "doc_id long, text string, score double, held_out string")
    out = quality_gam.classified(d, quality_gam.train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    assert len(out) == 202 and all(r["score"] <= 1 and r["held_out"] in (True, False) for r in out)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(v) == 1 for v in by.values())


# -- sharding -------------------------------------------------------------------------------------


def test_shards_are_those_of_the_largest_score(spark):
    import math
    import struct

    import xxhash

    def shard(key, weights):
        h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        u = lambda s: ((xxhash.xxh64_intdigest(struct.pack("<i", s), h) >> 11) + 0.5) / 2**53
        return max(range(len(weights)), key=lambda s: (-weights[s] / math.log(u(s)), -s))

    d = spark.range(-500, 3000).withColumnRenamed("id", "doc_id")
    for w, grown in ([1.0] * 16, [1.0] * 17), ([3.0, 1.0, 0.5], [3.0, 1.0, 0.5, 2.0]):
        for r in sharding.assign_shards(d, "doc_id", w, grown).collect():
            assert (r["shard"], r["grown_shard"]) == (shard(r["doc_id"], w), shard(r["doc_id"], grown))


def test_sharding(spark):
    rows = [(i, "é" * (i % 7) if i % 5 else None, "s", 3) for i in range(6000)] + [(None, "x", "s", 3), (4, None, "s", 3), (4, None, "s", 3)]
    d = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int").repartition(5)
    out = sharding.shard_documents(d, [1.0] * 16, [1.0] * 17).collect()
    assert len(out) == len(rows)
    slots: dict = {}
    for r in out:
        b = (r["text"] or "").encode()
        assert r["size"] == len(b) + 1 and r["text_crc32"] == zlib.crc32(b) and r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(300 < len(v) < 460 for v in slots.values()) and 250 < sum(r["grown_shard"] == 16 for r in out) < 460
    half = Counter(r["shard"] for r in sharding.assign_shards(d.drop("shard"), "doc_id", [3.0, 1.0]).collect())
    assert 0.7 < half[0] / len(rows) < 0.8
    assert sharding.shard_documents(d.limit(0), [1.0] * 2).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("doc_id"), [1.0, 0.0])


# -- pipeline -------------------------------------------------------------------------------------


def test_pipeline_equals_plain_steps(spark, tmp_path):
    import corpus_pipeline
    from granary.llm.quality_gam import NAMES, features

    rows, labels = quality_rows(240)
    rows += [(1000 + i, rows[1][1]) for i in range(5)] + [(2000 + k, " ".join(edited(rows[3][1].split(), 1, k))) for k in range(4)] + [(3000, None)]
    table = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    fit = [(i, q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    text = dict(rows)
    model = quality_gam.fit(np.array([features(text[i]) for i, _ in fit], float), np.array([q for _, q in fit], float))
    good = [i for i, t in rows if model.score(np.array([features(t)], float).reshape(1, len(NAMES)))[0] >= 0.7]
    last = {}
    for i in sorted(good):
        last[text[i] or ""] = i
    left = sorted(last.values())
    classes = brute_classes([text[i] for i in left])
    kept = {left[c] for c in classes}
    assert {r["doc_id"] for r in out} == kept and len(kept) < len(left) < len(good) < len(rows)
    names = [n for n, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert names == ["quality", "exact_dedup", "near_dedup", "packing"]
    assert all(f(spark, docs, str(tmp_path)).columns == docs.columns for _, f in corpus_pipeline.STAGES[:3])


def test_pipeline_of_odd_tables(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "THRESHOLD", 0.0)  # every odd row reaches the later stages
    rows, labels = quality_rows(240)
    schema = "doc_id long, text string, score string, row int, digest string, content string, sequence_id string"
    odd = [(*r, "s", 1, "d", "c", "q") for r in [*rows, rows[1], (900, " ".join(prose(5, 30_000)) + "."), (None, None), (901, "")]]
    for name, t in (("some", odd), ("none", [])):
        spark.createDataFrame(t, schema).repartition(2).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    d = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, d, f"{tmp_path}/some").columns == d.columns
    got = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 900) > 30_000
    assert sorted(r["piece"] for r in got if r["doc_id"] == rows[1][0]) == [0]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
