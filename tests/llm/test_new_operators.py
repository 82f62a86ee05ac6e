"""Periodic runs, divergence of sources and main texts, held against plain versions."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from granary.llm import html_main_text, periodic_runs, queries, source_divergence

sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


# -- periodic runs --------------------------------------------------------------------------------


def plain_runs(w):
    """Every stretch that no neighbour extends, by comparing all places for every period."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            smallest = next(d for d in range(1, q + 1) if all(w[k] == w[k + d] for k in range(i, j + q - d)))
            if smallest == q and length >= max(6, 4 * q):
                out.add((i, length, q))
            i = j
    return sorted(out)


def repeating(r):
    out = []
    while len(out) < r.randrange(1, 120):
        base = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.randrange(1, 9))]
        out += (base * r.randrange(1, 8))[: r.randrange(1, 60)]
        if r.random() < 0.2:
            out = (out * r.randrange(1, 6))[:300]
    return out


def test_runs_equal_all_comparisons():
    r = random.Random(3)
    for _ in range(1500):
        w = repeating(r)
        assert periodic_runs.runs_of(np.array(w)) == plain_runs(w), w
    assert periodic_runs.runs_of(np.array([], np.int64)) == []
    assert periodic_runs.runs_of(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    long = [r.randrange(10**6) for _ in range(9000)]
    assert periodic_runs.runs_of(np.array(long * 4 + [-1])) == [(0, 36_000, 9000)]


def test_texts_are_probed_together(spark):
    r = random.Random(4)
    texts = [None, "", " \t\r\n", "a", "a " * 5, "a " * 6, "x y " * 4, "x y " * 3, "\xa0 " * 8, "1 " * 7 + "\x00" + " 2" * 9, "ab " * 50_000] + [" ".join(map(str, repeating(r))) for _ in range(80)]
    rows = [(i, t, i, "runs") for i, t in enumerate(texts + texts[:20])]
    out = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, n_words int, collapsed string").repartition(3))
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"] and out.count() == len(rows)
    for o in out.collect():
        words = periodic_runs.WORD.findall((texts + texts[:20])[o["doc_id"]] or "")
        want = plain_runs(words) if len(words) < 10_000 else [(0, 50_000, 1)]
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert [tuple(x) for x in o["runs"]] == want and o["n_words"] == len(words)
        assert o["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
    empty = periodic_runs.periodic_runs(spark.createDataFrame([], "a int, text string"))
    assert empty.columns == ["a", "text", "n_words", "runs", "collapsed"] and empty.count() == 0


def test_runs_query(spark, tmp_path):
    r = random.Random(5)
    texts = [None, "", "  "] + [" ".join(r.choice("a b c d e".split()) for _ in range(r.randrange(1, 90))) for _ in range(150)]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {o["doc_id"]: o for o in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        o = got.pop(i)
        assert o["n_runs"] == len(runs) and (o["start"], o["length"], o["period"]) == best
        assert o["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert o["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)) and o["collapsed_sha256"] == sha(" ".join(x for k, x in enumerate(w) if k not in gone))
    assert not got and planted > 5


# -- divergence of sources ------------------------------------------------------------------------


def plain_divergence(rows, least, alpha, top):
    words, langs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate({65 + i: 97 + i for i in range(26)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        words[lang or "", source or ""].update(terms)
        langs[lang or ""].update(set(terms))
    out = set()
    for lang, df in langs.items():
        kept = [t for t, n in df.items() if n >= least]
        groups = {s: c for (x, s), c in words.items() if x == lang}
        share = lambda c, t: 1 + 10**9 * (c[t] + alpha) // (sum(c[x] for x in kept) + alpha * len(kept))
        whole = sum(groups.values(), Counter())
        p = {s: {t: share(c, t) for t in kept} for s, c in groups.items()}
        q = {t: share(whole, t) for t in kept}
        for s, c in groups.items():
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[:most], 1)}
    return out


@pytest.mark.parametrize("width", [8, 64, 1 << 18])
def test_divergence_equals_the_plain_sums(spark, width):
    """The narrowest sketch lets nearly all terms through, the widest nearly none too many; results are the same."""
    r = random.Random(6)
    vocabulary = ["The", "the", "ÉTÉ", "été", "日本", "a", "b1c", "x_y", "don't", "ß"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [(None, None, None), ("", "en", "s1"), ("12 3 ;", "en", "only"), ("word " * 40, "xx", "s9"), (None, "en", "s2"), ("alone", "yy", None)]
    for i in range(260):
        weights = [1 / (1 + (k * (i % 4 + 1)) % 37) for k in range(len(vocabulary))]
        rows.append((" ".join(r.choices(vocabulary, weights, k=r.randrange(0, 60))), r.choice(["en", "en", "de", None]), f"s{i % 4}"))
    rows += rows[20:30]
    d = spark.createDataFrame([(t, lang, s, 1, "x") for t, lang, s in rows], "text string, lang string, source string, term int, value string").repartition(5)
    got = {tuple(x) for x in source_divergence.source_divergence(d, 8, 5, 6, width).collect()}
    assert got == plain_divergence(rows, 8, 5, 6)
    assert {x[2] for x in got} == {"pair", "term"}


def test_divergence_of_nothing(spark):
    d = spark.createDataFrame([], "text string, lang string, source string")
    assert source_divergence.source_divergence(d, width=64).count() == 0


def test_sketches_never_underestimate(spark):
    r = random.Random(7)
    rows = [(" ".join(f"t{chr(97 + r.randrange(26))}{chr(97 + int(r.random() ** 3 * 26))}" for _ in range(40)), r.choice("ab"), "s") for _ in range(200)]
    d = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    n = Counter((lang, t) for text, lang, _ in rows for t in set(source_divergence.terms_of(text.encode())))
    for width in (32, 1 << 12):
        bits = np.frombuffer(source_divergence.sketch_bits(d, 9, width), np.uint8)
        may = lambda lang, t: (bits[(at := source_divergence._cells(lang.encode(), [t], width)[0]) >> 3] >> (7 - (at & 7)) & 1).all()  # noqa: B023, E731
        assert all(may(*k) for k, v in n.items() if v >= 9)
        passed = sum(bool(may(*k)) for k in n)
    assert passed < 0.8 * len(n)  # a wide one drops most of the others


def test_terms_of_slices_equal_a_pattern():
    """Terms end with their text, whatever the next one begins with; slices of arrays and nulls count in their places."""
    odd = [None, "", "ab", "cd", " x", "y ", "", "É", "é", None, "1", "Zz\x00zZ", "a\u00a0b", "[\\]^_`{|}~\x7f@AZaz", "日本 ß", "w" * 5000]
    pattern = re.compile(rb"[A-Za-z\x80-\xff]+")
    for type_ in (pa.string(), pa.large_string(), pa.binary()):
        for a, n in ((0, len(odd)), (3, 8), (0, 2), (5, 0)):
            owner, terms = source_divergence.split(pa.array([x if x is None or type_ != pa.binary() else x.encode() for x in odd], type_).slice(a, n))
            want = [(i, t) for i, x in enumerate(odd[a : a + n]) for t in pattern.findall((x or "").encode().lower())]
            assert list(zip(owner.tolist(), terms.to_pylist(), strict=True)) == want


def test_a_slice_makes_no_object_a_term():
    """Counting a slice takes a fraction of the CPU time that a pattern and a dictionary for each text take, and counts the same."""
    r = random.Random(8)
    vocabulary = [f"{r.choice(['Ab', 'é', 'x'])}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i % 6]}" for i in range(3000)]
    texts, groups = [" ".join(r.choices(vocabulary, k=300)) for _ in range(2000)], np.arange(2000) % 7
    array, seconds = pa.array(texts), []
    for _ in range(3):
        a = time.process_time()
        terms, group, term, n, docs = source_divergence.tallied(array, groups)
        b = time.process_time()
        occurrences, documents = Counter(), Counter()
        for g, x in zip(groups.tolist(), texts, strict=True):
            for t, k in Counter(re.findall(rb"[A-Za-z\x80-\xff]+", x.encode().lower())).items():
                occurrences[g, t] += k
                documents[g, t] += 1
        seconds.append((b - a, time.process_time() - b))
    names = terms.to_pylist()
    keys = [(g, names[t]) for g, t in zip(group.tolist(), term.tolist(), strict=True)]
    assert dict(zip(keys, n.tolist(), strict=True)) == occurrences and dict(zip(keys, docs.tolist(), strict=True)) == documents
    assert min(x for x, _ in seconds) < 0.6 * min(y for _, y in seconds)


def test_no_partial_counts_are_written(spark, monkeypatch):
    """What is written has a row for each term of a source at most, however many tasks count it."""
    rows = [(f"one two three {'abcd'[i % 4]}", "en", f"s{i % 3}") for i in range(240)]
    d = spark.createDataFrame(rows, "text string, lang string, source string").repartition(8)
    sizes, plain = [], source_divergence.written

    def counted(*args):
        sizes.append((out := plain(*args)).count())
        return out

    monkeypatch.setattr(source_divergence, "written", counted)
    got = {tuple(x) for x in source_divergence.source_divergence(d, 8, width=1 << 10).collect()}
    assert got == plain_divergence(rows, 8, 5, 50)
    triples = len({(lang, s, t) for text, lang, s in rows for t in text.split()})
    assert max(sizes[:-1]) <= triples


# -- main texts -----------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="with-sidebar"><header class=top><h1>The Site</h1><p>A, slogan, with, commas</p></header>
<nav><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></nav><div id="cookie-notice">We use cookies, yes, really, all of them, on, every, page.</div>
<div class="wrap"><div class="sideBar"><p>Beside, it, all, with, many, many, commas, in, it, and, more</p></div>
<article class="post"><header><h1>A  headline</h1></header><p>First paragraph, with &amp; and &eacute; and &#x4e2d;&nbsp;&lt;x&gt;.<p><b>Second,<br>
broken <a href=x>link</a>.<p>Third.</b><div class="advert">Buy this, now, cheaply, please</div><ul><li>one<li>two <i>words</i></ul>
<form><input name=q><label>Your mail</label></form><script>var p = "<p>no</p>";</script><table><tr><td>a<td>b</table><aside>Aside, that, is</aside><footer>Filed under</footer></article>
<section id="comments"><article class="comment"><p>I, a reader, think, that, this, comment, has, more, commas, than, the, whole, article, above, it, by, far, far, far</p></article></section></div><footer>&copy; all</footer>"""


def test_main_text_of_a_page():
    assert html_main_text.main_text(PAGE).split("\n") == ["A headline", "First paragraph, with & and é and 中 <x>.", "Second, broken link.", "Third.", "one", "two words", "a", "b"]


def test_best_container_without_marks():
    """No article element: points decide, headline and siblings come along, the list of links does not."""
    text = "A sentence of some length, with commas, that goes on and on, as sentences of articles do, for a while. "
    page = f"<div><div><a href=1>one</a> <a href=2>two, three</a> <a href=3>four</a></div><div><h1>Head</h1><div>{''.join(f'<p>{i} {text * 2}</p>' for i in range(3))}<ul><li><a href=a>x</a><li><a href=b>y</a><li><a href=c>z</a></ul></div><p>{text * 2}</p></div><div><p>Short.</p></div></div>"
    lines = html_main_text.main_text(page).split("\n")
    assert lines[0] == "Head" and [x[0] for x in lines[1:4]] == ["0", "1", "2"] and len(lines) == 5


def test_pages_that_are_odd(spark):
    odd = [None, "", "  \n ", "plain &lt;text", "<p>only", "<", "<div", "<!-- open", "<nav><a href=x>y</a></nav>", "<p>a<br><br>b<br>c</p>", "</p></div>x", "<div>" * 50_000 + "deep" + "</b>" * 1000, "<article><p>" + "long, " * 200_000, "<pre>a\n\n b</pre>"]
    want = ["", "", "", "plain <text", "only", "<", None, None, "", "a\nb c", "x", "deep", ("long, " * 200_000).strip(), "a b"]
    rows = spark.createDataFrame([(i, h, "old", 7) for i, h in enumerate(odd + odd)], "page_id int, html string, text string, other int").repartition(3)
    out = html_main_text.extract_main_text(rows)
    assert out.columns == ["page_id", "html", "text", "other", "n_chars"] and out.count() == 2 * len(odd)
    for r in out.collect():
        w = want[r["page_id"] % len(odd)]
        assert (w is None or r["text"] == w) and r["n_chars"] == len(r["text"]), odd[r["page_id"] % len(odd)]
    assert html_main_text.extract_main_text(rows.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_html_main_text"])
def test_queries_equal_sql(spark, name):
    data = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    want = con.execute(queries.ORACLES[name]).fetch_df()
    got = queries.QUERIES[name](spark, data).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted(map(tuple, want.itertuples(index=False))) and len(got)
