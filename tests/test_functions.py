import hashlib
import math
import re
import unicodedata
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.functions import hashing, pii, text
from granary.operators import gates

TEXTS = ["", " ", "a < b > c", "unclosed <p", "<b>x</b> y", "a b　c\x1cd\x85e  f", "é́ नि़", "é", "mail me@x.org or é@b.com", "1234 5678 9012", "1234-5678-9012 3", "x" * 300, "😀😀a", "word " * 900, "tab\tand\nline", "The the THE them"]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string").repartition(3)


def values(frame, c):
    return [r[1] for r in sorted(frame.select("i", c.alias("v")).collect())]


def test_text_functions(frame):
    c = F.col("text")
    assert values(frame, text.sanitize(c)) == [re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", t)).strip() for t in TEXTS]
    assert values(frame, text.nfc(c)) == [unicodedata.normalize("NFC", t) for t in TEXTS]

    def entropy(t):
        return -sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values()) if t else 0.0

    assert values(frame, text.char_entropy(c)) == pytest.approx([entropy(t) for t in TEXTS], abs=1e-9)

    def ratio(t, n=10):
        t = t[:5000]
        g = Counter(t[i : i + n] for i in range(0, len(t) - n + 1, n))
        return sum(v for v in g.values() if v > 1) / sum(g.values()) if len(t) >= 2 * n else 0.0

    assert values(frame, text.repeat_ratio(c)) == pytest.approx([ratio(t) for t in TEXTS])
    flat = [re.sub(r"\s+", " ", t).strip() for t in TEXTS]
    assert values(frame, text.chunks(c, 100, 10)) == [[t[i : i + 100] for i in range(0, len(t), 90)] for t in flat]
    with pytest.raises(ValueError):
        text.chunks(c, 10, 10)
    assert values(frame, text.path_segment(F.lit(" A b/c\\d "))) == ["a_b_c_d"] * len(TEXTS)


def test_hashes(frame):
    c = F.col("text")
    assert [bytes(v) for v in values(frame, hashing.sha256(c))] == [hashlib.sha256(t.encode()).digest() for t in TEXTS]
    assert values(frame, hashing.dup_group_id(hashing.sha256(c))) == [int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big", signed=True) for t in TEXTS]
    assert values(frame, hashing.dup_group_unsigned(hashing.sha256(c))) == [int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big") for t in TEXTS]

    def simhash(t):
        words = re.findall(r"\w{2,}", t.lower())[:2000]
        votes = [sum(1 if int(hashlib.md5(w.encode()).hexdigest()[:15], 16) >> b & 1 else -1 for w in words) for b in range(60)]
        return sum(1 << b for b, v in enumerate(votes) if v > 0) if words else None

    assert values(frame, hashing.simhash(c)) == [simhash(t) for t in TEXTS]
    signed = values(frame, hashing.minhash(c))
    a, b = hashing.minhash_rows(128)

    def plain(t):
        grams = {t[i : i + 5] for i in range(0, len(t) - 4, 5)} or {t}
        least = [2**64 - 1] * 128
        for g in grams:
            h = len(g) + 1
            for x in g:
                h = (h ^ ord(x)) * 0x9E3779B97F4A7C15 % 2**64
                h ^= h >> 29
            least = [min(m, (h * int(a[i]) + int(b[i])) % 2**64) for i, m in enumerate(least)]
        return [m >> 1 for m in least]

    assert signed == [plain(t) for t in TEXTS]
    assert hashing.bands(0.9, 128)[0] * hashing.bands(0.9, 128)[1] <= 128


def test_pii(frame):
    c = F.col("text")
    for d in pii.detectors():
        assert values(frame, pii.has(c, d.kind)) == [bool(re.search(d.pattern, t)) for t in TEXTS], d.kind
    assert values(frame, pii.redact(c, 0.9, ["email"]))[8] == "mail <PII:EMAIL> or é@b.com"
    # the Aadhaar number lies in a phone span: the more confident kind masks all of it
    assert values(frame, pii.redact(c, 0.8))[9] == "<PII:AADHAAR>"
    assert values(frame, pii.kinds(c, 0.9))[9] == ["aadhaar"]


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 8), st.sampled_from([0.5, 0.9])), max_size=5))
def test_redacted_keeps_what_no_span_covers(spans):
    t = "".join(chr(97 + i % 26) for i in range(40))
    spans = [("k", s, s + n, c) for s, n, c in spans]
    covered = {i for _, s, e, _ in spans for i in range(s, e)}
    assert pii.redacted(t, spans, lambda k: "") == "".join(x for i, x in enumerate(t) if i not in covered)


def test_tokens(frame):
    tokens = values(frame, gates.tokens_of(F.col("text")))
    plain = [i for i, t in enumerate(TEXTS) if t.isascii()]
    assert [tokens[i] for i in plain] == [re.findall(r"\w+|[^\w\s]", TEXTS[i]) for i in plain]
    scores = values(frame, gates.hapax_score(gates.tokens_of(F.col("text"))))
    n = Counter(tokens[15])
    assert scores[15] == pytest.approx(1 - 0.2 * sum(v == 1 for v in n.values()) / len(n)) and scores[0] is None
