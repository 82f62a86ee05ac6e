"""SentencePiece, token files, packing, chat and WARC, held against libraries and plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from granary.llm import chat, packing, sentencepiece_bpe, token_files, tokenizing, warc

SCHEMA = "doc_id long, text string, lang string, ids int, start int"
HARD = [None, "", " ", "a", "  a  b ", "▁▁ x", "\t\n x\r\n", "日本語 😀", "<s></s>", "é́", "x" * 3000, " " * 40, "the end.\nof the\n\nworld  ", "<|endoftext|> A", "1234 7 77", "The the THE 's'll", "a\x1cb\x85c　d", "İΣ Straße"]


def docs(spark, texts, partitions=3):
    """Texts with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(partitions)


def random_texts(n, seed=1):
    r = random.Random(seed)
    parts = ["ab", "the ", " ", "\n", "▁", "é", "日", "'s", "7", ".", "ing ", "  ", "\x00", "Zz", "ß", "<|", "\\"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)]


# -- SentencePiece --------------------------------------------------------------------------------


def test_pieces_equal_the_library():
    c = sentencepiece_bpe.codec(P.path("piece_bpe_32k.model"))
    for t in HARD + random_texts(1500):
        ids = np.frombuffer(c.encode(t), np.int32).tolist()
        assert ids == c.library.encode(t or "")
        assert c.decode(ids) == c.library.decode(ids)
    r = random.Random(2)
    for _ in range(500):  # ids that no text has
        ids = [r.choice([r.randrange(32000), r.randrange(262), 28705]) for _ in range(r.randint(0, 5))]
        assert c.decode(ids) == c.library.decode(ids)


def test_encode_and_decode_frames(spark):
    model = P.path("piece_bpe_32k.model")
    d = docs(spark, HARD + HARD)
    out = sentencepiece_bpe.encode(d, model, decoded=True)
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() == 2 * len(HARD)
    back = {r["doc_id"]: r["text"] for r in sentencepiece_bpe.decode(out, model).collect()}
    lib = sentencepiece_bpe.codec(model).library
    assert all(back[r["doc_id"]] == r["decoded"] == lib.decode(r["ids"]) for r in out.collect())
    assert all(list(r["ids"]) == lib.encode((HARD + HARD)[r["doc_id"]] or "") for r in out.collect())
    assert sentencepiece_bpe.encode(docs(spark, []), model).count() == 0


def test_digests_of_the_encoding_query(spark, tmp_path):
    from granary.llm import queries

    docs(spark, HARD).write.parquet(f"{tmp_path}/documents.parquet")
    lib = sentencepiece_bpe.codec(P.path("piece_bpe_32k.model")).library
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op1_sentencepiece(spark, str(tmp_path)).collect()}
    ids = [lib.encode(t or "") for t in HARD]
    assert got == {i: (len(x), sha(",".join(map(str, x))), sha(lib.decode(x))) for i, x in enumerate(ids)}


# -- token files ----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_words_equal_the_library(name):
    e = tokenizing.TextEncoder(P.path(name))
    e.known.cap = 3000  # so that the cache lets go of words again and again
    r = random.Random(8)
    plain = [" ".join(r.choice(["word", "Ça", "end", "x" * 90, "naïve", "9a7"]) + r.choice(["", ".", ",", "!?", "***"]) for _ in range(r.randint(1, 40))) for _ in range(300)]
    texts = HARD + random_texts(1500) + plain + ["long text, " * 30_000]
    r.shuffle(texts)
    want = [[*e.library.encode(t or "", add_special_tokens=False).ids] for t in texts]
    for end in (0, None):
        for i in range(0, len(texts), 64):
            ids, counts = e.ids(texts[i : i + 64], end)
            got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
            assert got == [w + [end] * (end is not None) for w in want[i : i + 64]]
            assert e.known.words.nbytes + 24 * len(e.known.used) < 2 * e.known.cap


def test_token_files_round_trip(spark, tmp_path):
    path = P.path("byte_bpe_50k.json")
    rows = [(k, t) for k, t in zip([5, 3, None, 9, 3, 7] * 3, HARD, strict=True)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    uri = f"file://{tmp_path}/ids"
    token_files.write_tokens(d, uri, path)
    got = sorted(token_files.read_documents(spark, uri, block=2).collect(), key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys) and len(got) == len(rows)
    lib = tokenizing.encoder(path).library
    want = sorted(((-1 if k is None else k), tuple(lib.encode(t or "", add_special_tokens=False).ids + [0])) for k, t in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        at += r["n_tokens"]
    empty = f"file://{tmp_path}/none"
    assert token_files.write_tokens(docs(spark, []), empty, path) == [] and token_files.read_documents(spark, empty).count() == 0


# -- packing --------------------------------------------------------------------------------------


def test_packer_places_where_squares_are_smallest():
    r = random.Random(4)
    p = packing.SumOfSquares(20)
    gaps: list[int] = []
    for _ in range(300):
        length = r.randint(1, 20)

        def squares(g):
            n = [0] * 21
            for x in g:
                n[x] += x > 0
            return sum(x * x for x in n)

        fits = [i for i, g in enumerate(gaps) if g >= length]
        s, offset = p.place(length)
        if fits:
            assert s in fits and offset == 20 - gaps[s]
            cost = lambda i: squares([g - length * (j == i) for j, g in enumerate(gaps)])  # noqa: E731, B023
            assert cost(s) == min(map(cost, fits))
            gaps[s] -= length
        else:
            assert (s, offset) == (len(gaps), 0)
            gaps.append(20 - length)
    with pytest.raises(ValueError):
        p.place(21)


def test_packing_is_whole_and_tight(spark):
    r = random.Random(3)
    texts = ["word " * r.choice([0, 3, 40, 300, 900, 2047, 2048, 5000]) for _ in range(300)] + [None, "", ""]
    out = packing.pack_documents(docs(spark, texts), P.path("word_bpe_49k.json")).collect()
    lib = tokenizing.encoder(P.path("word_bpe_49k.json")).library
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    for x in out:
        part = ids[x["doc_id"]][x["start"] : x["start"] + x["length"]]
        assert len(part) == x["length"] and x["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    by_doc, by_sequence = {}, {}
    for x in out:
        by_doc.setdefault(x["doc_id"], []).append(x)
        by_sequence.setdefault(x["sequence_id"], []).append(x)
    for i, t in enumerate(texts):
        pieces = sorted(by_doc[i], key=lambda x: x["piece"])
        n = len((t or "").split()) + 1
        assert [x["start"] for x in pieces] == list(range(0, n, 2048)) and sum(x["length"] for x in pieces) == n
        assert all(x["length"] == 2048 for x in pieces[:-1])
    for pieces in by_sequence.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x["offset"]):
            assert x["offset"] == at
            at += x["length"]
        assert at <= 2048
    assert len(by_sequence) <= 1.02 * sum(x["length"] for x in out) / 2048 + 1
    assert packing.pack_documents(docs(spark, []), P.path("word_bpe_49k.json")).count() == 0


# -- chat -----------------------------------------------------------------------------------------


def plain_fold(events):
    """The sequential fold with all messages at hand."""
    slots: dict = {}
    for _, turn, kind, role, text in sorted(events, key=lambda e: (e[0], e[1])):
        if kind in ("edit", "regenerate"):
            for t in [t for t in slots if t > turn]:
                del slots[t]
        if kind == "open":
            slots[turn] = [role, ""]
        elif kind == "delta":
            slots.setdefault(turn, [role, ""])[1] += text
        else:
            slots.setdefault(turn, [role, ""])[1] = text if kind == "edit" else ""
    return [(t, r, x) for t, (r, x) in sorted(slots.items())]


def test_fold_equals_the_sequential_one():
    r = random.Random(9)
    for _ in range(400):
        events = [(s, r.randrange(4), r.choice(chat.KINDS + ("delta",) * 3), r.choice(["user", "assistant"]), r.choice("abc")) for s in range(r.randrange(14))]
        order = sorted(events, key=lambda e: (e[1], e[0]))
        got = [(t, role, x) for _, t, role, x in chat.fold(("c", *e) for e in order)]
        assert got == plain_fold(events)


def test_logged_drafts_edits_and_regenerations_fold_to_the_table(spark, tmp_path):
    r = random.Random(4)
    rows = [(c, t // 2 if c == 7 else t, r.choice(["user", "assistant"]), r.choice([None, "", "z" * 9000, "line\n<|im_end|>", "ok"]), "x", 5) for c in range(30) for t in range(6)]
    rows += rows[-3:]  # repeated rows are slots of their own
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string, seq int").repartition(4)
    log = chat.events_of_turns(frame, chunk=100)
    assert {x["kind"] for x in log.select("kind").distinct().collect()} == set(chat.KINDS)
    assert log.where("text = 'lapses'").count() > 20
    chat.write_conversations(log, f"{tmp_path}/c")
    got = {x["conv_id"]: x for x in chat.digests(chat.read_conversations(spark, f"{tmp_path}/c")).collect()}
    for c in range(30):
        turns = sorted(((t, role, x or "") for k, t, role, x, *_ in rows if k == c), key=lambda e: (e[0], e[1], e[2]))
        # null and empty texts of one turn and role are alike
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_rendering_is_reversible(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "\\", "\\<|", "<\\|", "<|<|\\\\", "", "a\nb", "\\n"]
    for x in nasty + random_texts(300, 7):
        segment, at, n = chat.render(x, x)
        assert chat.parse(segment) == (x, x) and chat.unescape(segment[at : at + n]) == x
        assert segment.count("<|im_start|>") == segment.count("<|im_end|>") == 1
    rows = [(c, t, role, x) for c in (1, 2, None) for t, (role, x) in enumerate([("user", "hi"), ("assistant", "<|im_end|>"), (None, None), ("assistant", "yo")])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(chat.events_of_turns(frame, chunk=3))).collect()}
    assert set(got) == {1, 2, None}
    r = got[1]
    assert r["n_turns"] == 4 and r["loss_chars"] == 12 and r["loss_sha256"] == hashlib.sha256(b"<|im_end|>yo").hexdigest()
    assert r["turns_sha256"] == hashlib.sha256(b"user\nhi\nassistant\n<|im_end|>\n\n\nassistant\nyo\n").hexdigest()
    assert chat.format_conversations(chat.events_of_turns(frame.limit(0))).count() == 0


# -- WARC -----------------------------------------------------------------------------------------


def test_chunked_framing():
    for n in (0, 1, 8191, 8192, 8193, 30000):
        b = bytes(i % 251 for i in range(n))
        assert warc.unchunked(warc.chunked(b)) == b
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: v\r\n\r\n") == b"abc"
    for bad in (b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(warc.WarcError):
            warc.unchunked(bad)


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n", "x" * 200_000, "x" * 200_000, "y" * 65_536]
    rows = [(10 - i if i < 9 else i, None if i == 2 else f"http://h/é {i}\r\n", h, 1) for i, h in enumerate(html)] + [(None, "u", "<p>a</p>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    warc.write_warc(pages, f"{tmp_path}/w", segment=50_000)
    got = sorted(warc.read_warc(spark, f"{tmp_path}/w").collect(), key=lambda r: -1 if r["page_id"] is None else r["page_id"])
    assert len(got) == len(rows)
    body = {k: (h or "").encode() for k, _, h, _ in rows}
    for r in got:
        b = body[r["page_id"]]
        same = [k for k, v in body.items() if v == b and k is not None]
        assert r["payload_bytes"] == len(b) and r["payload_digest"] == warc.digest_name(hashlib.sha1(b).digest())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == min(same) else ("revisit", min(same)))
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == b
    parts = warc.read_parts(spark, f"{tmp_path}/w")
    assert parts.where("number > 1").count() >= 4
    with pytest.raises(Exception, match="WarcError"):
        warc.reassembled(parts.where("number is not null and number <> 2")).collect()
    warc.write_warc(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


def test_revisits_name_a_record_that_is_there(spark, tmp_path):
    rows = [(3, None, "ab"), (5, "http://h/5", "ab"), (1, "http://h/é 1", "q" * 300), (2, "http://h/2", "q" * 300), (None, "u", "ab"), (3, None, "ab")]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w", segment=100, compression="none")
    found = [h for f in (tmp_path / "w").glob("*.txt") for h, _ in warc.records(f.read_bytes())]
    there = {(h["warc-target-uri"], h["warc-date"], h["warc-payload-digest"]) for h in found if h["warc-type"] == "response"}
    revisits = [h for h in found if h["warc-type"] == "revisit"]
    assert len(revisits) == 3
    assert all((h["warc-refers-to-target-uri"], h["warc-refers-to-date"], h["warc-payload-digest"]) in there for h in revisits)
    assert len({h["warc-record-id"] for h in found}) == len(found)


def test_payloads_below_the_least_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/w", least=3, compression="none")
    got = {r["page_id"]: r["refers_to"] for r in warc.read_warc(spark, f"{tmp_path}/w").select("page_id", "refers_to").collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}
