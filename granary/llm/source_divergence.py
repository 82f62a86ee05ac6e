"""How far the sources of a language differ in their words: counts behind a sketch, then sparse joins.

First each task counts, for the terms of its documents, the documents of a language they occur in, into a count-min sketch with cells that
stop at the threshold. Sketches are merged by addition, block by block, and shrink to one bit a cell: whether it reached the threshold. A term
with any cell below it cannot be frequent enough, since a sketch never underestimates. The bits (DEPTH * width / 8 bytes, whatever the
input) go to every task, which counts exactly, by language and source, only terms that may be frequent, adds up what it has before
anything is shuffled, and drops the rest. A saturated sketch lets more terms through; results are the same. Both passes take a slice of
texts at once: its terms become numbers, which are sorted with those of group and document, so that Python objects are made of a slice's
distinct terms only.

Two sources' distance sums over all kept terms, but terms that neither has all contribute the same, and terms that one has depend on the
other's total only. So terms are joined where both sources have them, and the rest is added from counts of counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dealt_anew, released, removed, slices, written

#: What bytes become: those of terms (ASCII letters and, in UTF-8, all bytes of characters beyond ASCII) stay, A to Z small; others are 0.
SMALL = bytes(x if bytes([x]).isalpha() or x > 127 else 0 for x in bytes(range(256)).lower())
BETWEEN = bytes(x for x in range(256) if not SMALL[x])
DEPTH, WIDTH, BLOCK = 4, 1 << 22, 1 << 16
#: Rows of a slice at most; its terms are counted together.
ROWS = 4096
#: Bytes of counts that a task gathers before it adds them up.
GATHERED = 64e6
COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The terms of texts, one after another, and the number of the text that each is from."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = bytes(memoryview(texts.buffers()[2] or b"")[at[0] : at[-1]])
    at = at - at[0]
    inside = np.frombuffer(raw.translate(SMALL), np.uint8) != 0
    # a term begins and ends beside other bytes and at the borders of texts
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads, tails = at[:-1][at[:-1] < len(raw)], at[1:][at[1:] > 0] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts = np.flatnonzero(first)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, at[1:]), prepend=0))
    begins = np.append(0, np.cumsum(np.flatnonzero(last) + 1 - starts))
    packed = raw.translate(SMALL, BETWEEN)
    return owner, pa.Array.from_buffers(pa.large_binary(), len(owner), [None, pa.py_buffer(begins), pa.py_buffer(packed)])


def terms_of(text: bytes | None) -> list[bytes]:
    """A text's terms."""
    return split(pa.array([text], pa.binary()))[1].to_pylist()


def tallied(texts: pa.Array, groups: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of texts, and in the order of groups: a group of texts, a term's number, its occurrences and documents there."""
    owner, terms = split(texts)
    terms = terms.dictionary_encode()
    kinds, group = np.unique(groups, return_inverse=True)
    key = (group[owner] * len(terms.dictionary) + terms.indices.to_numpy()) * max(1, len(texts)) + owner
    key.sort()
    of_doc = np.flatnonzero(np.diff(key, prepend=-1))
    pair = key[of_doc] // max(1, len(texts))
    begin = np.flatnonzero(np.diff(pair, prepend=-1))
    n, docs = np.diff(of_doc[begin], append=len(key)), np.diff(begin, append=len(pair))
    group, term = np.divmod(pair[begin], max(1, len(terms.dictionary)))
    return terms.dictionary, kinds[group], term, n, docs


def _cells(lang: bytes, terms: list[bytes], width: int) -> np.ndarray:
    """The cells (terms x DEPTH) of a language's terms."""
    head = len(lang).to_bytes(4, "little") + lang
    digests = b"".join(xxhash.xxh3_128_digest(head + t) for t in terms)
    parts = np.frombuffer(digests, "<u4").reshape(-1, DEPTH).astype(np.int64)
    return parts % width + np.arange(DEPTH) * width


def _by_lang(langs: pa.Array, lang: np.ndarray) -> Iterator[tuple[bytes, slice]]:
    """Each language's rows, which lie together."""
    for k in np.unique(lang):
        yield langs[k].as_py().encode(), slice(*np.searchsorted(lang, [k, k + 1]))


def sketch_bits(docs: DataFrame, least: int, width: int = WIDTH) -> bytes:
    """One bit for each cell of the merged sketch of documents (lang, source, text): whether it holds `least` or more."""
    top = min(least, 255)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(DEPTH * width, np.uint8)
        for b in slices(batches, ROWS):
            langs = b["lang"].fill_null("").dictionary_encode()
            terms, lang, term, _, found = tallied(b["text"], langs.indices.to_numpy())
            for name, rows in _by_lang(langs.dictionary, lang):
                at = _cells(name, terms.take(pa.array(term[rows])).to_pylist(), width).ravel()
                cell, where = np.unique(at, return_inverse=True)
                total = np.bincount(where, np.repeat(np.minimum(found[rows], top), DEPTH)).astype(np.int64) + cells[cell]
                cells[cell] = np.minimum(total, top)
        for s in range(0, len(cells), BLOCK):
            part = cells[s : s + BLOCK]
            places = np.flatnonzero(part)
            if len(places):
                few = 3 * len(places) < len(part)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([s // BLOCK], pa.int32()),
                    "places": pa.array([places.astype("<u2").tobytes() if few else None], pa.binary()),
                    "counts": pa.array([part[places].tobytes() if few else part.tobytes()], pa.binary()),
                })
        released()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for b in batches:
            for block, places, counts in zip(*b.columns, strict=True):
                cells = whole.setdefault(block.as_py(), np.zeros(min(BLOCK, DEPTH * width), np.uint8))
                more = np.frombuffer(counts.as_py(), np.uint8)
                at = slice(None) if not places.is_valid else np.frombuffer(places.as_py(), "<u2")
                cells[at] = np.minimum(cells[at].astype(np.int64) + more, top)
        for block, cells in whole.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "bits": pa.array([np.packbits(cells >= top).tobytes()], pa.binary())})

    parts = docs.select("lang", "source", "text").mapInArrow(count, "block int, places binary, counts binary")
    merged = parts.repartition("block").mapInArrow(merge, "block int, bits binary")
    out = bytearray(DEPTH * width // 8)
    step = min(BLOCK, DEPTH * width) // 8
    for r in merged.collect():  # DEPTH * width / 8 bytes at most, whatever the input
        out[r["block"] * step : (r["block"] + 1) * step] = r["bits"]
    return bytes(out)


def term_counts(docs: DataFrame, least: int = 30, width: int = WIDTH) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of terms that the sketch leaves, in parts that are to be added up."""
    bits = docs.sparkSession.sparkContext.broadcast(sketch_bits(docs, least, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.frombuffer(bits.value, np.uint8)
        parts: list[pa.Table] = []

        def added() -> pa.Table:
            whole = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
            return whole.rename_columns(["lang", "source", "term", "n", "docs"])

        for b in slices(batches, ROWS):
            langs, sources = (b[c].fill_null("").dictionary_encode() for c in ("lang", "source"))
            names = len(sources.dictionary)
            terms, group, term, n, found = tallied(b["text"], langs.indices.to_numpy().astype(np.int64) * names + sources.indices.to_numpy())
            lang, source = np.divmod(group, names)
            stay = np.zeros(len(group), bool)
            for name, rows in _by_lang(langs.dictionary, lang):
                own, where = np.unique(term[rows], return_inverse=True)
                at = _cells(name, terms.take(pa.array(own)).to_pylist(), width)
                stay[rows] = (may[at >> 3] >> (7 - (at & 7)) & 1).all(1)[where]
            taken = [x.take(pa.array(i[stay])) for x, i in ((langs.dictionary, lang), (sources.dictionary, source), (terms, term))]
            parts.append(pa.table([x.cast(pa.string()) for x in taken] + [pa.array(n[stay]), pa.array(found[stay])], ["lang", "source", "term", "n", "docs"]))
            if sum(p.nbytes for p in parts) > GATHERED:
                parts = [added()]
                if parts[0].nbytes > GATHERED / 2:
                    yield from parts.pop().to_batches(1 << 16)
        if parts:
            yield from added().to_batches(1 << 16)
        parts.clear()
        released()

    return docs.select("lang", "source", "text").mapInArrow(run, COUNTS)


def share(count: str, total: str, alpha: int) -> Column:
    """The share of `count` among `total` with v terms, exact in whole numbers of 38 digits."""
    return F.expr(f"1 + (cast({count} as decimal(28,0)) + {alpha}) * 1000000000 div (cast({total} as decimal(28,0)) + cast({alpha} as decimal(5,0)) * cast(v as decimal(20,0)))").cast("long")


def source_divergence(docs: DataFrame, least: int = 30, alpha: int = 5, top: int = 50, width: int = WIDTH) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents (text, lang, source); nulls in them count as ''.

    A language keeps its terms that at least `least` of its documents have; each group (lang, source), and each language, gives a kept term
    the share p = 1 + floor(10^9 * (count + alpha) / (N + alpha * V)), V the kept terms, N their occurrences there. Part `pair` lists
    each other source of the language with the sum of the differences of shares over all kept terms (0 without any), part `term` the
    `top` kept terms whose share in the group is most above the language's. Ranks go by value, then item in the order of its UTF-8.
    A language of one source has no pairs, texts that are empty or have no letters count as documents without terms. Repeated rows count
    each; other columns are not read. An empty table gives an empty result. Texts are read whole, in slices of about 8 MB.
    """
    spark = docs.sparkSession
    paths: list[str] = []
    sums = written(term_counts(docs, least, width).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), spark, paths)
    frequent = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= least).drop("docs")
    counts = written(sums.drop("docs").join(dealt_anew(frequent, "lang", "term"), ["lang", "term"]), spark, paths)

    # one row a group: its total, its language's total and number of kept terms
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    of_lang = counts.groupBy("lang", "term").agg(F.first("all").alias("all")).groupBy("lang").agg(F.sum("all").alias("lang_n"), F.count("*").alias("v"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["group_n", "lang_n", "v"])
    zero = F.when(F.col("v") > 0, share("0", "group_n", alpha))
    groups = written(groups.withColumn("p0", F.coalesce(zero, F.lit(0)).cast("long")), spark, paths)

    shares = written(counts.join(groups, ["lang", "source"]).select("lang", "source", "term", share("n", "group_n", alpha).alias("p"), share("all", "lang_n", alpha).alias("q"), "p0"), spark, paths)
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    terms = ranked(shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))).where(F.col("rank") <= top)

    a, b = shares.alias("a"), shares.alias("b")
    gap = lambda x, y: F.abs(F.col(x) - F.col(y))
    both = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.term") == F.col("b.term")) & (F.col("a.source") < F.col("b.source")))
    more = gap("a.p", "b.p") - gap("a.p", "b.p0") - gap("a.p0", "b.p") + gap("a.p0", "b.p0")
    both = both.select(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"), more.alias("value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = written(both, spark, paths)
    both = both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    # what a source's own terms add: equal shares together, against each other source's share of a term it lacks
    alike = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("o0"), "v")
    own = alike.join(others, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.col("m") * (gap("p", "o0") - gap("p0", "o0"))).alias("value"))
    own = written(own, spark, paths)
    own = own.unionByName(own.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    none = groups.select("lang", "source", "p0").join(others, "lang").where("source <> item").select("lang", "source", "item", (F.col("v") * gap("p0", "o0")).alias("value"))
    pairs = ranked(both.unionByName(own).unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value")))

    out = [d.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")) for name, d in (("pair", pairs), ("term", terms))]
    done = written(out[0].unionByName(out[1]), spark)
    removed(spark, paths)
    return done
