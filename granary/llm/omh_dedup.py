"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Words are runs of characters other than ASCII punctuation and white space, in lower case (ASCII). Shingles are SHINGLE
words in a row, labelled with their occurrence in the text. Each of SKETCHES hash functions takes the LENGTH labelled
shingles of a text with the smallest values, in the order of the text; that sequence is a
bucket. Two texts that share a bucket are candidates: the chance grows with the overlap of their shingles and with how far
they agree in order, which is what edit similarity asks for. Texts below SHORT words have buckets that every link among them shares,
see `keyed`. A candidate is a link if the edit distance
of the two word sequences is at most (1 - SIMILARITY) of the longer one. The distance is computed in a band of that width, one
machine operation for many cells (bit-parallel, after Hyyro 2003).

Order of work, so that no step makes pairs of a group:

1.  `sketched`: one pass over the texts gives digests of words and buckets, written once. Copies that a task meets are one
    node from here on; those of several tasks share all buckets. A second pass (`worded`) fetches the words of nodes that share a bucket.
2.  Each node is aligned with one hub, the smallest node of one of its buckets.
3.  Buckets whose nodes lie in one component are done. Others that share their smallest node, or whose smallest nodes do, become one where that is less work (`clustered`). Those of more than a block are
    parted by length, as links differ by a fifth of their words at most. In each every node is aligned with the bucket's hub, which tells
    those near the hub (linked) from those so far from it that, by the triangle inequality, no near one can be linked to them.
4.  What is left are the nodes of a bucket that are not near its hub, among each other, and those neither near nor far against the near ones. Block is
    compared with block; a bound on the distance from common words, computed for whole blocks by matrix products, rules out most pairs, and the
    nodes of one component are not compared with each other. So a link between any two
    candidates is either found or implied by found ones, and components are as if all candidates had been aligned. A bucket with n texts of like length that
    have no links costs n * n / 2 comparisons by that bound, on as many tasks as it has pairs of blocks; each text is sent once to each block, so once up to BLOCK texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt_anew, removed, slices, swept, written
from .components import components

SHINGLE, SKETCHES, LENGTH, SIMILARITY = 3, 80, 2, 0.8
#: Links of fewer words (in the longer text) share a bucket for certain.
SHORT = 64
#: Nodes of a block, and nodes that one task aligns with a hub.
BLOCK, HUB = 1024, 96
#: Digests that a task remembers to find copies among its own rows; others are found by their buckets.
REMEMBERED = 200_000
#: Words of two blocks that are compared at once.
AT_ONCE = 400_000

U = np.uint64
TOP = U(0xFFFFFFFFFFFFFFFF)
_RANDOM = np.random.default_rng(20240229)
#: Value of each byte in a word's hash; 0 marks bytes between words.
BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
BYTES[65:91] = BYTES[97:123]
for _low, _high in ((0, 48), (58, 65), (91, 97), (123, 128)):
    BYTES[_low:_high] = 0
BASE = U(0x9E3779B97F4A7C15)
SEEDS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
PLACES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """BASE ** i and its inverse for i below a length that grows as needed."""

    up = down = np.ones(1, U)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 1 << 16)
            inverse = U(pow(int(BASE), -1, 1 << 64))
            cls.up, cls.down = (np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, b)]), dtype=U) for b in (BASE, inverse))
        return cls.up, cls.down


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie one after another in `raw` (UTF-8), and the count of words of each; ends[0] is 0."""
    value = BYTES[raw]
    inside = value != 0
    start, stop = inside.copy(), np.zeros(len(raw) + 1, bool)
    start[1:] &= ~inside[:-1]
    borders = ends[1:-1]
    borders = borders[borders < len(raw)]
    start[borders] = inside[borders]
    begin = np.flatnonzero(start)
    stop[1:] = inside
    stop[1:-1] &= ~inside[1:]
    stop[borders] = inside[borders - 1] if len(borders) else False
    stop[0] = False
    end = np.flatnonzero(stop)
    up, down = Powers.of(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(value * up[: len(raw)], dtype=U)])
    words = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U))
    return words, np.diff(np.searchsorted(begin, ends))


def shingles(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingles of all texts, and how many each has; a text of fewer words has one of all its words."""
    n = len(words)
    padded = np.concatenate([words, np.zeros(size, U)])
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    room = ends[doc] - np.arange(n)  # words from here to the end of the text
    whole = np.zeros(n, U)
    for i in range(size):
        whole += np.where(room > i, padded[i : n + i], U(0)) * PLACES[i]
    first = np.arange(n) == (ends - counts)[doc]
    taken = (room >= size) | first
    found, doc = mix(whole[taken]), doc[taken]
    order = np.lexsort((found, doc))
    new = np.ones(len(found), bool)
    new[1:] = (found[order][1:] != found[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    at = np.arange(len(found))
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
    found[order] += occurrence.astype(U) * PLACES[size]
    return mix(found), np.bincount(doc, minlength=len(counts))


def sketches(found: np.ndarray, counts: np.ndarray, number: int = SKETCHES, length: int = LENGTH) -> np.ndarray:
    """A row of `number` bucket keys for each text that has shingles: its `length` smallest shingles under each hash, in the order of the text.

    Only shingles below a bound that about 8 * length of a text's values reach are sorted, all of a text where these are too few.
    """
    counts = counts[counts > 0]
    doc = np.repeat(np.arange(len(counts)), counts)
    few = np.minimum(1.0, 8 * length / np.maximum(counts, 1))
    bound = np.where(few < 1, (np.minimum(few, 0.999) * 2.0**64).astype(U), TOP)[doc]
    least = np.minimum(length, counts)
    out = np.empty((len(counts), number), U)
    for s in range(number):
        value = mix(found ^ SEEDS[s])
        low = value <= bound
        lacking = np.bincount(doc[low], minlength=len(counts)) < least
        at = np.flatnonzero(low | lacking[doc] if lacking.any() else low)
        order = np.lexsort((value[at], doc[at]))
        at = at[order]
        each = np.bincount(doc[at], minlength=len(counts))
        rank = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
        at = np.sort(at[rank < length])  # the order of the text
        starts = np.cumsum(least) - least
        place = np.arange(len(at)) - np.repeat(starts, least)
        out[:, s] = mix(np.add.reduceat(value[at] * PLACES[place], starts) ^ SEEDS[128 + s]) if len(at) else 0
    return out


def keyed(words: np.ndarray, counts: np.ndarray, number: int = SKETCHES, length: int = LENGTH) -> list[np.ndarray]:
    """The bucket keys of each text: sketches of shingles, and for short texts (which have few shingles) keys that two texts of edit similarity 0.8 or more share for certain.

    With k edits, one of k + 1 pieces of the longer text is in the other one unchanged. From 20 words on such pieces have four words at least, from
    10 on three. Below 10 words k is 1 at most, and the texts are equal once the right word is left out of one or of both.
    """
    keys: list[list[np.ndarray]] = [[] for _ in counts]
    doc = np.repeat(np.arange(len(counts)), counts)

    def of(low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chosen = (counts >= low) & (counts < high)
        return np.flatnonzero(chosen), words[chosen[doc]], counts[chosen]

    # the shorter text of a link has 0.8 of the longer one's words at least
    which, w, c = of(SHORT - SHORT // 5, 1 << 62)
    if len(which):
        for i, row in zip(which, sketches(*shingles(w, c, SHINGLE), number, length), strict=True):
            keys[i].append(row)
    for size, low, high in ((4, 16, SHORT), (3, 8, 20)):
        which, w, c = of(low, high)
        if len(which):
            found, each = shingles(w, c, size)
            for i, part in zip(which, np.split(mix(found ^ SEEDS[255 - size]), np.cumsum(each)[:-1]), strict=True):
                keys[i].append(part)
    for n in range(4, 10):
        which, w, _ = of(n, n + 1)
        if len(which):
            w = w.reshape(-1, n)
            rows = [(x * PLACES[: x.shape[1]]).sum(1, dtype=U) + U(x.shape[1]) for x in (w, *(np.delete(w, i, 1) for i in range(n)))]
            for i, row in zip(which, mix(np.stack(rows, 1) ^ SEEDS[255]), strict=True):
                keys[i].append(np.unique(row))
    return [np.concatenate(k) if k else np.empty(0, U) for k in keys]


def within(a: list, b: list, limit: int) -> bool:
    """Whether the edit distance of two sequences is at most `limit`; only cells that near the diagonal are computed."""
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit or not a:
        return len(b) <= limit
    if len(b) <= limit:
        return True
    # the band's 2 * limit + 1 diagonals are the bits of one number, which moves down a row with each step
    width, rows = 2 * limit + 1, len(b)
    ones, top = (1 << width) - 1, 1 << 2 * limit
    places: dict = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i + limit
    plus, minus = ones & ~((1 << limit) - 1), 0
    score, last = limit, top >> 1
    for i, x in enumerate(a):
        match = places.get(x, 0) >> i & ones
        zero = (((match & plus) + plus) ^ plus | match | minus) & ones
        right, wrong = minus | ones & ~(zero | plus), zero & plus
        if i + limit < rows:
            score += not zero & top
        else:
            score += bool(right & last) - bool(wrong & last)
            last >>= 1
        if score > limit + max(0, len(a) - 1 - i) and score > 2 * limit + len(a) - rows:
            return False
        zero >>= 1
        plus, minus = wrong | ones & ~(zero | right), zero & right
    return score <= limit


def similar(a: list, b: list, similarity: float = SIMILARITY) -> bool:
    longer = max(len(a), len(b))
    return within(a, b, int((1 - similarity) * longer + 1e-9))


SKETCHED = "node long, rep long, key long, content long, digest binary, n int, buckets array<long>"
WORDED = "digest binary, k long, words binary"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Batch, words, counts of words and digests of the words of each text; the text is a batch's first column."""
    for b in slices(batches, 2048, 1):
        texts = b.column(0).cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        words, counts = word_hashes(raw, ends)
        digests = []
        for i, (e, c) in enumerate(zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True)):
            # texts without words are told apart by their characters
            seen = words[e - c : e] if c else raw[ends[i] : ends[i + 1]]
            digests.append(hashlib.blake2b(seen.tobytes(), digest_size=16, person=b"words" if c else b"text").digest())
        yield b, words, counts, digests


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), [x.split()[0] for x in schema.split(", ")])


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(t.alias("text"), F.col(f"`{key}`").cast("long").alias("key"), F.xxhash64(t).alias("content"))


def sketched(docs: DataFrame, key: str, text: str, number: int, length: int) -> DataFrame:
    """A row for each document: node (a number of the row), rep (the node of its first copy in the task), key, content (a hash of the text), digest and number of the words, buckets (of first copies).

    Texts without words have one bucket, of equal texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, known = TaskContext.get().partitionId() << 33, {}
        for b, words, counts, digests in _hashed(batches):
            reps, first = [], np.zeros(len(digests), bool)
            for i, d in enumerate(digests):
                if (rep := known.get(d)) is None:
                    rep, first[i] = node + i, True
                    if len(known) < REMEMBERED:
                        known[d] = rep
                reps.append(rep)
            keys = iter(keyed(words[np.repeat(first, counts)], counts[first], number, length))
            buckets = [k.view(np.int64) if f and len(k := next(keys)) else np.frombuffer(d[:8] if f else b"", np.int64) for f, d in zip(first.tolist(), digests, strict=True)]
            nodes = np.arange(node, node + len(digests))
            node += len(digests)
            yield _batch(SKETCHED, pa.array(nodes), pa.array(reps, pa.int64()), b.column(1), b.column(2), pa.array(digests, pa.binary()), pa.array(counts, pa.int32()), pa.array(buckets, pa.list_(pa.int64())))

    return _texts(docs, key, text).mapInArrow(run, SKETCHED)


def worded(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Words (32 bits each) of texts by digest and key (null: 0), for each digest once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, words, counts, digests in _hashed(batches):
            short = (words >> U(32)).astype("<u4")
            keys = b.column(1).fill_null(0).to_pylist()
            first = list({row: i for i, row in reversed(list(enumerate(zip(digests, keys, strict=True))))}.values())
            ends = np.cumsum(counts)
            yield _batch(WORDED, pa.array([digests[i] for i in first], pa.binary()), pa.array([keys[i] for i in first], pa.int64()), pa.array([short[ends[i] - counts[i] : ends[i]].tobytes() for i in first], pa.binary()))

    return _texts(docs, key, text).mapInArrow(run, WORDED)


def _words(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


EDGES = "src long, dst long"


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    s, d = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(d, pa.int64())], ["src", "dst"])


NEAR, BETWEEN, FAR = 0, 1, 2


def place(centre: list, words: list, similarity: float) -> int:
    """NEAR if linked to the centre, FAR if linked to nothing that is near it.

    What is near has 1 / similarity of the centre's words at most, and so has a bound on its distance from the centre, as has a
    text linked to it on the distance between these two; beyond the sum of both there is no such text.
    """
    if similar(centre, words, similarity):
        return NEAR
    most = len(centre) / similarity
    return BETWEEN if within(centre, words, int((1 - similarity) * (most + max(most, len(words)))) + 1) else FAR


def forest(up: DataFrame, jumps: int = 3) -> DataFrame:
    """(node, component) from (node, component: a smaller node): each goes up by 2 ** jumps steps, or to the root if that is nearer."""
    for _ in range(jumps):
        up = up.join(up.select(F.col("node").alias("component"), F.col("component").alias("next")), "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return up


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """label (node, component) with components that links join put under the smallest of them, as far as `forest` reaches."""
    end = lambda df, side, name: df.join(label.select(F.col("node").alias(side), F.col("component").alias(name)), side, "left").withColumn(name, F.coalesce(name, side))
    both = end(end(links, "src", "a"), "dst", "b").where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    up = forest(both.groupBy("node").agg(F.min("component").alias("component")))
    moved = label.join(dealt_anew(up.select(F.col("node").alias("component"), F.col("component").alias("next")), "component"), "component", "left")
    return moved.select("node", F.coalesce("next", "component").alias("component")).unionByName(up).groupBy("node").agg(F.min("component").alias("component"))


PLACED = "src long, dst long, place int"


def placed(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Distinct (node, hub) as src and dst with the node's place. A hub with many nodes is sent to several tasks."""
    hubs = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    spokes = pairs.join(dealt_anew(hubs, "hub"), "hub").select("hub", part.alias("part"), F.lit(1).alias("side"), "node")
    centres = hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"), F.col("hub").alias("node"))
    rows = spokes.unionByName(centres).join(words, "node").select("hub", "part", "side", "node", "words")
    order = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, centre = None, []
        for b in slices(batches, 1024, 8):
            out = []
            for h, side, node, raw in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if side == 0:
                    hub, centre = h, _words(raw)
                elif h == hub:
                    out.append((node, h, place(centre, _words(raw), similarity)))
            if out:
                s, d, p = zip(*out, strict=True)
                yield _batch(PLACED, pa.array(s, pa.int64()), pa.array(d, pa.int64()), pa.array(p, pa.int32()))

    return order.mapInArrow(run, PLACED)


def compare_blocks(left: list[tuple], right: list[tuple], similarity: float, parent: dict | None = None) -> list[tuple[int, int]]:
    """Edges between (node, component, words) of two blocks (or one, if right is left) that join different components.

    Sequences of n and m words with `common` words (with multiplicity) in common have a distance of max(n, m) - common at least.
    Blocks of very long texts are compared in parts. parent: components joined so far.
    """
    rows = left if right is left else left + right
    if not left or not right:
        return []
    parent = {} if parent is None else parent
    if len(rows) > 2 and sum(len(r[2]) for r in rows) > 4 * AT_ONCE:
        if right is left:
            one, two = left[: len(left) // 2], left[len(left) // 2 :]
            parts = [(one, one), (two, two), (one, two)]
        elif len(left) >= len(right):
            parts = [(left[: len(left) // 2], right), (left[len(left) // 2 :], right)]
        else:
            parts = [(left, right[: len(right) // 2]), (left, right[len(right) // 2 :])]
        return [e for part in parts for e in compare_blocks(*part, similarity, parent)]
    each = [np.frombuffer(r[2], "<u4").astype(U) for r in rows]
    counts = np.array([len(x) for x in each])
    flat, doc = np.concatenate(each), np.repeat(np.arange(len(rows)), counts)
    order = np.lexsort((flat, doc))
    flat, doc = flat[order], doc[order]
    at = np.arange(len(flat))
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1])
    labelled = flat << U(32) | (at - np.maximum.accumulate(np.where(new, at, 0))).astype(U)
    _, column = np.unique(labelled, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, doc = column[order], doc[order]
    n = len(left)
    second = np.arange(n) if right is left else np.arange(n, len(rows))
    common = np.zeros((n, len(second)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        s, e = np.searchsorted(column, (low, low + 4096))
        has = np.zeros((len(rows), 4096), np.float32)
        has[doc[s:e], column[s:e] - low] = 1
        common += has[:n] @ has[second].T
    longer = np.maximum(counts[:n, None], counts[second][None])
    component = np.array([r[1] for r in rows])
    able = (longer - common <= (1 - similarity) * longer + 1e-6) & (component[:n, None] != component[second][None])

    def root(x):
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    out = []
    for i, j in zip(*np.nonzero(able), strict=True):
        a, b = rows[i], rows[second[j]]
        if (right is left and j <= i) or (x := root(a[1])) == (y := root(b[1])):
            continue
        if similar(each[i].tolist(), each[second[j]].tolist(), similarity):
            parent[max(x, y)] = min(x, y)
            out.append((a[0], b[0]))
    return out


def in_blocks(members: DataFrame) -> DataFrame:
    """members (bucket, node, component) of buckets with several components, a row for each pair of blocks that a node takes part in: left and right (the blocks), side (of the node).

    A component with half of a bucket's nodes or more has blocks of its own, which are not compared with each other. Without one, a bucket of BLOCK nodes
    at most is one block: each of its nodes is sent once.
    """
    sizes = members.groupBy("bucket", "component").count()
    tops = sizes.groupBy("bucket").agg(F.max(F.struct("count", "component")).alias("top"), F.sum("count").alias("n"), F.count("*").alias("parts")).where("parts > 1")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    most = F.when(2 * F.col("top.count") >= F.col("n"), F.col("top.count")).otherwise(0)
    rest, main = blocks(F.col("n") - most), blocks(most)
    rows = members.join(dealt_anew(tops.select("bucket", F.col("top.component").alias("largest"), rest.alias("rest"), main.alias("main")), "bucket"), "bucket")
    zero = F.lit(0)
    inside = (F.col("component") == F.col("largest")) & (F.col("main") > 0)
    mine = F.pmod(F.xxhash64("node"), F.when(inside, F.col("main")).otherwise(F.col("rest"))).cast("int")
    unit = lambda left, right, side: F.struct(left.alias("left"), right.alias("right"), F.lit(side).alias("side"))
    none = F.array().cast("array<struct<left:int,right:int,side:int>>")
    # right >= 0: a block of the rest, from the left one on; right < 0: block -1 - right of the largest component
    with_rest = F.transform(F.sequence(F.col("mine"), F.col("rest") - 1), lambda j: unit(F.col("mine"), j, 0))
    before = F.when(F.col("mine") > 0, F.transform(F.sequence(zero, F.col("mine") - 1), lambda i: unit(i, F.col("mine"), 1))).otherwise(none)
    with_main = F.when(F.col("main") > 0, F.transform(F.sequence(zero, F.col("main") - 1), lambda j: unit(F.col("mine"), -1 - j, 0))).otherwise(none)
    of_main = F.transform(F.sequence(zero, F.col("rest") - 1), lambda i: unit(i, -1 - F.col("mine"), 1))
    shipped = rows.withColumn("mine", mine).withColumn("u", F.explode(F.when(inside, of_main).otherwise(F.concat(with_rest, before, with_main))))
    return shipped.select("bucket", "u.*", "node", "component")


def verified_buckets(members: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Edges between components in buckets: members (bucket, node, component), block by block."""
    keys = ["bucket", "left", "right"]
    order = in_blocks(members).join(words, "node").repartition(*keys).sortWithinPartitions(*keys, "side", "node").select(*keys, "side", "node", "component", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, ([], [])

        def done() -> Iterator[pa.RecordBatch]:
            if now is not None and (found := compare_blocks(sides[0], sides[0] if now[1] == now[2] else sides[1], similarity)):
                yield _edges(found)

        for b in slices(batches, 1024, 8):
            for bucket, left, right, side, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (bucket, left, right) != now:
                    yield from done()
                    now, sides = (bucket, left, right), ([], [])
                sides[side].append(tuple(row))
        yield from done()

    return order.mapInArrow(run, EDGES)


def clustered(members: DataFrame, rounds: int = 2) -> DataFrame:
    """members (bucket, node, component) with buckets of one hub (their smallest node) made one, where comparing all of it is less work than bucket by bucket.

    Texts that have much in common share many of their buckets, and would be compared again in each; of n buckets of half of such texts
    most have one of a few hubs. In later rounds what the last one has left or made goes under the smallest hub of all that hold its own hub.
    """
    spark, paths = members.sparkSession, []
    for step in range(rounds):
        hubs = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n"))
        rows = written(members.join(dealt_anew(hubs, "bucket"), "bucket"), spark, paths)
        if step:
            above = rows.groupBy(F.col("node").alias("hub")).agg(F.min("hub").alias("above"))
            above = above.join(rows.select("hub").distinct(), "hub", "left_semi")
            rows = written(rows.join(dealt_anew(above, "hub"), "hub").withColumn("hub", F.col("above")).drop("above"), spark, paths)
        single = rows.groupBy("hub", "bucket").agg(F.first("n").cast("double").alias("n")).groupBy("hub").agg(F.sum(F.col("n") ** 2).alias("single"), F.count("*").alias("buckets"))
        size = rows.select("hub", "node").distinct().groupBy("hub").agg(F.count("*").cast("double").alias("m"))
        whole = single.where("buckets > 1").join(size, "hub").where(F.col("m") ** 2 <= F.col("single")).select("hub", F.lit(True).alias("whole"))
        to = F.when(F.col("whole"), F.xxhash64(F.lit("hub"), F.lit(step), "hub")).otherwise(F.col("bucket"))
        members = written(rows.join(dealt_anew(whole, "hub"), "hub", "left").select(to.alias("bucket"), "node", "component").distinct(), spark, paths)
    removed(spark, paths[:-1])
    return members


def parted(members: DataFrame, counts: DataFrame, similarity: float) -> DataFrame:
    """members (bucket, node, component) with home (true): buckets of more than BLOCK nodes are parted by length; counts: node, n (its words).

    In a parted bucket each text is in its own length class and, as a guest (home: false), in the next; links lie in one class or in two neighbours.
    """
    large = members.groupBy("bucket").count().where(F.col("count") > BLOCK).select("bucket", F.lit(True).alias("large"))
    rows = members.join(dealt_anew(large, "bucket"), "bucket", "left")
    own = F.floor(F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")) / float(-np.log(similarity - 1e-6))).cast("int")
    banded = rows.where("large").join(counts, "node").select("node", "component", F.explode(F.array(own, own + 1)).alias("band"), (F.col("band") == own).alias("home"), "bucket")
    banded = banded.select(F.xxhash64("bucket", "band").alias("bucket"), "node", "component", "home")
    return banded.unionByName(rows.where("large is null").select("bucket", "node", "component", F.lit(True).alias("home")))


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, number: int = SKETCHES, length: int = LENGTH) -> DataFrame:
    """A row for each document: key, content (xxhash64 of its text), class_id (the smallest key of its class), class_size, kept.

    A class is a component of the links. `kept` marks one row of each: the first of those with the smallest key. Texts that share their
    words are copies; texts without words (empty, null: empty) are copies only of equal texts. Keys are whole numbers; rows with a null key stay
    in their class, whose class_id is null only if all keys are. A very long text is read whole, in a batch of its own. Other columns are not read, whatever
    their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    temporary: list[str] = []
    put = lambda df: written(df, spark, temporary)
    base = put(sketched(docs, key, text, number, length))
    exploded = base.where("node = rep").select("node", F.explode("buckets").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").drop("last")
    members = put(exploded.join(dealt_anew(shared, "bucket"), "bucket"))
    swept(spark)  # the keys of all texts were shuffled twice; the words would lie beside them
    wanted = base.join(members.select("node").distinct(), "node", "left_semi").select("node", "digest", F.coalesce("key", F.lit(0)).alias("k"))
    # rows that repeat a digest and key repeat the words
    words = put(worded(docs, key, text).join(wanted, ["digest", "k"]).dropDuplicates(["digest", "k", "node"]).select("node", "words"))
    swept(spark)
    met = put(placed(members.where("node <> hub").groupBy("node").agg(F.min("hub").alias("hub")), words, similarity))
    label = put(forest(met.where(F.col("place") == NEAR).select(F.col("src").alias("node"), F.col("dst").alias("component"))))

    # rows of buckets that have several components, with their component
    several = lambda: (F.min("component") != F.max("component")).alias("several")
    labelled = lambda rows: rows.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mine = labelled(members.select("bucket", "node"))
    mixed = mine.groupBy("bucket").agg(several()).where("several").select("bucket")
    mixed = clustered(put(mine.join(dealt_anew(mixed, "bucket"), "bucket", "left_semi")))
    banded = put(parted(mixed, base.select("node", "n"), similarity))
    hubs = banded.groupBy("bucket").agg(F.min("node").alias("hub"), several(), F.max("home").alias("home")).where("several and home")
    members = put(banded.select("bucket", "node").join(dealt_anew(hubs.select("bucket", "hub"), "bucket"), "bucket"))
    swept(spark)
    open_ = members.where("node <> hub").select("node", "hub").distinct()
    pairs = put(open_.join(met.select(F.col("src").alias("node"), F.col("dst").alias("hub")), ["node", "hub"], "left_anti"))
    met = met.unionByName(put(placed(pairs, words, similarity)))
    links = met.where(F.col("place") == NEAR).select("src", "dst")
    label = put(merged(label, links))
    to_hub = met.select(F.col("src").alias("node"), F.col("dst").alias("hub"), "place")
    left = put(labelled(members).join(to_hub, ["node", "hub"], "left").select("bucket", "node", "component", F.when(F.col("node") == F.col("hub"), F.col("component")).alias("of_hub"), F.coalesce("place", F.lit(NEAR)).alias("place")))
    counts = left.groupBy("bucket").agg(F.max("of_hub").alias("hub"), F.count_if(F.col("place") == FAR).alias("far"), several()).where("several").drop("several")
    rows = left.drop("of_hub").join(dealt_anew(counts, "bucket"), "bucket")
    between = rows.where((F.col("place") == BETWEEN) & (F.col("component") != F.col("hub"))).groupBy("bucket").agg(F.count("*").alias("between"))
    rows = put(rows.join(dealt_anew(between, "bucket"), "bucket", "left").fillna(0, ["between"]))
    of = lambda df, k: df.select(F.xxhash64("bucket", F.lit(k)).alias("bucket"), "node", "component")
    # a bucket with more between than far is compared as a whole
    apart = of(rows.where((F.col("place") != NEAR) & ((F.col("between") == 0) | (F.col("far") > F.col("between")))), 0)
    beside = of(rows.where((F.col("between") > 0) & ((F.col("place") != FAR) | (F.col("far") <= F.col("between")))), 1)
    swept(spark)
    found = put(verified_buckets(put(apart.unionByName(beside)), words, similarity))
    label = components(links.unionByName(found))
    swept(spark)
    # the classes of all rows
    rows = written(base.select("node", "rep", "key", "content").join(label.withColumnRenamed("node", "rep"), "rep", "left").select("node", "key", "content", F.coalesce("component", "rep").alias("class")), spark)
    removed(spark, temporary)  # rows is all that the result reads
    sums = rows.groupBy("class").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "node")).alias("first"), F.count("*").alias("class_size"))
    out = rows.join(dealt_anew(sums, "class"), "class")
    return out.select(F.col("key").alias(key), "content", F.col("first.key").alias("class_id"), "class_size", (F.col("node") == F.col("first.node")).alias("kept"))


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One document of each class, with the columns of docs, whatever their names; rows are matched by key and content, of equal ones one stays.

    Nulls, empty and very long texts and empty tables: as near_classes.
    """
    named = lambda k: [F.coalesce(k, F.lit(0)).alias("key"), k.isNull().alias("none")]
    by = ["key", "none", "content"]
    kept = near_classes(docs, key, text, **how).where("kept").select(*named(F.col(key)), "content")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *named(F.col(f"`{key}`").cast("long")), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("content"))
    return rows.join(kept, by, "left_semi").dropDuplicates(by).select("row.*")
