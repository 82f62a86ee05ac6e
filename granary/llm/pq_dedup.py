"""Near-duplicate vectors by product quantisation.

Index. K unit centroids part the vectors into inverted lists; of the residual (vector minus centroid) every subspace keeps the number of
its nearest codeword, one byte each, and the vector keeps the norm e of what the codes miss.

Probes. A vector also visits every list whose border lies within tau of it. A segment between two linked vectors a and b crosses the
border between their lists, so one of the two lies within half of the segment's extent across the border: of
every link one end at least visits the other's list if tau is that half, |a - b| / 2 at most (`probes="certain"`). Real links cross
borders at a slant, and so take far less. How much is measured: QUERIES vectors are compared exactly with all rows, and tau is MARGIN times
what the most demanding of their links needs, up to the certain bound, which also holds where they have fewer than ENOUGH links. So
recall on the query set is 1 by construction, whatever the vectors' rank.

Search. In a list, each query's dot product with a member is estimated from the codes alone, by one table lookup for each subspace
(asymmetric: the query is not quantised). It is off by e at most, so members whose estimate is below threshold - e are ruled
out for certain; only of the rest vectors are read, for the exact cosine in double precision. Of the lists that are
visited every link is found.

Scale. Equal vectors are merged before anything else and counted by weight. Lists are cut into blocks of
BLOCK rows and a task compares two blocks, so one cluster with a third of all rows is spread over many tasks. A task reports for each vector its count of links and
one edge to the smallest vector it reaches there, never the pairs. The model is fitted on a bounded SAMPLE.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dealt_anew, removed, written
from .components import components

SAMPLE, LISTS, LIST_ROWS, SUBSPACES, CODEWORDS, BLOCK = 16_384, 4096, 1024, 8, 256, 8192
#: The measurement of probes.
QUERIES, ENOUGH, MARGIN = 1024, 200, 1.25
NONE = np.int64(1) << 62


def kmeans(x: np.ndarray, k: int, rounds: int, unit: bool) -> np.ndarray:
    """Lloyd's centroids, by dot product if `unit`; starts from evenly spaced rows, so equal samples give equal models."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(x, c, unit)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], 1)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
        if unit:
            c = _unit(c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray, unit: bool) -> np.ndarray:
    bias = 0.0 if unit else (c**2).sum(1) / 2
    return np.concatenate([(x[i : i + 4096] @ c.T - bias).argmax(1) for i in range(0, len(x), 4096)] or [np.empty(0, int)])


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True).clip(np.finfo(float).tiny)
    return x / np.linalg.norm(x, axis=1, keepdims=True).clip(np.finfo(float).tiny)


@dataclass
class Quantizer:
    """Centroids and codewords: at most LISTS and CODEWORDS vectors, so it may go to every task."""

    centroids: np.ndarray
    parts: list[slice]
    codewords: list[np.ndarray]
    tau: float

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, threshold: float, subspaces: int = SUBSPACES, codewords: int = CODEWORDS) -> Quantizer:
        """With certain probes."""
        x = _unit(sample)
        c = kmeans(x, max(1, min(lists, len(x))), 6, True)
        rest = x - c[_nearest(x, c, True)]
        cuts = np.linspace(0, x.shape[1], min(subspaces, x.shape[1]) + 1).astype(int)
        parts = [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        return cls(c, parts, [kmeans(rest[:, p], min(codewords, len(x)), 6, False) for p in parts], np.sqrt((1 - threshold) / 2) + 1e-9)

    def borders(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home lists of unit vectors, and how far each vector is from every list's border with its own (in the centroids' distance)."""
        c = self.centroids
        dots = x @ c.T
        home = dots.argmax(1)
        if not hasattr(self, "_apart"):
            self._apart = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
        far = dots[np.arange(len(x)), home][:, None] - dots
        return home, np.divide(far, self._apart[home], out=np.where(far > 0, np.inf, 0.0), where=self._apart[home] > 1e-9)

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Home list and the other lists to visit, for unit vectors."""
        home, far = self.borders(x)
        visit = far <= self.tau + 1e-9
        visit[np.arange(len(x)), home] = False
        return home, [np.flatnonzero(v) for v in visit]

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (a byte for each subspace) and the norm of what they miss."""
        rest = x - self.centroids[home]
        codes = np.stack([_nearest(rest[:, p], w, False) for p, w in zip(self.parts, self.codewords, strict=True)], 1).astype(np.uint8)
        for m, (p, w) in enumerate(zip(self.parts, self.codewords, strict=True)):
            rest[:, p] -= w[codes[:, m]]
        return codes, np.linalg.norm(rest, axis=1)

    def tables(self, which: int, x: np.ndarray) -> list[np.ndarray]:
        """A table for each subspace: every codeword's dot product with queries (codewords x queries, single precision). The first also holds the centroid's."""
        out = [(w @ x[:, p].T).astype(np.float32) for p, w in zip(self.parts, self.codewords, strict=True)]
        out[0] += (x @ self.centroids[which]).astype(np.float32)
        return out


@dataclass
class Rows:
    """One side of a comparison; vectors are as given and become unit vectors when they are read."""

    node: np.ndarray
    weight: np.ndarray
    given: np.ndarray
    home: np.ndarray
    codes: np.ndarray
    missed: np.ndarray
    visits: list

    def unit(self, at: np.ndarray | slice) -> np.ndarray:
        return _unit(self.given[at].astype(float))


def cosines(x: np.ndarray, members: Rows, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (query i, member j) have the cosine; members' vectors are read here, for pairs that the codes left."""
    if not len(i):
        return np.empty(0, bool)
    read, row = np.unique(j, return_inverse=True)
    y = members.unit(read)
    return np.concatenate([np.einsum("ij,ij->i", x[i[s : s + 65536]], y[row[s : s + 65536]]) >= threshold for s in range(0, len(i), 65536)])


def compare(q: Quantizer, which: int, threshold: float, members: Rows, queries: Rows, same: bool, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(node, links, root) of both sides. own: queries belong to the list too; same: they are the members themselves.

    A link between two lists is counted in one of them: where both ends visit each other, in the list with the smaller number.
    """
    n, k = len(members.node), len(q.centroids)
    flat = np.concatenate([i * k + np.asarray(v, np.int64) for i, v in enumerate(members.visits)]) if n and not own else np.empty(0, np.int64)
    links_m, links_q = np.zeros(n, np.int64), np.zeros(len(queries.node), np.int64)
    label_m, label_q = members.node.copy(), queries.node.copy()
    masks = []
    # sums of single precision are off by 2 ** -24 a term, the terms being 2 at most
    least = (threshold - members.missed - 3e-7 * (2 * len(q.parts) + 8)).astype(np.float32)
    for a in range(0, len(queries.node), 256):
        x = queries.unit(slice(a, a + 256))
        tables = q.tables(which, x)
        estimate = tables[0][members.codes[:, 0]]
        for m in range(1, len(tables)):
            estimate += tables[m][members.codes[:, m]]
        j, i = np.nonzero(estimate >= least[:, None])
        hit = cosines(x, members, i, j, threshold)
        i, j = i[hit], j[hit]
        if same:
            other = i + a != j
            i, j = i[other], j[other]
        elif not own:
            home = queries.home[a : a + 256][i]
            twice = np.isin(j * k + home, flat)
            ok = ~twice | (which < home)
            i, j = i[ok], j[ok]
        if len(i):
            mask = np.zeros((len(x), n), bool)
            mask[i, j] = True
            links_q[a : a + 256] += mask @ members.weight
            if not same:
                links_m += queries.weight[a : a + 256] @ mask
            masks.append((a, np.packbits(mask, axis=1)))
    changed = True
    while changed:
        changed = False
        for a, packed in masks:
            mask = np.unpackbits(packed, axis=1, count=n).astype(bool)
            lq = label_q[a : a + 256]
            now = np.minimum(lq, np.where(mask, label_m, NONE).min(1))
            back = np.minimum(label_m, np.where(mask, now[:, None], NONE).min(0))
            changed |= bool((now < lq).any() or (back < label_m).any())
            label_q[a : a + 256], label_m = now, back
            if same:
                label_q = label_m = np.minimum(label_q, label_m)
    for node, links, label in ((members.node, links_m, label_m), (queries.node, links_q, label_q)):
        linked = (links > 0) | (label < node)
        if linked.any():
            yield node[linked], links[linked], label[linked]


INDEXED = "node long, weight long, embedding {}, home int, codes binary, missed double, visits array<int>"


def linkable(embedding: Column) -> Column:
    """Neither null nor zero nor empty, and all components finite."""
    e = embedding.cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def links(vectors: DataFrame, threshold: float, sample: int = SAMPLE, block: int = BLOCK, lists: int | None = None, probes: str = "measured") -> tuple[DataFrame, DataFrame]:
    """(counts, edges) of distinct vectors (node long, weight long, embedding): counts (node, links), edges (src, dst) that span each component.

    `vectors` must be a written table. Vectors of different dimensions have no link. The commonest dimension and those of more than `block` vectors
    have an index each; a group of another dimension fits into a task.
    """
    spark = vectors.sparkSession
    sizes = vectors.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "d")
    first = sizes.limit(1).collect()
    large = first + [x for x in sizes.where(F.col("n") > block).collect() if x not in first]
    found = [_indexed_links(vectors.where(F.size("embedding") == d), d, n, threshold, sample, block, lists, probes) for d, n in large]
    found.append(written(_small_links(vectors.where(~F.size("embedding").isin([d for d, _ in large])), threshold), spark))
    rows = reduce(DataFrame.unionByName, found)
    return rows.groupBy("node").agg(F.sum("links").alias("links")), rows.where("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst"))


def _small_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) of vectors of any dimensions, of each of which a task can hold all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held) if held else None
            if t is None or len(t) < 2:
                return
            x = _unit(t.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), now))
            q, home = Quantizer.fit(x, 1, threshold), np.zeros(len(x), int)
            side = Rows(t.column("node").to_numpy(), t.column("weight").to_numpy(), x, home, *q.encode(x, home), [])
            for node, n, root in compare(q, 0, threshold, side, side, True, True):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(root)], ["node", "links", "root"])

        for b in batches:
            d = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(d[1:] != d[:-1]) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e == s:
                    continue
                if d[s] != now:
                    yield from done()
                    now, held = int(d[s]), []
                held.append(b.slice(s, e - s))
        yield from done()

    rows = vectors.select(F.size("embedding").alias("d"), "node", "weight", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.repartition("d").sortWithinPartitions("d").mapInArrow(run, "node long, links long, root long")


def needed(rows: DataFrame, q: Quantizer, queries: np.ndarray, threshold: float, dim: int) -> tuple[int, float]:
    """How many links the queries (unit vectors) have among all rows, and the tau that the most demanding of them needs."""
    home_q, far_q = q.borders(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, most = 0, 0.0
        for b in batches:
            x = _unit(b.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim))
            for s in range(0, len(x), 1024):
                i, j = np.nonzero(x[s : s + 1024] @ queries.T >= threshold)
                if len(i):
                    home, far = q.borders(x[s : s + 1024])
                    need = np.where(home[i] == home_q[j], 0.0, np.minimum(far[i, home_q[j]], far_q[j, home[i]]))
                    count, most = count + len(i), max(most, float(need.max()))
        yield pa.RecordBatch.from_arrays([pa.array([count]), pa.array([most])], ["count", "most"])

    out = rows.select("embedding").mapInArrow(run, "count long, most double").agg(F.sum("count"), F.max("most")).first()
    # each query is linked to itself
    return (out[0] or 0) - len(queries), out[1] or 0.0


def _indexed_links(rows: DataFrame, dim: int, count: int, threshold: float, sample: int, block: int, lists: int | None, probes: str) -> DataFrame:
    """(node, links, root) of vectors of one dimension."""
    spark = rows.sparkSession
    kind = rows.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = rows.withColumn("embedding", F.col("embedding").cast(kind))
    # a bounded sample: those with the smallest hashes
    taken = rows.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(sample).toArrow().column(0).combine_chunks()
    taken = taken.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    k = lists or max(1, min(LISTS, count // LIST_ROWS))
    q = Quantizer.fit(taken, k, threshold)
    k = len(q.centroids)
    if probes == "measured" and k > 1:
        found, most = needed(rows, q, _unit(taken[:QUERIES]), threshold, dim)
        if found >= ENOUGH:
            q.tau = min(q.tau, MARGIN * most)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 4096):
                part = b.slice(s, 4096)
                x = _unit(part.column(2).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim))
                home, visits = q.lists(x)
                codes, missed = q.encode(x, home)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(home.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed), pa.array(visits, pa.list_(pa.int32()))],
                    ["node", "weight", "embedding", "home", "codes", "missed", "visits"],
                )

    temporary: list[str] = []
    indexed = written(rows.select("node", "weight", "embedding").mapInArrow(index, INDEXED.format(kind)), spark, temporary)
    # k rows at most
    n_home = dict(indexed.groupBy("home").count().collect())
    n_visit = dict(indexed.select(F.explode("visits").alias("home")).groupBy("home").count().collect())
    blocks = F.array(*[F.lit(-(-n_home.get(i, 0) // block)) for i in range(k)])
    guests = F.array(*[F.lit(-(-n_visit.get(i, 0) // block)) for i in range(k)])
    at = lambda table, i: F.element_at(table, i + 1)
    mine = F.pmod(F.xxhash64("node"), at(blocks, F.col("home"))).cast("int")
    zero = F.lit(0)
    # as member of block b of its list: with every block from b on (side 0), with every block before it (side 1), with every block of guests (side 0)
    n_mine, n_guest = at(blocks, F.col("home")), at(guests, F.col("home"))
    unit = lambda which, left, right, side: F.struct(which.alias("list"), left.alias("left"), right.alias("right"), side.alias("side"))
    as_left = F.transform(F.sequence(F.col("__b"), n_mine - 1), lambda j: unit(F.col("home"), F.col("__b"), j, zero))
    as_right = F.when(F.col("__b") > 0, F.transform(F.sequence(zero, F.col("__b") - 1), lambda i: unit(F.col("home"), i, F.col("__b"), F.lit(1)))).otherwise(F.array().cast("array<struct<list:int,left:int,right:int,side:int>>"))
    as_host = F.when(n_guest > 0, F.transform(F.sequence(zero, n_guest - 1), lambda g: unit(F.col("home"), F.col("__b"), -1 - g, zero))).otherwise(F.array().cast("array<struct<list:int,left:int,right:int,side:int>>"))
    # as guest of a list: in one block of its guests, with every block of its members
    guest = lambda i: -1 - F.pmod(F.xxhash64("node"), at(guests, i)).cast("int")
    hosts = F.filter("visits", lambda i: at(blocks, i) > 0)
    as_guest = F.flatten(F.transform(hosts, lambda i: F.transform(F.sequence(zero, at(blocks, i) - 1), lambda b: unit(i, b, guest(i), F.lit(1)))))
    shipped = indexed.withColumn("__b", mine).withColumn("u", F.explode(F.concat(as_left, as_right, as_host, as_guest))).select("u.*", "node", "weight", "embedding", "home", "codes", "missed", "visits")
    keys = ["list", "left", "right"]
    order = shipped.repartition(*keys).sortWithinPartitions(*keys, "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            t = pa.Table.from_batches(held)
            side = t.column("side").to_numpy()
            sides = []
            for s in (0, 1):
                p = t.filter(pa.array(side == s))
                sides.append(Rows(p.column("node").to_numpy(), p.column("weight").to_numpy(), p.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(p), dim), p.column("home").to_numpy(), np.frombuffer(b"".join(p.column("codes").to_pylist()), np.uint8).reshape(len(p), -1) if len(p) else np.empty((0, len(q.parts)), np.uint8), p.column("missed").to_numpy(), p.column("visits").to_pylist()))
            which, left, right = now
            same = left == right
            members, queries = sides
            if not same and not len(queries.node):
                return
            for node, n, root in compare(q, which, threshold, members, members if same else queries, same, right >= 0):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(root)], ["node", "links", "root"])

        for b in batches:
            key = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e == s:
                    continue
                unit_key = tuple(key[s].tolist())
                if unit_key != now:
                    yield from done()
                    now, held = unit_key, []
                held.append(b.slice(s, e - s))
        yield from done()

    found = written(order.mapInArrow(run, "node long, links long, root long"), spark)
    removed(spark, temporary)
    return found


def near_vectors(vectors: DataFrame, threshold: float = 0.9, key: str = "vec_id", embedding: str = "embedding", **how) -> DataFrame:
    """Each row of vectors with n_links, component_id (the smallest key reachable) and kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of one
    dimension link with each other only. Rows with equal vectors (also with equal keys) are linked to each other. Null keys are never a component's smallest if it has others.
    Columns named as the new ones are replaced, others stay; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    made = ["n_links", "component_id", "kept"]
    rows = vectors.select(*[F.col(f"`{c}`") for c in vectors.columns if c not in made])
    e, k = F.col(f"`{embedding}`"), F.col(f"`{key}`")
    groups = rows.where(linkable(e)).groupBy(e.alias("embedding")).agg(F.count("*").alias("weight"), F.min(k).alias("least"))
    nodes = written(groups.select(F.monotonically_increasing_id().alias("node"), "weight", "least", "embedding"), spark)
    counts, edges = links(nodes.select("node", "weight", "embedding"), threshold, **how)
    label = components(edges)
    small = nodes.select("node", "weight", "least").join(counts, "node", "left").join(label, "node", "left")
    small = small.select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    first = small.groupBy("component").agg(F.min("least").alias("component_id"))
    done = nodes.select("node", F.col("embedding").alias("vector")).join(small.join(dealt_anew(first, "component"), "component").select("node", "n_links", "component_id"), "node").drop("node")
    held = rows.select(F.struct("*").alias("row"), F.when(linkable(e), e).alias("mine"))
    out = held.join(done, F.col("mine") == F.col("vector"), "left")
    own = F.col(f"row.`{key}`")
    label = F.coalesce("component_id", own)
    return out.select("row.*", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), label.alias("component_id"), own.eqNullSafe(label).alias("kept"))
