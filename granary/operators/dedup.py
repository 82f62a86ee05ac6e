"""Deduplication against earlier documents and against a persistent store.

Order decides: of equal documents the first by `seq` stays, whatever later gates do with it. Only keys and sequence numbers are
shuffled; first occurrences are aggregated before they move, so a key with very many rows costs one row a task.
"""

from __future__ import annotations

import uuid
from itertools import combinations
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..storage import checkpointing, delete, folder_bytes, listed, put
from .gates import alive, changed, marked, rejecting

#: The default thresholds and sizes.
SIMHASH_DISTANCE = 3
MINHASH_THRESHOLD, MINHASH_NGRAM, MINHASH_PERMUTATIONS = 0.9, 5, 128
CHUNK_SIZE, CHUNK_OVERLAP = 512, 0


def exact_dedup(df: DataFrame, idx: int, store: DataFrame | None = None, first_as: str | None = None) -> DataFrame:
    """Sets doc_id to the text's SHA-256 and dup_group_id; rejects all but the first alive row of each (DUP_EXACT).

    store: digests of earlier runs (column doc_id), all of which count as earlier. first_as: a column for the seq of the first row with the text (-1: in the store).
    """
    digest = hashing.sha256(F.col("text"))
    df = changed(df, doc_id=digest)
    df = changed(df, dup_group_id=hashing.dup_group_id(F.col("doc_id")))
    first = df.where(alive()).groupBy(F.col("doc_id").alias("__h")).agg(F.min("seq").alias("__first"))
    if store is not None:
        known = store.select(F.col("doc_id").alias("__h")).distinct().withColumn("__known", F.lit(True))
        first = first.join(known, "__h", "left").withColumn("__first", F.when(F.col("__known"), F.lit(-1)).otherwise(F.col("__first"))).drop("__known")
    # behind a shuffle of its own, so that the join can split a digest that very many rows have
    df = df.join(first.repartition(F.xxhash64("__h")), F.when(alive(), F.col("doc_id")) == F.col("__h"), "left")
    reason = F.when(F.col("seq") != F.col("__first"), "DUP_EXACT")
    df = marked(rejecting(df, "exact_dedup", idx, reason, F.lit("duplicate content hash")), "exact_dedup_v1").drop("__h")
    return df.withColumnRenamed("__first", first_as) if first_as else df.drop("__first")


# -- SimHash --------------------------------------------------------------------------------------


def _dealt_anew(grouped: DataFrame, *keys: str) -> DataFrame:
    """An aggregate's rows behind a shuffle of their own, so that a join on its keys can split those that very many rows of the other side have."""
    return grouped.repartition(F.xxhash64(*keys))


def hamming_pairs(signatures: DataFrame, sig: str = "sig", bits: int = hashing.SIMHASH_BITS, distance: int = SIMHASH_DISTANCE, known: DataFrame | None = None) -> DataFrame:
    """(a, b, distance), a < b, for all pairs of distinct signatures within the distance.

    With known (the same column), a is one of signatures and b one of known, equal ones included; pairs within either table are not formed.

    Two signatures that differ in at most k of k + 3 blocks agree in three of them (pigeonhole; Manku et al. 2007), so an
    equi-join on every choice of three blocks (half of the bits at k = 3) finds them; a pair is taken from the first
    choice it agrees in. Copies of a signature are one row here: join the result with the members of each signature.
    """
    n = distance + 3
    edges = [bits * i // n for i in range(n + 1)]
    choices = list(combinations(range(n), 3))
    masks = [sum((1 << edges[i + 1]) - (1 << edges[i]) for i in c) for c in choices]
    part = lambda c, i: c.bitwiseAND(F.lit(masks[i]))

    def keyed(t: DataFrame, name: str) -> DataFrame:
        # written once: signatures are dear, and each choice reads them
        s = t.select(F.col(sig).alias(name)).distinct().checkpoint().where(F.col(name).isNotNull())
        return s.select(name, F.posexplode(F.array(*[part(F.col(name), i) for i in range(len(choices))])).alias("choice", "value"))

    checkpointing(signatures.sparkSession)
    a = keyed(signatures, "a")
    b = a.withColumnRenamed("a", "b") if known is None else keyed(known, "b")
    first = F.coalesce(*[F.when(part(F.col("a"), i) == part(F.col("b"), i), F.lit(i)) for i in range(len(choices))])
    d = hashing.hamming(F.col("a"), F.col("b"))
    order = F.col("a") < F.col("b") if known is None else F.lit(True)
    return a.join(b, ["choice", "value"]).where(order & (d <= distance) & (F.col("choice") == first)).select("a", "b", d.alias("distance"))


def simhash_buckets(docs: DataFrame, distance: int = SIMHASH_DISTANCE) -> DataFrame:
    """(seq, bucket): sets of documents (seq, sig) whose signatures all lie within the distance of each other; two documents do if and only if they share one.

    A set is the documents of one signature, or those of two near ones.
    """
    checkpointing(docs.sparkSession)
    members = docs.select("sig", "seq").checkpoint().where("sig is not null")
    pairs = hamming_pairs(members.select("sig"), distance=distance).select("a", "b")
    sides = pairs.select(F.col("a").alias("sig"), F.struct("a", "b").alias("set")).unionByName(pairs.select(F.col("b").alias("sig"), F.struct("a", "b").alias("set")))
    own = members.select("seq", F.xxhash64(F.lit("simhash"), "sig", "sig").alias("bucket"))
    return own.unionByName(members.join(sides, "sig").select("seq", F.xxhash64(F.lit("simhash"), "set.a", "set.b").alias("bucket")))


# -- MinHash --------------------------------------------------------------------------------------


def minhash_bands(docs: DataFrame, threshold: float = MINHASH_THRESHOLD, ngram: int = MINHASH_NGRAM, permutations: int = MINHASH_PERMUTATIONS, id: str = "seq") -> DataFrame:
    """(id, band, hash) of each document's signature."""
    number, rows = hashing.bands(threshold, permutations)
    # not filtered by the signature, which would be computed twice
    s = docs.where("text is not null").select(F.col(id), hashing.minhash(F.col("text"), ngram, permutations).alias("__s"))
    return s.select(id, F.posexplode(hashing.band_hashes(F.col("__s"), number, rows)).alias("band", "hash"))


def minhash_hits(bands: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """(seq, first): documents that share a band with an earlier one (or with the store: first is -1) and the earliest such."""
    checkpointing(bands.sparkSession)
    bands = bands.checkpoint()
    first = bands.groupBy("band", "hash").agg(F.min("seq").alias("first"))
    if store is not None:
        known = store.select("band", "hash").distinct().withColumn("known", F.lit(True))
        first = first.join(known, ["band", "hash"], "left").withColumn("first", F.when(F.col("known"), F.lit(-1)).otherwise(F.col("first"))).drop("known")
    return bands.join(_dealt_anew(first, "band", "hash"), ["band", "hash"]).where("seq > first").groupBy("seq").agg(F.min("first").alias("first"))


def minhash_pairs(bands: DataFrame) -> DataFrame:
    """(a, b), a < b, of each bucket's first document with the others: candidates, unverified."""
    checkpointing(bands.sparkSession)
    bands = bands.checkpoint()
    first = bands.groupBy("band", "hash").agg(F.min("seq").alias("a"))
    return bands.join(_dealt_anew(first, "band", "hash"), ["band", "hash"]).where("seq > a").select("a", F.col("seq").alias("b")).distinct()


def near_dup_minhash(df: DataFrame, idx: int, threshold: float = MINHASH_THRESHOLD, hard_reject: bool = False, store: DataFrame | None = None) -> DataFrame:
    """Soft: marks documents that share a band with an earlier alive one. Hard: rejects those that share one with an earlier kept one (DUP_NEAR)."""
    live = df.where(alive()).select("seq", "text")
    bands = minhash_bands(live, threshold)
    if not hard_reject:
        hits = minhash_hits(bands, store).select("seq", F.lit(True).alias("__hit"))
        df = df.join(hits, "seq", "left")
        return marked(df, F.when(F.col("__hit"), "near_dup_minhash_hit_v1").otherwise("near_dup_minhash_v1")).drop("__hit")
    keep = greedy_keep(live.select("seq"), bands.select("seq", F.xxhash64("band", "hash").alias("bucket")))
    df = df.join(keep.select("seq", F.col("keep").alias("__keep")), "seq", "left")
    return marked(rejecting(df, "near_dup_minhash", idx, F.when(~F.col("__keep"), "DUP_NEAR")), "near_dup_minhash_v1").drop("__keep")


# -- chunks ---------------------------------------------------------------------------------------


def chunk_hashes(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, id: str = "seq") -> DataFrame:
    """(id, chunk, hash) of each document's chunks, white space collapsed in each."""
    cut = docs.select(F.col(id), F.posexplode(text.chunks(F.col("text"), size, overlap)).alias("chunk", "__t"))
    return cut.select(id, "chunk", F.sha2(text.collapse_white(F.col("__t")), 256).alias("hash"))


def chunk_links(hashes: DataFrame, store: DataFrame | None = None, numbers: bool = False) -> DataFrame:
    """(seq, links): how many of a document's chunks an earlier document, or the store, has. Repeats within one document do not count.

    numbers: a column `chunks` with the numbers of those chunks in the document.
    """
    checkpointing(hashes.sparkSession)
    hashes = hashes.checkpoint()
    first = hashes.groupBy("hash").agg(F.min("seq").alias("first"))
    if store is not None:
        first = first.join(store.select("hash").distinct().withColumn("known", F.lit(True)), "hash", "left").withColumn("first", F.when(F.col("known"), F.lit(-1)).otherwise(F.col("first"))).drop("known")
    more = [F.array_sort(F.collect_list("chunk")).alias("chunks")] if numbers else []
    return hashes.join(_dealt_anew(first, "hash"), "hash").where("seq > first").groupBy("seq").agg(F.count("*").alias("links"), *more)


# -- priority -------------------------------------------------------------------------------------


def priority_rank(name: Column, order: list[str]) -> Column:
    """The place of the first label that the name equals, starts with or contains (case and outer spaces aside); len(order) for none, 0 without an order."""
    n = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    out = F.lit(len(order))
    for i, label in reversed(list(enumerate(order))):
        if label and label.strip():
            out = F.when(F.contains(n, F.lit(label.strip().lower())), F.lit(i)).otherwise(out)
    return out


def type_rank(source: Column, order: list[str], types: dict[str, str]) -> Column:
    """The rank of a source's document type; sources without one are of type "unknown"."""
    kind = F.lit("unknown")
    for name, t in types.items():
        kind = F.when(source == name, F.lit(t)).otherwise(kind)
    return priority_rank(kind, order)


def keep_incoming(incoming: Column, best_type: Column | None, best_source: Column | None, types: tuple[list[str], dict[str, str]] | None = None, sources: list[str] | None = None) -> Column:
    """Whether a document that matches others stays: better than the best of them by type, or at equal type by source."""
    by_source = priority_rank(incoming, sources) < best_source if sources and best_source is not None else F.lit(False)
    if types is None or best_type is None:
        return by_source
    rank = type_rank(incoming, *types)
    return F.when(rank < best_type, True).when(rank > best_type, False).otherwise(by_source)


# -- greedy decisions ------------------------------------------------------------------------------


def greedy_keep(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(seq, keep): a node stays exactly if no earlier node that stays shares a bucket (seq, bucket) with it.

    The set is that of a sequential pass, found in rounds (Blelloch et al. 2012): undecided nodes that are the first in all of
    their buckets stay, all others in those buckets go. From the third round on chains are shortened as well (`_chained`): a node that only one
    earlier node stands before does the opposite of it, and pointers along such nodes double until they end, so that a chain
    of any length takes as many steps as its length has digits. Buckets are only aggregated, so a bucket that a third of all nodes
    share costs no pairs. Each step is written to the shared folder and the one before deleted; the driver sees a count a step.
    """
    spark = nodes.sparkSession
    decided: list[str] = []  # (seq, keep) of each round
    temporary: list[str] = []
    shared = members.groupBy("bucket").agg(F.min("seq").alias("a"), F.max("seq").alias("b")).where("a <> b").select("bucket")
    open_ = put(members.join(_dealt_anew(shared, "bucket"), "bucket", "left_semi").select("seq", "bucket").distinct(), temporary)
    number = 0
    while not open_.isEmpty():
        number += 1
        before = list(temporary)
        first = _dealt_anew(open_.groupBy("bucket").agg(F.min("seq").alias("first")), "bucket")
        seen = put(open_.join(first, "bucket"), temporary)
        stay = seen.groupBy("seq").agg(F.bool_and(F.col("seq") == F.col("first")).alias("stays")).where("stays").select("seq")
        known = stay.withColumn("keep", F.lit(True))
        if number > 2:
            known = put(known.unionByName(_chained(seen, put(stay, temporary), temporary)), temporary)
        closed = seen.join(known.where("keep").select("seq"), "seq", "left_semi").select("bucket", F.col("seq").alias("kept"))
        gone = seen.join(_dealt_anew(closed, "bucket"), "bucket").where("seq <> kept").select("seq", F.lit(False).alias("keep"))
        verdict = put(known.unionByName(gone).groupBy("seq").agg(F.bool_and("keep").alias("keep")), decided)
        open_ = put(seen.join(verdict, "seq", "left_anti").select("seq", "bucket"), temporary)
        delete(spark, *before)
        temporary = [t for t in temporary if t not in before]
    gone = spark.createDataFrame([], "seq long, keep boolean")
    if decided:
        gone = spark.read.parquet(*decided).where("not keep")
    out = put(nodes.select("seq").distinct().join(gone, "seq", "left").select("seq", F.coalesce("keep", F.lit(True)).alias("keep")))
    delete(spark, *decided, *temporary)
    return out


def _chained(seen: DataFrame, stay: DataFrame, temporary: list[str]) -> DataFrame:
    """(seq, keep) of open nodes (seen: seq, bucket, first) that follow from those that stay along nodes with one earlier node before them.

    Such a node is the first or the second in each of its buckets, and where it is second the first is always the same one.
    """
    second = _dealt_anew(seen.where("seq > first").groupBy("bucket").agg(F.min("seq").alias("second")), "bucket")
    at = seen.where("seq > first").join(second, "bucket")
    one = at.groupBy("seq").agg(F.bool_and(F.col("seq") == F.col("second")).alias("ok"), F.min("first").alias("up"), F.max("first").alias("other")).where("ok and up = other")
    # odd: whether the node does the opposite of `up`
    chain = put(one.select("seq", "up", F.lit(True).alias("odd")), temporary)
    while True:
        ahead = _dealt_anew(chain.select(F.col("seq").alias("up"), F.col("up").alias("next"), F.col("odd").alias("more")), "up")
        jumped = chain.join(ahead, "up", "left")
        step = put(jumped.select("seq", F.coalesce("next", "up").alias("up"), (F.col("odd") != F.coalesce("more", F.lit(False))).alias("odd"), F.col("next").isNotNull().alias("moved")), temporary)
        if step.where("moved").isEmpty():
            break
        chain = step.drop("moved")
    return chain.join(stay.select(F.col("seq").alias("up")), "up", "left_semi").select("seq", (~F.col("odd")).alias("keep"))


def buckets_of_edges(edges: DataFrame) -> DataFrame:
    """(seq, bucket) of edges (a, b): a bucket for each edge."""
    b = F.xxhash64(F.least("a", "b"), F.greatest("a", "b")).alias("bucket")
    return edges.where("a <> b").select(F.explode(F.array("a", "b")).alias("seq"), b)


def global_decisions(docs: DataFrame, simhash: bool = True, minhash: bool = True, chunk: bool = True, distance: int = SIMHASH_DISTANCE, threshold: float = MINHASH_THRESHOLD, limit: int | None = None, known_chunks: DataFrame | None = None, collisions: bool = False, chunk_numbers: bool = False) -> DataFrame:
    """(seq, action, match_type, links) of documents (seq, text): drop, keep_link (chunks shared) or keep.

    A document is dropped if an earlier kept one matches by SimHash, else by MinHash; chunks shared with kept ones, or with known_chunks (hash), only link.
    SimHash signs whole texts; `limit` takes so many words of each (the reference: hashing.SIMHASH_WORDS). collisions: a column that says whether
    what a dropped document (seq, text, source) matches comes from several sources. chunk_numbers: a column `chunks`, which of a kept document's are shared.
    """
    spark = docs.sparkSession
    temporary: list[str] = []
    members = spark.createDataFrame([], "seq long, bucket long, kind string")
    if simhash:
        signed = docs.select("seq", hashing.simhash(F.col("text"), limit=limit).alias("sig"))
        members = members.unionByName(simhash_buckets(signed, distance).withColumn("kind", F.lit("simhash")))
    if minhash:
        bands = minhash_bands(docs, threshold)
        members = members.unionByName(bands.select("seq", F.xxhash64(F.lit("minhash"), "band", "hash").alias("bucket"), F.lit("minhash").alias("kind")))
    members = put(members, temporary)
    keep = greedy_keep(docs.select("seq"), members.select("seq", "bucket"))
    kept = keep.where("keep").select("seq")
    # a bucket has one kept node at most
    held = members.join(kept, "seq", "left_semi").groupBy("bucket").agg(F.min("seq").alias("kept"))
    sums = [F.max("kind").alias("match_type")]
    if collisions:
        held = held.join(docs.select(F.col("seq").alias("kept"), F.col("source").alias("of")), "kept")
        sums.append((F.min("of") != F.max("of")).alias("collides"))
    by = members.join(_dealt_anew(held, "bucket"), "bucket").where("seq > kept").groupBy("seq").agg(*sums)
    out = keep.join(by, "seq", "left")
    if chunk:
        links = chunk_links(chunk_hashes(docs.join(kept, "seq", "left_semi")), known_chunks, chunk_numbers)
        out = out.join(links, "seq", "left")
    else:
        out = out.withColumns({"links": F.lit(0).cast("long"), "chunks": F.lit(None).cast("array<int>")})
    links = F.when(F.col("keep"), F.coalesce("links", F.lit(0))).otherwise(0)
    action = F.when(~F.col("keep"), "drop").when(links > 0, "keep_link").otherwise("keep")
    match = F.when(~F.col("keep"), F.col("match_type")).when(links > 0, F.lit("chunk_hash"))
    more = [F.coalesce(~F.col("keep") & F.col("collides"), F.lit(False)).alias("collides")] if collisions else []
    more += ["chunks"] if chunk_numbers else []
    done = put(out.select("seq", action.alias("action"), match.alias("match_type"), links.cast("long").alias("links"), *more))
    delete(spark, *temporary)
    return done


def global_dedup(df: DataFrame, idx: int, store: FingerprintStore | None = None, types: tuple[list[str], dict[str, str]] | None = None, sources: list[str] | None = None, drop_chunks: bool = False, **how) -> DataFrame:
    """The stage: dropped documents are rejected as DUP_GLOBAL, kept ones marked with their links.

    drop_chunks: chunks that an earlier kept document, or the store, has are cut out of a kept document's text (its first holder keeps them).

    store: documents that match those of earlier runs go first, unless their source's type or source has a strictly better
    priority than all they match; the others are then decided among themselves, in their order (a run's sources come in
    the order of priority, so that no later document outranks an earlier one).
    """
    live = df.where(alive()).select("seq", "source", "text")
    how = {**how, "chunk_numbers": True} if drop_chunks else how
    if store is None:
        d = global_decisions(live, **how)
    else:
        checkpointing(df.sparkSession)
        earlier = store.decide(live, types, sources).checkpoint()
        gone = earlier.where(~F.col("keep"))
        d = global_decisions(live.join(gone, "seq", "left_anti"), known_chunks=store.read("chunks"), **how)
        d = d.unionByName(gone.select("seq", F.lit("drop").alias("action"), "match_type", F.lit(0).cast("long").alias("links")), allowMissingColumns=True)
    shared = F.col("chunks") if drop_chunks else F.lit(None).cast("array<int>")
    d = d.select("seq", F.col("action").alias("__a"), F.col("match_type").alias("__m"), F.col("links").alias("__l"), shared.alias("__c"))
    df = df.join(d, "seq", "left")
    if drop_chunks:
        left = F.filter(text.chunks(F.col("text"), CHUNK_SIZE, CHUNK_OVERLAP), lambda _, i: ~F.array_contains("__c", i))
        df = df.withColumn("text", F.when((F.col("__a") == "keep_link") & F.col("__c").isNotNull(), F.array_join(left, "")).otherwise(F.col("text")))
    df = rejecting(df, "global_dedup", idx, F.when(F.col("__a") == "drop", "DUP_GLOBAL"), F.col("__m"))
    marker = F.when(F.col("__a") == "keep_link", F.concat(F.lit("global_dedup_keep_link_chunks="), F.col("__l"), F.lit("_v1"))).otherwise("global_dedup_kept_v1")
    return marked(df, marker).drop("__a", "__m", "__l", "__c")


# -- the store -------------------------------------------------------------------------------------


class FingerprintStore:
    """Fingerprints of kept documents as Parquet tables below a folder, in folders of their version and run; a run only replaces its own.

    A document that a better-ranked one replaces is not deleted: the run of the better one notes it in the table `superseded`
    (doc_id, source, of_run, by_doc_id), and reading leaves noted rows out. A run that is repeated replaces its notes as well, and does not see them.
    """

    TABLES = ("exact", "simhash", "minhash", "chunks")

    def __init__(self, spark, path: str, version: str = "v2", run: str | None = None, limit: int | None = None):
        """run: whose rows add() replaces and read() leaves out, so that a run can be repeated without meeting its own documents.

        limit: words of a text that its SimHash signs, all by default. It is part of the version, so signatures of whole texts and of heads never meet.
        """
        self.spark, self.path, self.limit = spark, path.rstrip("/"), limit
        self.version = version if limit is None else f"{version}-{limit}-words"
        self.run = f"run-{run or ''}"

    def _folder(self, table: str, run: str | None = None) -> str:
        of_version = f"{self.path}/{table}/fingerprint_version={quote(self.version, safe='')}"
        return of_version if run is None else f"{of_version}/run={quote(run, safe='')}"

    def _rows(self, table: str) -> DataFrame | None:
        try:
            rows = self.spark.read.parquet(f"{self.path}/{table}").where(F.col("fingerprint_version") == self.version)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        return rows if self.run == "run-" else rows.where(F.col("run") != self.run)

    def read(self, table: str) -> DataFrame | None:
        """This version's rows, without superseded ones and, if this run has a name, its own; None before the first append."""
        rows, gone = self._rows(table), self._rows("superseded")
        if rows is None or gone is None:
            return rows
        gone = gone.select(*[F.col(c).alias(f"__{c}") for c in ("doc_id", "source", "of_run")]).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("run") == F.col("__of_run"))
        return rows.join(gone, same, "left_anti")

    def superseded(self) -> DataFrame | None:
        """(doc_id, source, by_doc_id) of the documents that better ones of later runs stand in for; None before the first."""
        parts = [t.select("doc_id", "source", "by_doc_id") for t in (self._rows("superseded"), self._rows("history")) if t is not None]
        return None if not parts else (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).distinct()

    def append(self, table: str, rows: DataFrame) -> None:
        if table not in (*self.TABLES, "superseded", "history"):
            raise ValueError(f"unknown table {table}; there are {', '.join(self.TABLES)}")
        rows.write.mode("append" if self.run == "run-" else "overwrite").parquet(self._folder(table, self.run))

    def add(self, docs: DataFrame, source: str = "source", supersede: bool = False) -> None:
        """Stores all fingerprints of documents (seq, doc_id, text, source).

        supersede: the documents have passed decide() with priorities, so what they match in the store ranks below them and is noted as superseded.
        """
        who = docs.select("seq", "doc_id", F.col(source).alias("source"))
        self.append("exact", who.drop("seq"))
        self.append("simhash", docs.select("doc_id", F.col(source).alias("source"), hashing.simhash(F.col("text"), limit=self.limit).alias("sig")).where("sig is not null"))
        self.append("minhash", minhash_bands(docs).join(who, "seq").drop("seq"))
        self.append("chunks", chunk_hashes(docs).join(who, "seq").drop("seq"))
        if supersede:
            self._supersede()

    def _supersede(self, distance: int = SIMHASH_DISTANCE) -> None:
        """Notes the rows of other runs that those of this run match: by SimHash, and by MinHash for documents that match none by SimHash (as decide() does).

        Works on keys (near signatures, bands) with one document of this run each, so no pairs of documents are made.
        """
        if self.run == "run-":
            raise ValueError("only a named run can supersede")
        mine = lambda t: self.spark.read.parquet(self._folder(t, self.run))
        sim, bands, temporary = self.read("simhash"), self.read("minhash"), []
        pairs = put(hamming_pairs(mine("simhash").select("sig"), distance=distance, known=sim.select("sig")).select("a", "b"), temporary)
        by = mine("simhash").groupBy(F.col("sig").alias("a")).agg(F.min("doc_id").alias("by_doc_id"))
        near = pairs.join(by, "a").groupBy(F.col("b").alias("sig")).agg(F.min("by_doc_id").alias("by_doc_id"))
        who = ["doc_id", "source", F.col("run").alias("of_run"), "by_doc_id"]
        found = sim.join(near, "sig").select(*who)
        matched = mine("simhash").join(pairs.select(F.col("a").alias("sig")), "sig", "left_semi").select("doc_id").distinct()
        rest = mine("minhash").join(matched, "doc_id", "left_anti").groupBy("band", "hash").agg(F.min("doc_id").alias("by_doc_id"))
        found = found.unionByName(bands.join(rest, ["band", "hash"]).select(*who))
        self.append("superseded", found.groupBy("doc_id", "source", "of_run").agg(F.min("by_doc_id").alias("by_doc_id")))
        delete(self.spark, *temporary)

    def runs(self) -> dict[str, int]:
        """The bytes of each run's folders, all tables together."""
        found: dict[str, int] = {}
        for t in self.TABLES:
            for name, _, _ in listed(self.spark, self._folder(t)):
                if name.startswith("run="):
                    run = unquote(name.removeprefix("run="))
                    found[run] = found.get(run, 0) + folder_bytes(self.spark, self._folder(t, run))
        return found

    def compact(self, least: int = 16, up_to: int = 1 << 36) -> int:
        """Merges the folders of small runs (at most up_to bytes) if there are at least so many of them; how many it merged.

        Superseded rows of merged runs are left out for good, and their notes become history. Rows are written before the folders they came from
        are deleted; where it stops in between they are there twice, which changes no decision, and the next call removes them. This run is
        not touched; no other run may write at the same time.
        """
        small = [r for r, n in self.runs().items() if r != self.run and n <= up_to]
        if len(small) < least:
            return 0
        into = f"run-merged-{uuid.uuid4().hex}"
        for t in self.TABLES:
            rows = self.read(t)
            if rows is not None:
                rows.where(F.col("run").isin(small)).drop("run", "fingerprint_version").distinct().write.parquet(self._folder(t, into))
        notes = self._rows("superseded")
        if notes is not None:
            old = [n for n, _, _ in listed(self.spark, self._folder("superseded")) if n.startswith("run=") and unquote(n.removeprefix("run=")) != self.run]
            notes = notes.drop("run", "fingerprint_version").distinct()
            applied = F.col("of_run").isin(small)
            notes.where(applied).write.parquet(self._folder("history", into))
            notes.where(~applied).write.parquet(self._folder("superseded", into))
        delete(self.spark, *[self._folder(t, r) for t in self.TABLES for r in small])
        if notes is not None:
            delete(self.spark, *[f"{self._folder('superseded')}/{n}" for n in old])
        return len(small)

    def matches(self, docs: DataFrame, distance: int = SIMHASH_DISTANCE) -> DataFrame:
        """(seq, match_type, existing_source): documents that the store has a match for, simhash before minhash."""
        found = self.spark.createDataFrame([], "seq long, match_type string, existing_source string")
        sim, mini = self.read("simhash"), self.read("minhash")
        if sim is not None:
            checkpointing(self.spark)
            mine = docs.select("seq", hashing.simhash(F.col("text"), limit=self.limit).alias("sig")).checkpoint().where("sig is not null")
            pairs = hamming_pairs(mine.select("sig"), distance=distance, known=sim.select("sig")).select("a", "b")
            known = sim.select(F.col("sig").alias("b"), "source").distinct()
            near = pairs.join(known, "b").select(F.col("a").alias("sig"), "source").distinct()
            found = found.unionByName(mine.join(near, "sig").select("seq", F.lit("simhash").alias("match_type"), F.col("source").alias("existing_source")).distinct())
        if mini is not None:
            known = mini.select("band", "hash", "source").distinct()
            found = found.unionByName(minhash_bands(docs).join(known, ["band", "hash"]).select("seq", F.lit("minhash").alias("match_type"), F.col("source").alias("existing_source")).distinct())
        return found

    def decide(self, docs: DataFrame, types: tuple[list[str], dict[str, str]] | None = None, sources: list[str] | None = None, distance: int = SIMHASH_DISTANCE) -> DataFrame:
        """(seq, keep, match_type): a match drops a document unless its priority is strictly better than that of all documents it matches; the first kind of match decides."""
        m = self.matches(docs, distance)
        rank_s = F.min(priority_rank(F.col("existing_source"), sources or []))
        rank_t = F.min(type_rank(F.col("existing_source"), *types)) if types else F.lit(None).cast("int")
        best = m.groupBy("seq", "match_type").agg(rank_s.alias("bs"), rank_t.alias("bt"))
        kind = best.groupBy("seq").agg(F.max("match_type").alias("match_type")).join(best, ["seq", "match_type"])
        who = docs.select("seq", "source").join(kind, "seq", "left")
        keep = keep_incoming(F.col("source"), F.col("bt") if types else None, F.col("bs"), types, sources)
        return who.select("seq", (F.col("match_type").isNull() | keep).alias("keep"), "match_type")
