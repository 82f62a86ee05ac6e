"""WARC archives: writing with revisits and segments, reading with reassembly.

Writing. A page becomes a response record whose block is an HTTP message in chunked transfer framing, or, where an equal
payload has a record already, a revisit record with HTTP headers alone. Blocks longer than SEGMENT bytes are
split: the first part stays in the response record (WARC-Segment-Number 1), the others follow as continuation records
that name the first one in WARC-Segment-Origin-ID; the last gives WARC-Segment-Total-Length. Spark's own text writer
puts the records into files (the record separator is its line separator), so files appear in any store, only
when a task commits, and compressed if asked (a file is one gzip member then, not one for each record). A revisit names the
record that it refers to by target URI and date, as the revisit profile wants it, and by the page's key.

Reading. Files are parsed one by one. Records that were never split are decoded where they are found; segments are
grouped by the identifier of their origin, ordered by number and joined, and the sum of their lengths is held
against the total, wherever the parts lay. Chunked framing is then decoded.

Archives keep to files of FILE_RECORDS records, because a file is parsed by one task.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dealt_anew

SEGMENT = 65_536
CHUNK = 8_192
FILE_RECORDS = 2_000
SEPARATOR = "\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that breaks the format."""


def digest_name(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


# -- records ------------------------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing (RFC 9112, 7.1)."""
    parts = [b"%x\r\n%b\r\n" % (len(p := payload[i : i + size]), p) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise WarcError("a chunk's size line is missing")
        try:
            size = int(framed[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            raise WarcError("a chunk's size is not a number") from None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise WarcError("a chunk is cut short")
        parts.append(framed[at : at + size])
        at += size + 2


def record(headers: dict[str, object], block: bytes) -> bytes:
    """A record without the separator that follows it."""
    lines = [b"WARC/1.1"] + [f"{k}: {v}".encode() for k, v in headers.items() if v is not None] + [b"Content-Length: %d" % len(block)]
    return b"\r\n".join([*lines, b"", block])


def parse_headers(head: bytes) -> dict[str, str]:
    """Names in lower case; the first line is left out."""
    found = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return found


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    at = 0
    while at < len(archive):
        end = archive.find(b"\r\n\r\n", at)
        if end < 0 or not archive.startswith(b"WARC/", at):
            raise WarcError(f"no record at byte {at}")
        headers = parse_headers(archive[at:end])
        start = end + 4
        stop = start + int(headers["content-length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise WarcError(f"the record at byte {at} is not as long as it says")
        yield headers, archive[start:stop]
        at = stop + 4


def http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers and the payload of a whole block."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("a block has no HTTP headers")
    headers = parse_headers(head)
    return headers, unchunked(body) if headers.get("transfer-encoding", "").lower() == "chunked" else body


# -- writing ------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, payload: Column, key: str, url: str, least: int = 0) -> DataFrame:
    """pages with __payload, __sha1 (hex), __first and __first_url: of equal payloads of at least `least` bytes the smallest key and that row's url (the smallest of repeated keys), null for that one itself and for shorter ones.

    Payloads are told apart by digest and length. Rows with a null key refer to the smallest key if there is one. Groups are
    counted before they move, and the join's hot partitions are split by adaptive execution.
    """
    rows = pages.withColumn("__payload", payload)
    rows = rows.withColumns({"__sha1": F.sha1("__payload"), "__size": F.octet_length("__payload")})
    first = rows.where(F.col("__size") >= least).groupBy("__sha1", "__size").agg(F.min(F.when(F.col(f"`{key}`").isNotNull(), F.struct(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url")))).alias("__least"))
    out = rows.join(dealt_anew(first, "__sha1", "__size"), ["__sha1", "__size"], "left")
    other = ~F.col(f"`{key}`").eqNullSafe(F.col("__least.key"))
    return out.withColumns({"__first": F.when(other, F.col("__least.key")), "__first_url": F.when(other, F.col("__least.url"))}).drop("__size", "__least")


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0, segment: int = SEGMENT, compression: str = "gzip") -> None:
    """Writes a record for each page (null html: an empty payload) into a folder of archives.

    Repeated rows of one key and payload are a response each; null urls become urn:page:<key>. Other columns are left out; no
    pages give archives without records. A page of any length is one row's payload in memory, cut into segments one at a time.
    """
    rows = with_revisits(pages.select(F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")), F.coalesce(F.col("html").cast("binary"), F.lit(b"")), "id", "url", least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            out, size = [], 0
            for i, u, payload, sha1, first, first_url in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n += 1
                for r in page_records(i, u, payload, bytes.fromhex(sha1), first, first_url, f"{task}-{n}", segment):
                    out.append(r)
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    made = rows.select("id", "url", "__payload", "__sha1", "__first", "__first_url").mapInArrow(run, "record binary")
    made.select(F.col("record").cast("string")).write.option("lineSep", SEPARATOR).option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def target_uri(key, url: str | None) -> str:
    return quote(url, safe=":/?#[]@!$&'()*+,;=%~-._") if url else f"urn:page:{key}"


def page_records(key, url: str | None, payload: bytes, sha1: bytes, first, first_url: str | None, mark: str, segment: int) -> Iterator[bytes]:
    """The records of one page; `mark` makes their identifiers unique in the archive."""
    name = f"<urn:granary:{key}:{mark}>"
    headers = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": name,
        "WARC-Date": DATE,
        "WARC-Target-URI": target_uri(key, url),
        "WARC-Page-ID": key,
        "WARC-Payload-Digest": f"sha1:{digest_name(sha1)}",
        "Content-Type": "application/http; msgtype=response",
    }
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None:
        yield record(headers | {"WARC-Profile": PROFILE, "WARC-Refers-To-Target-URI": target_uri(first, first_url), "WARC-Refers-To-Date": DATE, "WARC-Refers-To-Page-ID": first}, http + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment:
        yield record(headers, block)
        return
    yield record(headers | {"WARC-Segment-Number": 1}, block[:segment])
    for k, at in enumerate(range(segment, len(block), segment), 2):
        total = len(block) if at + segment >= len(block) else None
        yield record(
            {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:granary:{key}:{mark}:{k}>", "WARC-Date": DATE, "WARC-Target-URI": headers["WARC-Target-URI"], "WARC-Segment-Number": k, "WARC-Segment-Origin-ID": name, "WARC-Segment-Total-Length": total},
            block[at : at + segment],
        )


# -- reading ------------------------------------------------------------------------------------

PARTS = "origin string, number int, total long, type string, url string, page_id long, refers_to long, digest string, block binary"
WHOLE = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_parts(spark: SparkSession, path: str, segments: bool | None = None) -> DataFrame:
    """A row for each record of the archives: a segment, or a whole record (number null). segments: only those, or (False) none of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if name.endswith(".gz"):
                    import gzip

                    content = gzip.decompress(content)
                out, size = [], 0
                for h, block in records(content):
                    number = h.get("warc-segment-number")
                    if segments is not None and segments == (number is None):
                        continue
                    whole = lambda k, h=h: int(h[k]) if k in h and h[k] != "None" else None
                    origin = h.get("warc-segment-origin-id") or h.get("warc-record-id")
                    out.append((origin, None if number is None else int(number), whole("warc-segment-total-length"), h.get("warc-type"), h.get("warc-target-uri"), whole("warc-page-id"), whole("warc-refers-to-page-id"), h.get("warc-payload-digest"), block))
                    size += len(block)
                    if size > 8 << 20:
                        yield _batch(out, PARTS)
                        out, size = [], 0
                if out:
                    yield _batch(out, PARTS)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, PARTS)


def reassembled(parts: DataFrame) -> DataFrame:
    """Segments to whole records (PARTS, number null): grouped by origin, in the order of their numbers.

    A missing or repeated number, or a sum of lengths other than the total, raises WarcError.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, blocks, total = None, [], None

        def joined() -> tuple:
            block = b"".join(blocks)
            if total != len(block):
                raise WarcError(f"{first[0]} has {len(block)} bytes of {total}")
            return (first[0], None, None, *first[3:8], block)

        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if first is None or row[0] != first[0]:
                    if first is not None:
                        out.append(joined())
                    first, blocks, total = row, [], None
                if row[1] != len(blocks) + 1:
                    raise WarcError(f"{row[0]} has segment {row[1]} in place {len(blocks) + 1}")
                blocks.append(row[8])
                total = row[2] if row[2] is not None else total
            if out:
                yield _batch(out, PARTS)
        if first is not None:
            yield _batch([joined()], PARTS)

    return parts.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(run, PARTS)


def decoded(parts: DataFrame) -> DataFrame:
    """Whole records to pages (WHOLE). A payload is held against its digest; a revisit has the length of its HTTP headers and no payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for _, _, _, kind, url, page, refers, digest, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                headers, payload = http_payload(block)
                said = (digest or "").removeprefix("sha1:")
                if kind == "revisit":
                    out.append((page, url, kind, refers, int(headers["content-length"]), said, None))
                    continue
                made = digest_name(hashlib.sha1(payload).digest())
                if said and said != made:
                    raise WarcError(f"page {page} has another payload than its digest says")
                out.append((page, url, kind, None, len(payload), made, payload))
            if out:
                yield _batch(out, WHOLE)

    return parts.mapInArrow(run, WHOLE)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The archives' pages. An empty folder of archives gives no rows.

    Files are read twice, once for whole records and once for segments: that costs a second pass over compressed files and
    their headers, where one pass would have to write or shuffle every payload.
    """
    return decoded(read_parts(spark, path, False)).unionByName(decoded(reassembled(read_parts(spark, path, True))))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])
