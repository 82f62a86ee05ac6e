"""Sources: from files to raw records (schema RAW), by kind.

seq orders the records of a run: the source's rank, then file and line. Numbers of lines and rows are places within a split plus the counts of
the splits before, which a first pass takes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import collapse_white
from ..storage import put


@dataclass(frozen=True)
class SourceSpec:
    """A source of a run; options that are None take their kind's default."""

    name: str
    kind: str
    dataset: str | list[str] | None = None
    text_field: str = "text"
    license_field: str = "license"
    url_field: str = "url"
    id_field: str = "id"
    limit_docs: int | None = None
    license: str | None = None
    language: str | None = None
    data_tag: str | None = None
    min_text_length: int | None = None
    chunk_mode: str | None = None
    chunk_size: int | None = None
    chunk_overlap: int | None = None
    url_pattern: str | None = None
    metadata: dict[str, str] = field(default_factory=dict)
    schema: dict | None = None
    extractor: str | None = None
    #: The names of a folder's files that are read; None: those of its kind.
    file_glob: str | None = None


Reader = Callable[[SparkSession, SourceSpec], DataFrame]
_static: dict[str, Reader] = {}
_dynamic: dict[str, Reader] = {}


def register_source(kind: str, reader: Reader) -> None:
    if kind in _static:
        raise ValueError(f"source kind {kind} is built in")
    _dynamic[kind] = reader


def unregister_source(kind: str) -> None:
    _dynamic.pop(kind, None)


def list_sources() -> list[str]:
    return sorted({*_static, *_dynamic})


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Raw records of a source, with its limit, shortest length and metadata applied."""
    reader = _static.get(spec.kind) or _dynamic.get(spec.kind)
    if reader is None:
        raise ValueError(f"unknown source kind {spec.kind}; there are {', '.join(list_sources())}")
    df = reader(spark, spec)
    if spec.min_text_length:
        long = F.length("text") >= spec.min_text_length
        df = df.where(long | F.col("error").isNotNull() if "error" in df.columns else long)
    if spec.metadata:
        own = F.create_map(*[F.lit(str(x)) for kv in spec.metadata.items() for x in kv])
        df = df.withColumn("extra", F.map_from_entries(F.array_distinct(F.concat(F.map_entries(F.map_filter(F.coalesce("extra", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(list(spec.metadata)))), F.map_entries(own)))))
    if spec.limit_docs is not None:
        df = df.orderBy("seq").limit(spec.limit_docs)
    return df


def union_sources(spark: SparkSession, specs: list[SourceSpec], rank: Callable[[SourceSpec], int] | None = None) -> DataFrame:
    """All sources one after another, the better ranked first (equal ranks as listed); seq says so."""
    order = sorted(specs, key=rank) if rank else specs
    out = None
    for i, spec in enumerate(order):
        df = read_source(spark, spec).withColumn("seq", F.col("seq") + F.lit(i) * F.lit(1 << 52))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("a run has at least one source")
    return out


def paths_of(spec: SourceSpec) -> list[str]:
    """The dataset's paths without repeats, in their order."""
    d = spec.dataset
    if not d:
        raise ValueError(f"source {spec.name} has no dataset")
    return list(dict.fromkeys(d if isinstance(d, list) else [d]))


#: Rows of a table of files, or of parts of files, that is sent to every task; larger ones are joined by a shuffle.
SENT = 100_000


def with_place(rows: DataFrame, counts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows with before (long): how many rows the parts of a source have that come before theirs. counts (keys..., n) has a row a part.

    The window sees a row a file or split, never a row of data.
    """
    starts = counts.withColumn("before", F.sum("n").over(Window.orderBy(*order)) - F.col("n")).drop("n")
    return rows.join(F.broadcast(starts) if counts.count() <= SENT else starts, keys)


#: Names of the files of kinds that read files.
GLOBS = {"local_jsonl": "*.jsonl", "pdf": "*.pdf", "web_pdf": "*.pdf", "parquet": "*.parquet", "hf_stream": "*.parquet", "html_pages": "*.parquet"}


def source_files(spark: SparkSession, spec: SourceSpec) -> list[tuple[str, int]]:
    """(path, bytes) of a source's files by path, from Spark's own listing; nothing for kinds that read no files. No file is opened."""
    if spec.kind not in GLOBS or not spec.dataset:
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", spec.file_glob or GLOBS[spec.kind]).load(paths_of(spec))
    return sorted((r["path"], r["length"]) for r in files.select("path", "length").collect())


# -- JSON lines -----------------------------------------------------------------------------------


def text_splits(spark: SparkSession, paths: list[str], glob: str = "*.jsonl") -> DataFrame:
    """(source_file, split, part, at, value): lines, the byte at which their split of the file begins, the task that reads it and a number that grows in it.

    Spark cuts files at byte ranges and moves each cut to the next line feed, so one large file has many readers.
    """
    # both passes over the files have to cut them alike, also if the cluster grows between them
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", "\n").text(paths)
    meta = F.col("_metadata")
    return files.select(meta["file_path"].alias("source_file"), meta["file_block_start"].alias("split"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "value")


def numbered_lines(spark: SparkSession, paths: list[str], glob: str = "*.jsonl") -> DataFrame:
    """(source_file, source_line, seq, value): every line of every file with its number in the file, from 1, and in the source, from 0; files by name.

    The first pass counts the lines of each split, the second adds the counts of the splits before. Neither shuffles a line. Bytes that are no
    UTF-8 are replaced. Compressed files cannot be cut, a task reads each.
    """
    lines = text_splits(spark, paths, glob)
    # files are named where all are listed; a line or more a split
    counts = put(lines.groupBy("source_file", "split", "part").agg(F.count("*").alias("n"), F.min("at").alias("first")))
    files = counts.groupBy("source_file").agg(F.sum("n").alias("n"))
    of_file = files.withColumn("of_file", F.sum("n").over(Window.orderBy("source_file")) - F.col("n")).drop("n")
    of_split = F.sum("n").over(Window.partitionBy("source_file").orderBy("split")) - F.col("n")
    starts = counts.withColumn("of_split", of_split).drop("n").join(of_file, "source_file")
    starts = F.broadcast(starts) if counts.count() <= SENT else starts
    placed = lines.join(starts, ["source_file", "split", "part"], "left")
    known = F.when(F.col("first").isNull(), F.raise_error(F.lit("files changed, or were cut otherwise, between two passes"))).otherwise(F.col("at") - F.col("first") + F.col("of_split"))
    placed = placed.withColumn("line", known.cast("long"))
    return placed.select("source_file", (F.col("line") + 1).alias("source_line"), (F.col("line") + F.col("of_file")).alias("seq"), F.make_valid_utf8("value").alias("value"))


def local_jsonl(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """JSON lines in a file, list, folder or glob; a path that does not exist is an error. Blank lines and lines that are not objects are passed over; without an id the file's stem and line serve."""
    v = F.col("value")
    get = lambda name: F.get_json_object(v, f"$['{name}']")
    rows = numbered_lines(spark, paths_of(spec), spec.file_glob or GLOBS[spec.kind]).where(F.trim(v) != "").where(F.schema_of_variant(F.try_parse_json(v)).startswith("OBJECT"))
    stem = F.regexp_extract("source_file", r"([^/]+?)(\.[^./]*)?$", 1)
    fields = F.from_json(v, "map<string,string>")
    extra = F.map_filter(fields, lambda k, x: ~k.isin([spec.text_field, spec.license_field, spec.url_field, spec.id_field]) & x.isNotNull())
    return rows.select(F.coalesce(get(spec.id_field), F.concat_ws("_", stem, "source_line")).alias("raw_id"), F.coalesce(get(spec.text_field), F.lit("")).alias("text"), F.lit(spec.name).alias("source"), get(spec.url_field).alias("url"), get(spec.license_field).alias("license"), get("created_at").alias("created_at"), extra.alias("extra"), "source_file", "source_line", "seq")


# -- tables ---------------------------------------------------------------------------------------


def parquet_table(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """A table, as a data set's local snapshot; columns beside the named ones become extra fields. The order is that of the files and rows."""
    df = spark.read.parquet(*paths_of(spec))
    named = [spec.text_field, spec.license_field, spec.url_field, spec.id_field]
    col = lambda c: F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string")
    others = [c for c in df.columns if c not in named]
    extra = F.create_map(*[x for c in others for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]) if others else F.create_map()
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    made = df.select(F.coalesce(col(spec.id_field), F.lit("")).alias("raw_id"), F.coalesce(col(spec.text_field), F.lit("")).alias("text"), F.lit(spec.name).alias("source"), col(spec.url_field).alias("url"), col(spec.license_field).alias("license"), col("created_at").alias("created_at"), F.map_filter(extra.cast("map<string,string>"), lambda _, x: x.isNotNull()).alias("extra"), path.alias("source_file"), (row + 1).alias("source_line"))
    # the rows of files come from their footers
    counts = put(df.groupBy(path.alias("source_file")).agg(F.count("*").alias("n")))
    return with_place(made, counts, ["source_file"], ["source_file"]).withColumn("seq", F.col("before") + F.col("source_line") - 1).drop("before")


# -- PDF -----------------------------------------------------------------------------------------

#: extractor name -> (bytes -> (metadata, list of page texts)); none is built in, because no PDF library is required.
_extractors: dict[str, Callable[[bytes], tuple[dict[str, str], list[str]]]] = {}


def register_extractor(name: str, extract: Callable[[bytes], tuple[dict[str, str], list[str]]]) -> None:
    _extractors[name] = extract


def fixed_size_chunks(text: str, size: int, overlap: int) -> list[str]:
    """Windows of `size` characters that end behind the last space or line feed of their last tenth, where it has one."""
    if size <= 0 or len(text) <= size:
        return [text]
    if not 0 <= overlap < 0.9 * size:
        raise ValueError("overlap must be at least 0 and below nine tenths of the size")
    # a window is its first nine tenths and as much of the rest as ends in white space, else all of it
    window = re.compile(rf"(?s).{{{int(size * 0.9) + 1}}}(?:.{{0,{size - int(size * 0.9) - 2}}}[ \n]|.{{0,{size - int(size * 0.9) - 1}}})" if size > 1 else "(?s).")
    spans = [(0, window.match(text).end())]
    while spans[-1][1] < len(text):
        start = spans[-1][1] - overlap
        spans.append((start, len(text) if len(text) - start <= size else window.match(text, start).end()))
    return [text[s:e] for s, e in spans]


PDF_UNITS = "raw_id string, text string, unit string, no int, metadata map<string,string>, path string, error string"


def pdf_units(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The units (document, page or fixed_size) of PDF files; a file that cannot be read gives a row with an error and no text."""
    if spec.extractor not in _extractors:
        raise ValueError(f"unknown extractor {spec.extractor}; there are {', '.join(sorted(_extractors)) or 'none'}")
    extract, mode = _extractors[spec.extractor], spec.chunk_mode or "document"
    size, overlap = spec.chunk_size or 0, spec.chunk_overlap or 0
    if mode not in ("document", "page", "fixed_size"):
        raise ValueError(f"unknown chunk mode {mode}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                stem = re.sub(r"\.[^./]*$", "", path.rsplit("/", 1)[-1])
                try:
                    meta, pages = extract(content)
                    meta = {k: str(v) for k, v in {**meta, "total_pages": len(pages)}.items() if v is not None}
                    whole = "\n\n".join(pages)
                    if mode == "page":
                        rows += [(f"{stem}_page_{i}", p, "page", i, {**meta, "page_number": str(i)}, path, None) for i, p in enumerate(pages, 1)]
                    elif mode == "fixed_size":
                        rows += [(f"{stem}_chunk_{i}", c, "chunk", i, {**meta, "chunk_number": str(i)}, path, None) for i, c in enumerate(fixed_size_chunks(whole, size, overlap))]
                    else:
                        rows.append((stem, whole, None, 0, meta, path, None))
                except Exception as e:  # noqa: BLE001 - one broken file must not end the run
                    rows.append((stem, None, None, 0, {}, path, f"{type(e).__name__}: {e}"))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string()]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            cols[4] = [list(m.items()) for m in cols[4]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["raw_id", "text", "unit", "no", "metadata", "path", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(paths_of(spec))
    units = files.select("path", "content").mapInArrow(run, PDF_UNITS)
    names = files.select("path").withColumn("n", F.lit(1).cast("long"))
    return with_place(units, put(names), ["path"], ["path"]).withColumnRenamed("before", "file_no")


def _without(entries: Column, key: str) -> Column:
    return F.map_filter(entries, lambda k, _: k != key)


def pdf(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """PDF units as raw records. A schema whose directory_pattern the folder matches adds prefix, suffix, mapped metadata and its default license.

    A file that cannot be read is a record with its error and without text, which a run rejects as CORRUPT_FILE.
    """
    u = pdf_units(spark, spec)
    url = F.when(F.col("unit").isNull(), F.col("path")).otherwise(F.concat("path", F.lit("#"), "unit", F.lit("="), F.col("no").cast("string")))
    extra, body, license = F.map_concat("metadata", F.create_map(F.lit("pdf_file"), F.col("path"))), F.col("text"), F.lit(spec.license)
    if spec.schema:
        s = spec.schema
        fits = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).rlike(s.get("directory_pattern") or "")
        body = F.when(fits, F.concat(F.lit(s.get("text_prefix", "")), body, F.lit(s.get("text_suffix", "")))).otherwise(body)
        for target, origin in (s.get("metadata_mapping") or {}).items():
            extra = F.when(fits & F.map_contains_key("metadata", origin), F.map_concat(_without(extra, target), F.create_map(F.lit(target), F.col("metadata")[origin]))).otherwise(extra)
        license = F.coalesce(F.when(fits, F.lit(s.get("default_license"))), license)
    seq = F.col("file_no") * (1 << 24) + F.col("no")
    return u.select("raw_id", F.coalesce(body, F.lit("")).alias("text"), F.lit(spec.name).alias("source"), url.alias("url"), license.cast("string").alias("license"), F.lit(None).cast("string").alias("created_at"), extra.alias("extra"), F.col("path").alias("source_file"), F.lit(None).cast("long").alias("source_line"), seq.alias("seq"), "error")


# -- web pages ------------------------------------------------------------------------------------


def page_links(pages: DataFrame, pattern: str | None = None, suffix: str = ".pdf", html: str = "html", base: str = "url") -> DataFrame:
    """(url): the distinct links of pages that match the pattern or end in the suffix, joined to their page's address."""
    href = F.explode(F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']+)["']"""), 1))
    found = pages.select(F.col(base).alias("base"), href.alias("href"))
    fits = F.endswith(F.lower("href"), F.lit(suffix))
    found = found.where(fits | F.col("href").rlike(pattern) if pattern else fits)
    origin = F.regexp_extract("base", r"^([a-zA-Z][\w+.-]*://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_extract("base", r"^([^?#]*)", 1), r"(?<=[^/]/)[^/]*$", "")
    absolute = F.when(F.col("href").rlike(r"^[a-zA-Z][\w+.-]*:"), F.col("href")).when(F.startswith("href", F.lit("//")), F.concat(F.regexp_extract("base", r"^([^:]+:)", 1), "href")).when(F.startswith("href", F.lit("/")), F.concat(origin, "href")).when(F.startswith("href", F.lit("#")), F.concat(F.regexp_extract("base", r"^([^#]*)", 1), "href")).otherwise(F.concat(folder, "href"))
    return found.select(absolute.alias("url")).distinct()


def html_pages(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """A table of pages (page_id, url, html) with tags and white space removed."""
    df = spark.read.parquet(*paths_of(spec))
    t = collapse_white(F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]+>", " "))
    return df.select(F.col("page_id").cast("string").alias("raw_id"), t.alias("text"), F.lit(spec.name).alias("source"), "url", F.lit(spec.license).cast("string").alias("license"), F.lit(None).cast("string").alias("created_at"), F.create_map().cast("map<string,string>").alias("extra"), F.col("_metadata.file_path").alias("source_file"), (F.col("_metadata.row_index") + 1).alias("source_line"), F.col("page_id").cast("long").alias("seq"))


def download(urls: DataFrame, fetch: Callable[[str], tuple[str, bytes]], retries: int = 3, wait_s: float = 1.0) -> DataFrame:
    """(url, content_type, content, error) by a fetcher that may raise; answers that are PDF neither by type nor by name are errors.

    No fetcher is built in: the engine itself opens no connections.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time

        for b in batches:
            rows = []
            for url in b.column(0).to_pylist():
                row = (url, None, None, "not tried")
                for k in range(retries):
                    try:
                        kind, content = fetch(url)
                        ok = "pdf" in (kind or "").lower() or ".pdf" in url.lower()
                        row = (url, kind, content if ok else None, None if ok else "not a PDF")
                        break
                    except Exception as e:  # noqa: BLE001 - tried again, then reported
                        row = (url, None, None, str(e))
                        if k + 1 < retries:
                            time.sleep(wait_s * 2**k)
                rows.append(row)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.binary(), pa.string()), strict=True)], ["url", "content_type", "content", "error"])

    return urls.select("url").mapInArrow(run, "url string, content_type string, content binary, error string")


def detect_language(c: Column, detector: Callable[[str], str], default: str = "en", chars: int = 1000, least: int = 50) -> Column:
    """Two letters of what a detector says about the head of the text; the default for short texts."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([default if len((t or "").strip()) < least else (detector(t[:chars]) or default)[:2].lower() for t in texts.to_pylist()], pa.string())

    return run(F.substring(c, 1, chars))


_static.update({"local_jsonl": local_jsonl, "parquet": parquet_table, "hf_stream": parquet_table, "pdf": pdf, "web_pdf": pdf, "html_pages": html_pages})
