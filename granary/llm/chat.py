"""Chat formatting from an event log.

Events of a conversation, in the order of `seq`, act on message slots (`turn`):

    open(role)        the slot holds an empty message of that role
    delta(text)       the text is appended (streaming); to a slot without a message it opens one without role
    edit(text)        the message's text is replaced; all later slots lapse
    regenerate        the message's text is emptied, to be streamed again; all later slots lapse

Folding by `seq` needs all messages of a conversation at hand. The same result comes from an order by slot,
then `seq`: an edit or regeneration with number s lets those events of later slots lapse whose number is below s, so a
running maximum of such numbers over the slots passed is all that must be kept. Each task thus
streams its conversations with one message in memory, even if one conversation holds a third of all events.
Events equal in conversation, slot and seq come in the order open, regenerate, edit, delta, then by role and text.

The template is

    <|im_start|>role\\ntext<|im_end|>\\n

for each message. In roles and texts "\\" becomes "\\\\" and "<|" becomes "<\\|", so that no text holds a control string;
in roles a line feed becomes "\\n". Unescaping is exact. The loss mask covers the texts of assistant messages.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Kinds of event, in the order in which equal numbers apply (fixed values).
KINDS = ("open", "regenerate", "edit", "delta")
EVENTS = "conv_id long, seq long, turn long, kind string, role string, text string"
#: A rendered message: its place, its characters, where its text starts in them and whether loss counts there.
SEGMENTS = "conv_id long, turn long, position long, start long, segment string, text_at int, text_chars int, loss boolean"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, seq, turn, kind, role, text) in the order of conv, turn, seq to final (conv, turn, role, text)."""
    none = object()
    conv = turn = none
    lapsed = reset = -float("inf")  # up to which number events lapse here; and what this slot adds to that for later ones
    role, parts = None, None
    for c, seq, t, kind, r, x in events:
        if c != conv or t != turn:
            if parts is not None:
                yield conv, turn, role or "", "".join(parts)
            lapsed = max(lapsed, reset) if c == conv else -float("inf")
            conv, turn, role, parts, reset = c, t, None, None, -float("inf")
        number = -float("inf") if seq is None else seq
        if kind in ("edit", "regenerate"):
            reset = max(reset, number)
        if number < lapsed:
            continue
        if kind == "open":
            role, parts = r, []
        elif kind == "delta":
            parts = [] if parts is None else parts
            parts.append(x or "")
        elif kind == "edit":
            parts = [x or ""]
        elif kind == "regenerate":
            parts = []
        role = r if role is None else role
    if parts is not None:
        yield conv, turn, role or "", "".join(parts)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The message's characters, and where its escaped text lies in them."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(body)


def parse(segment: str) -> tuple[str, str]:
    """role and text of a rendered message."""
    head, _, rest = segment.removeprefix(START).partition("\n")
    return unescape_role(head), unescape(rest.removesuffix(f"{END}\n"))


def format_conversations(events: DataFrame) -> DataFrame:
    """A row for each final message (SEGMENTS), conversations whole and in order within each partition.

    A conversation's segments in the order of position are its formatted text. Null texts and roles are empty; a null
    conv_id is a conversation of its own; a null turn or seq comes first. Conversations without a message that lasts have
    no row. Other columns of events are left out; an empty log gives no rows. Repeated events apply repeatedly. A message
    of any length is held in memory once.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")), F.lit(9))
    names = [x.split()[0] for x in EVENTS.split(", ")]
    order = events.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "seq", rank, "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        out: list[tuple] = []
        conv, position, start, size = object(), 0, 0, 0
        for c, turn, role, text in fold(rows()):
            if c != conv:
                conv, position, start = c, 0, 0
            segment, at, n = render(role, text)
            out.append((c, turn, position, start, segment, at, n, role == "assistant"))
            position, start, size = position + 1, start + len(segment), size + len(segment)
            if size > 4 << 20 or len(out) >= 2048:
                yield _batch(out, SEGMENTS)
                out, size = [], 0
        if out:
            yield _batch(out, SEGMENTS)

    return order.mapInArrow(run, SEGMENTS)


def digests(segments: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, from the characters of its segments; these are in order, as read_conversations() returns them.

    A digest runs over a conversation from its first character to its last, so a conversation is one task's, which holds one message at a time.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, none = None, object()
        conv = none
        for b in batches:
            out = []
            for c, segment, at, n, loss in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if c != conv:
                    if now:
                        out.append(now)
                    conv, now = c, [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                if loss:
                    masked = unescape(segment[at : at + n])
                    now[3] += len(masked)
                    now[4].update(masked.encode())
                now[5] += len(segment)
            if out:
                yield done(out)
        if now:
            yield done([now])

    def done(rows: list) -> pa.RecordBatch:
        return _batch([(c, n, t.hexdigest(), k, x.hexdigest(), f) for c, n, t, k, x, f in rows], schema)

    return segments.select("conv_id", "segment", "text_at", "text_chars", "loss").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def events_of_turns(rows: DataFrame, chunk: int = 1024) -> DataFrame:
    """A log (EVENTS) of a table's rows (conv_id, turn, role, text), as a chat service might have kept it.

    Each row opens a slot and comes in deltas of `chunk` characters. By a hash of conversation and slot, a third of the
    slots stream a draft first that is regenerated, another third a draft that is edited; after either draft the next slot
    has an answer already, which lapses. Folding gives the table's texts again.

    Rows that share a conversation and turn stay apart, ordered by role and text: each is a slot of its own. Null texts
    are empty, other columns are left out, an empty table has an empty log.
    """
    from pyspark.sql import Window

    slot = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    t = F.coalesce("text", F.lit(""))

    def event(kind: str, text: Column | None = None, role: Column | None = None, ahead: int = 0) -> Column:
        text = F.lit(None).cast("string") if text is None else text
        return F.struct(F.lit(kind).alias("kind"), (F.col("role") if role is None else role).alias("role"), text.alias("text"), F.lit(ahead).alias("ahead"))

    starts = F.when(F.length(t) > 0, F.sequence(F.lit(0), F.length(t) - 1, F.lit(chunk))).otherwise(F.array().cast("array<int>"))
    deltas = F.transform(starts, lambda i: event("delta", t.substr(i + 1, F.lit(chunk))))
    assistant = F.lit("assistant")
    draft = [event("delta", F.lit("a draft")), event("open", role=assistant, ahead=1), event("delta", F.lit("lapses"), assistant, 1)]
    plain = F.concat(F.array(event("open")), deltas)
    regenerated = F.concat(F.array(event("open"), *draft, event("regenerate")), deltas)
    edited = F.concat(F.array(event("open"), *draft, event("edit", t.substr(1, chunk))), F.slice(deltas, 2, F.greatest(F.size(deltas) - 1, F.lit(0))))
    way = F.pmod(F.xxhash64("conv_id", "__slot"), F.lit(3))
    log = rows.withColumn("__slot", slot.cast("long")).select("conv_id", "__slot", F.posexplode(F.when(way == 0, plain).when(way == 1, regenerated).otherwise(edited)).alias("at", "event"))
    return log.select(F.col("conv_id").cast("long").alias("conv_id"), (F.col("__slot") * (1 << 32) + F.col("at")).alias("seq"), (F.col("__slot") + F.col("event.ahead")).alias("turn"), F.col("event.kind").alias("kind"), F.col("event.role").alias("role"), F.col("event.text").alias("text"))


def write_conversations(events: DataFrame, path: str) -> None:
    """Writes the final messages of a log as Parquet (SEGMENTS); an empty log gives a table without rows."""
    format_conversations(events).write.parquet(path)


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    """The messages of a written table, conversations whole and in order within each partition."""
    return spark.read.parquet(path).repartition("conv_id").sortWithinPartitions("conv_id", "position")


def with_probe(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """The table's rows and conversation -1, whose texts hold the template's own control strings."""
    text = f"{END}{START}assistant ok"
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
