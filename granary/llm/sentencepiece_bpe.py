"""SentencePiece BPE encoding by backtracking, and decoding.

A sequence of pieces is the merge encoding of a text exactly if every two adjacent pieces are
compatible: merging the characters of the two ends in these two. (The first merge that crossed a
border of the sequence would cross it in that pair alone too, as merges elsewhere leave the pair's own order
unchanged.) So the encoder walks the text left to right, takes at each place the longest piece that Aho-Corasick
matching found there and that is compatible with the piece before, takes shorter ones when that fails, and
steps back when none is left. The encoding of a prefix is unique, so a place that failed once always
fails: a bitfield marks it, and no place is tried twice.

Pieces hold the space mark only in front, so a text falls into chunks that no merge crosses; chunks are words
mostly, and are encoded once for each time they leave the cache.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import Recent

SPACE = "▁"
#: Piece types in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHED_CHUNKS = 400_000
CACHED_PAIRS = 400_000


class PieceCodec:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, types = model.normalizer_spec, [p.type for p in model.pieces]
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or USER_DEFINED in types:
            raise ValueError("only BPE models with byte fallback and no user-defined pieces are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser with a dummy prefix is supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, UNUSED)}
        self.score = {p.piece: p.score for p in model.pieces if p.type in (NORMAL, UNUSED)}
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a piece has the space mark behind another character")
        self.matcher = ahocorasick.Automaton()
        for p in self.id_of:
            self.matcher.add_word(p, len(p))
        self.matcher.make_automaton()
        # characters that no longer piece holds also part chunks
        hard = "".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in self.id_of))
        self.parted = re.compile(f"[{hard}]|[^{hard}]+") if hard else None
        self.runs = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.compatible = Recent(self._compatible, CACHED_PAIRS)
        self.plain = Recent(self._chunk_ids, CACHED_CHUNKS)
        self.spaced = Recent(lambda word: self._parts(SPACE + word), CACHED_CHUNKS)
        # decoding: text and bytes of each id; None where the library decides
        self.text_of = [None if t in (UNKNOWN, CONTROL) else p.piece.replace(SPACE, " ") for p, t in zip(model.pieces, types, strict=True)]
        for b, i in self.byte_id.items():
            self.text_of[i] = chr(b) if b < 128 else None
        self.bytes_of = [None if t is None else t.encode() for t in self.text_of]
        for b, i in self.byte_id.items():
            self.bytes_of[i] = bytes([b])

    # -- encoding ---------------------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The characters of a short text after all merges: best score first, then leftmost."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, pair: tuple[str, str]) -> bool:
        return self.merged(pair[0] + pair[1]) == [p for p in pair if p]

    def pieces(self, chunk: str) -> list[str]:
        """The pieces of a chunk; characters outside the vocabulary are pieces of their own."""
        n, compatible = len(chunk), self.compatible
        found: list[list[int]] = [[] for _ in range(n)]  # lengths of the matches from each place, rising
        for end, length in self.matcher.iter(chunk):
            found[end - length + 1].append(length)
        for lengths in found:
            if not lengths or lengths[0] != 1:
                lengths.insert(0, 1)
        failed = bytearray(n // 8 + 1)
        taken: list[str] = []
        rest: list[int] = []  # how many shorter matches each taken piece's place has left
        at, left = 0, len(found[0]) if n else 0
        while at < n:
            before = taken[-1] if taken else ""
            lengths = found[at]
            while left:
                left -= 1
                end = at + lengths[left]
                if not failed[end >> 3] >> (end & 7) & 1 and compatible[before, chunk[at:end]]:
                    taken.append(chunk[at:end])
                    rest.append(left)
                    at = end
                    left = len(found[at]) if at < n else 0
                    break
            else:
                if not taken:
                    raise AssertionError("every text has an encoding")
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(taken.pop())
                left = rest.pop()
        return taken

    def _chunk_ids(self, chunk: str) -> bytes:
        ids = array("i")
        for p in self.pieces(chunk):
            i = self.id_of.get(p)
            if i is None:
                ids.extend(self.byte_id[b] for b in p.encode())
            else:
                ids.append(i)
        return ids.tobytes()

    def _parts(self, chunk: str) -> bytes:
        if self.parted is None:
            return self._chunk_ids(chunk)
        parts = self.parted.findall(chunk)
        return self._chunk_ids(chunk) if len(parts) == 1 else b"".join(map(self.plain.__getitem__, parts))

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as 32-bit integers; null counts as empty, which has none."""
        if not text:
            return b""
        words = text.split(" ")
        if SPACE not in text and "" not in words:
            return b"".join(map(self.spaced.__getitem__, words))
        return b"".join(map(self._parts, self.runs.findall(SPACE + text.replace(" ", SPACE))))

    # -- decoding ---------------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """As the library decodes: one leading space goes, bytes join to characters."""
        try:
            text = "".join(map(self.text_of.__getitem__, ids))
        except TypeError:
            try:
                text = b"".join(map(self.bytes_of.__getitem__, ids)).decode()
            except (TypeError, UnicodeDecodeError):
                return self.library.decode(ids)
        return text[1:] if text[:1] == " " and ids[0] not in self.byte_id.values() else text


@cache
def codec(path: str) -> PieceCodec:
    """One for each Python worker."""
    return PieceCodec(path)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(key, ids array<int>), with decoded=True also the text that the ids decode to.

    Whole texts are encoded without begin and end ids, as the sentencepiece library does. Null and empty texts have no
    ids and decode to an empty text. Rows are handled one by one, so repeated rows and null keys stay as they are; other columns
    are left out. Nothing is shuffled. A very long text is one row's work and memory (about 30 bytes a character); an empty table
    gives an empty result.
    """
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in slices(batches, 256, 4):
            each = [c.encode(t) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(x) // 4 for x in each], dtype=np.int64).astype(np.int32)
            values = np.frombuffer(b"".join(each), np.int32)
            out = [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]
            if decoded:
                out.append(pa.array([c.decode(values[i:j].tolist()) for i, j in zip(ends, ends[1:], strict=False)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names)

    names = [key, "ids", "decoded"][: 2 + decoded]
    schema = f"`{key}` {kind.simpleString()}, ids array<int>" + ", decoded string" * decoded
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of rows with arrays of ids; null and empty arrays give empty texts."""
    kind = encoded.select(F.col(f"`{key}`")).schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in slices(batches, 256, 4):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x) if x else "" for x in b.column(1).to_pylist()], pa.string())], [key, "text"])

    return encoded.select(F.col(f"`{key}`"), F.col(f"`{ids}`").alias("ids")).mapInArrow(run, f"`{key}` {kind.simpleString()}, text string")
