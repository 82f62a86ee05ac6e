"""Whole texts to ids with the tokenizers library, each distinct word of a batch once.

Two kinds of tokenizer part a text into words that the library encodes independently of their neighbours:

*   byte level with the usual pattern and no normaliser: a word is a run without white space with the one
    space or line feed before it;
*   those that drop white space and normalise within words: a word is a run without white space.

For these a batch is split and its distinct words numbered by Arrow; ids of words come from a cache bounded in bytes, and a text's ids
are gathered by the numbers of its words. The words that are not in the cache are joined into one text, between
separators that always become one id of their own, and the library encodes them in a single call. All other
tokenizers, and texts with an added token's string, repeated or rare white space, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Bytes that the word cache may take.
CACHE_BYTES = 32 << 20
#: White space other than space and line feed, as the patterns or Python know it (fixed values).
RARE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: What Python's split() takes for white space and the patterns do not.
SEPARATORS = re.compile("[\x1c-\x1f]")
SEPARATING_DIGIT = "7"
#: Signs behind a word of Latin letters that both kinds of tokenizer part from it.
TAIL = ".,!?;:|*&%$#"
TAILED = f"^(?P<stem>[\\r\\n]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<tail>[{TAIL}]+)$"


class Ids(NamedTuple):
    """Ids of words: those of word i are pool[starts[i] : starts[i] + sizes[i]]."""

    pool: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words one after another, and where each word's end (a number more than words)."""
        sizes = self.sizes[at]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        place = np.repeat(self.starts[at] - ends[:-1], sizes)
        place += np.arange(len(place))
        return self.pool[place], ends


def joined(parts: list[Ids]) -> Ids:
    bases = np.cumsum([0, *(len(p.pool) for p in parts)])
    return Ids(np.concatenate([p.pool for p in parts]), np.concatenate([p.starts + b for p, b in zip(parts, bases, strict=False)]), np.concatenate([p.sizes for p in parts]))


class WordCache:
    """Words and their ids in flat arrays of at most `cap` bytes; beyond it the words used least lately go."""

    def __init__(self, dtype: np.dtype, cap: int = CACHE_BYTES):
        self.cap, self.now = cap, 0
        self.words = pa.array([], pa.large_string())
        self.ids = Ids(np.empty(0, dtype), np.empty(0, np.int64), np.empty(0, np.int64))
        self.used = np.empty(0, np.int64)

    def look_up(self, words: pa.Array) -> np.ndarray:
        """The place of each word, -1 for those that the cache lacks."""
        at = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy().astype(np.int64)
        self.now += 1
        self.used[at[at >= 0]] = self.now
        return at

    def add(self, words: pa.Array, ids: Ids) -> None:
        """Distinct words that it lacks."""
        if words.nbytes + 24 * len(words) + ids.pool.nbytes > self.cap // 2:
            return
        self.words, self.ids = pa.concat_arrays([self.words, words]), joined([self.ids, ids])
        self.used = np.concatenate([self.used, np.full(len(words), self.now)])
        if self.words.nbytes + 24 * len(self.words) + self.ids.pool.nbytes > self.cap:
            left = np.sort(np.argsort(self.used, kind="stable")[len(self.used) // 2 :])
            pool, ends = self.ids.of(left)
            self.words, self.ids, self.used = self.words.take(pa.array(left)), Ids(pool, ends[:-1], np.diff(ends)), self.used[left]


class TextEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        top = max(self.library.get_vocab(with_added_tokens=True).values())
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.known, self.tails = WordCache(self.dtype), {}
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
        steps = [s["type"] for s in pre.get("pretokenizers", [])]
        self.parted = None
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not norm:
            self.parted, self.resolve, self.mark = self._byte_level, self._resolve_byte_level, self.whole("\n")
        elif steps == ["Split", "ByteLevel"] and self._drops_white_space(pre) and [s["type"] for s in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            self.parted, self.resolve, self.mark = self._plain_words, self._resolve_plain, self.whole(SEPARATING_DIGIT)
        if self.parted and len(self.mark) != self.dtype.itemsize:
            self.parted = None

    @staticmethod
    def _drops_white_space(pre: dict) -> bool:
        """The pattern keeps what it matches, none of it white space, and takes digits one by one."""
        split = pre["pretokenizers"][0]
        pattern = split["pattern"].get("Regex", " ")
        return split["behavior"] == "Removed" and split["invert"] and " " not in pattern and "|[\\p{N}]|" in pattern

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    # -- a text as words with one space between them, None if the library must see it whole

    def _byte_level(self, text: str) -> str | None:
        """The word at a line's start has "\\n" before it, the text's first word "\\r"."""
        if RARE.search(text) or "\n\n" in text or " \n" in text or "\n " in text or "  " in text or text[0] in " \n" or text[-1] in " \n":
            return None
        return "\r" + text.replace("\n", " \n")

    def _plain_words(self, text: str) -> str | None:
        if SEPARATORS.search(text):
            return None
        try:  # words in lower case repeat more; in these characters it changes nothing else
            text.encode("latin-1")
            lower = text.lower()
            text = text if any(t in lower for t in self.added) else lower
        except UnicodeEncodeError:
            pass
        return " ".join(text.split()) if RARE.search(text) else text.replace("\n", " ")

    # -- ids of words

    def of_words(self, words: pa.Array) -> Ids:
        """The ids of distinct words. Words of letters with a tail of signs have the ids of both; words that the cache lacks go to the library."""
        found = pc.extract_regex(words, TAILED)
        stem, tail = found.field("stem"), found.field("tail")
        tailed = pc.is_valid(found)
        stems = pc.if_else(tailed, stem, words).dictionary_encode()
        tails = pc.if_else(tailed, tail, "").dictionary_encode()
        at = self.known.look_up(stems.dictionary)
        missing = at < 0
        parts, ends = [self.known.ids], self._tails(tails.dictionary.to_pylist())
        if missing.any():
            lacking = stems.dictionary.filter(pa.array(missing))
            parts.append(self.resolve(lacking.to_pylist()))
            at[missing] = len(self.known.used) + np.arange(len(lacking))
        both = joined([*parts, ends])
        if missing.any():
            self.known.add(lacking, parts[1])
        pairs = np.empty((len(words), 2), np.int64)
        pairs[:, 0] = at[stems.indices.to_numpy()]
        pairs[:, 1] = tails.indices.to_numpy() + (len(both.starts) - len(ends.starts))
        pool, borders = both.of(pairs.ravel())
        borders = borders[::2]
        return Ids(pool, borders[:-1], np.diff(borders))

    def _tails(self, tails: list[str]) -> Ids:
        found = []
        for t in tails:
            if (ids := self.tails.get(t)) is None:
                ids = self.whole(t) if t else b""
                if len(self.tails) < 10_000 and len(t) < 64:
                    self.tails[t] = ids
            found.append(ids)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        return Ids(np.frombuffer(b"".join(found), self.dtype), np.cumsum(sizes) - sizes, sizes)

    def _resolve_byte_level(self, words: list[str]) -> Ids:
        kinds = np.array([1 if w[:1] == "\n" else 2 if w[:1] == "\r" else 0 for w in words])
        inner, starts, first = ([words[i] for i in np.flatnonzero(kinds == k)] for k in range(3))
        return self._ordered(kinds, [self._together([" " + w for w in inner], "\n"), self._together([w[1:] for w in starts], "\n", True), self._together([w[1:] for w in first], "\n")])

    def _resolve_plain(self, words: list[str]) -> Ids:
        kinds = np.array([0 if not w else 2 if SEPARATING_DIGIT in w else 1 for w in words])
        alone = [np.frombuffer(self.whole(words[i]), self.dtype) for i in np.flatnonzero(kinds == 2)]
        sizes = np.array([len(x) for x in alone], np.int64)
        none = Ids(np.empty(0, self.dtype), np.zeros((kinds == 0).sum(), np.int64), np.zeros((kinds == 0).sum(), np.int64))
        by_itself = Ids(np.concatenate([np.empty(0, self.dtype), *alone]), np.cumsum(sizes) - sizes, sizes)
        return self._ordered(kinds, [none, self._together([words[i] for i in np.flatnonzero(kinds == 1)], f" {SEPARATING_DIGIT} "), by_itself])

    @staticmethod
    def _ordered(kinds: np.ndarray, parts: list[Ids]) -> Ids:
        """Words of several kinds, each kind's in order, to the order in which `kinds` has them."""
        all_, at = joined(parts), np.argsort(np.argsort(kinds, kind="stable"), kind="stable")
        return Ids(all_.pool, all_.starts[at], all_.sizes[at])

    def _together(self, words: list[str], separator: str, marked: bool = False) -> Ids:
        """The library's ids of words from one call; marked: with the separator's one id before each."""
        if not words:
            return Ids(np.empty(0, self.dtype), np.empty(0, np.int64), np.empty(0, np.int64))
        text = separator.join(words)
        ids = np.array(self.library.encode_batch_fast([separator + text if marked else text], add_special_tokens=False)[0].ids, self.dtype)
        cuts = np.flatnonzero(ids == np.frombuffer(self.mark, self.dtype)[0])
        if len(cuts) != len(words) - (not marked):
            raise AssertionError("separators became other ids")
        starts = cuts if marked else np.concatenate([[0], cuts + 1])
        ends = np.append(cuts[marked:], len(ids))
        return Ids(ids, starts.astype(np.int64), ends - starts)

    # -- texts

    def ids(self, texts: list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts (null: empty) one after another, each with the end id if there is one, and how many each text has."""
        parted: list[str | None] = []
        alone: dict[int, np.ndarray] = {}
        for i, t in enumerate(texts):
            words = self.parted(t) if t and self.parted and not any(a in t for a in self.added) else None
            if t and words is None:
                alone[i] = np.frombuffer(self.whole(t), self.dtype)
            parted.append(words)
        split = pc.split_pattern(pa.array(parted, pa.large_string()), " ")
        offsets = split.offsets.to_numpy()
        words = split.values.dictionary_encode()
        flat, ends = self.of_words(words.dictionary).of(words.indices.to_numpy())
        borders = ends[offsets]
        counts = np.diff(borders)
        if alone:
            pieces = np.split(flat, borders[1:-1])
            for i, found in alone.items():
                pieces[i], counts[i] = found, len(found)
            flat = np.concatenate(pieces)
        if end is not None:
            flat = np.insert(flat, np.cumsum(counts), end)
            counts = counts + 1
        return flat, counts


@cache
def encoder(path: str) -> TextEncoder:
    """One for each Python worker; its word cache is bounded."""
    return TextEncoder(path)
