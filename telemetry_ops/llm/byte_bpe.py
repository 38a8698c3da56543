"""Byte-level BPE encoding with a segment tree over the ranks of adjacent pairs, and decoding.

Every leaf of the tree holds (rank of the pair that starts there, position); an inner node holds the smaller child,
so the root is the leftmost pair of lowest rank. A merge writes one token and updates three leaves (the merged pair,
its left neighbour, the token that went), each a walk to the root, until the root holds no mergeable pair. Short words
go through trees of equal size side by side in NumPy, long ones through a tree in lists; both give the same ids.

Words are cut by the tokenizer's own pattern. A single space between two characters that are not white space always
starts a word, so texts are first cut there and the ids of each unit are remembered; any text with another form of
white space around a space is cut by the pattern as a whole. The special token's string becomes its id.

Null and empty texts have no tokens. Rows are independent: repeated rows give repeated results; other columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, types as T

from telemetry_ops.llm.common import map_texts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CACHED_UNITS = 300_000  # units whose ids a worker remembers
_WIDEST = 64  # longer words use the tree in lists
_NONE = np.iinfo(np.int64).max
_ID_BITS = 20
_ODD = re.compile(r" \s")  # a space before white space


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next free code point."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


def literal(key: str) -> str:
    """The text of a unit: keys leave out the space most units start with, and one in front marks a unit without it."""
    return key[1:] if key.startswith(" ") else " " + key


class UnitCutter:
    """Cuts texts into units whose ids do not depend on their neighbours."""

    def __init__(self, special):
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def units(self, text: str) -> list[str]:
        """Keys of the units of a text (see :func:`literal`)."""
        if self.cut is not None and any(s in text for s in self.special):
            return [u for part in self.cut.split(text) if part
                    for u in ([" " + part] if part in self.special else self._plain_units(part))]
        return self._plain_units(text)

    def _plain_units(self, text: str) -> list[str]:
        if _ODD.search(text) or text.endswith(" "):
            return [" " + word for word in self.words.findall(text)]
        units = text.split(" ")
        if units[0]:
            units[0] = " " + units[0]
            return units
        return units[1:]


class SegmentTreeBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        letters = byte_letters()
        back = {letter: i for i, letter in enumerate(letters)}
        self.start = np.array([vocabulary[letter] for letter in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        keys = left << _ID_BITS | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.by_pair = dict(zip(keys.tolist(), range(len(pairs))))
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.cutter = UnitCutter(self.special)

    # -- merging ----------------------------------------------------------------------------------------------------

    def _ranks(self, left, right):
        wanted = left << _ID_BITS | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.rank[at], -1)

    def _side_by_side(self, words: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of words of 1 to ``width`` bytes (``width`` a power of two), one tree per row."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        inside = np.arange(width) < sizes[:, None]
        token = np.full((n, width), -1, np.int64)
        token[inside] = self.start[np.frombuffer(b"".join(words), np.uint8)]
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        after[np.arange(n), sizes - 1] = width
        tree = np.full((n, 2 * width), _NONE, np.int64)
        ranks = self._ranks(token[:, :-1], token[:, 1:])
        tree[:, width:-1] = np.where(ranks >= 0, ranks * width + np.arange(width - 1), _NONE)
        half = width // 2
        while half:
            pairs = tree[:, 2 * half:4 * half]
            tree[:, half:2 * half] = np.minimum(pairs[:, ::2], pairs[:, 1::2])
            half //= 2

        def update(rows, place, value):
            node = place + width
            tree[rows, node] = value
            node = node >> 1
            while len(node) and node[0]:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node = node >> 1

        def leaf(left, right, place):
            ranks = self._ranks(left, right)
            return np.where(ranks >= 0, ranks * width + place, _NONE)

        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            rows, root = rows[root < _NONE], root[root < _NONE]
            if not len(rows):
                break
            place, made = root % width, self.merged[root // width]
            gone = after[rows, place]
            then = after[rows, gone]
            token[rows, place], token[rows, gone] = made, -1
            after[rows, place] = then
            more = then < width
            before[rows[more], then[more]] = place[more]
            update(rows, gone, _NONE)
            follower = np.where(more, token[rows, np.minimum(then, width - 1)], -1)
            update(rows, place, leaf(made, follower, place))
            left = before[rows, place]
            has = left >= 0
            update(rows[has], left[has], leaf(token[rows[has], left[has]], made[has], left[has]))
        kept = token >= 0
        return np.split(token[kept].astype("<u4"), np.cumsum(kept.sum(1))[:-1])

    def _alone(self, word: bytes) -> np.ndarray:
        """Ids of one word of any length."""
        n = len(word)
        token = self.start[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        size = 1 << (n - 1).bit_length()
        none = (len(self.merged), 0)

        def leaf(i, j):
            rank = self.by_pair.get(token[i] << _ID_BITS | token[j]) if i >= 0 and j < n else None
            return none if rank is None else (rank, i)

        tree = [none] * (2 * size)
        tree[size:size + n] = [leaf(i, i + 1) for i in range(n)]
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def update(i, value):
            i += size
            tree[i] = value
            while i > 1:
                i >>= 1
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        while tree[1] is not none:
            rank, i = tree[1]
            gone = after[i]
            token[i], token[gone] = int(self.merged[rank]), -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            update(gone, none)
            update(i, leaf(i, after[i]))
            if before[i] >= 0:
                update(before[i], leaf(before[i], i))
        return np.array([t for t in token if t >= 0], "<u4")

    def encode_words(self, words: list[bytes]) -> dict[bytes, np.ndarray]:
        """Ids of distinct words (none empty)."""
        by_width: dict[int, list[bytes]] = {}
        out = {}
        for word in words:
            width = max(2, 1 << (len(word) - 1).bit_length())
            if width > _WIDEST:
                out[word] = self._alone(word)
            else:
                by_width.setdefault(width, []).append(word)
        for width, group in by_width.items():
            for i in range(0, len(group), 1 << 14):
                part = group[i:i + (1 << 14)]
                out.update(zip(part, self._side_by_side(part, width)))
        return out

    # -- texts ------------------------------------------------------------------------------------------------------

    def encode(self, texts: list[str], cache: dict) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. ``cache`` maps units to such ids."""
        plans = [self.cutter.units(t) for t in texts]
        spelt = {}
        for key in set().union(*plans).difference(cache):
            unit = literal(key)
            if unit in self.special:
                cache[key] = self.special[unit].to_bytes(4, "little")
            else:
                spelt[key] = [w.encode() for w in self.cutter.words.findall(unit)]
        ids = self.encode_words(list({w for words in spelt.values() for w in words}))
        for key, words in spelt.items():
            cache[key] = ids[words[0]].tobytes() if len(words) == 1 else b"".join(ids[w].tobytes() for w in words)
        return [b"".join(map(cache.__getitem__, plan)) for plan in plans]

    def decode(self, ids) -> str:
        """Text of token ids; bytes that are no valid UTF-8 become the replacement character."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> tuple[SegmentTreeBpe, dict]:
    """The tokenizer of this process and its cache of units."""
    return SegmentTreeBpe(path), {}


def bounded(cache: dict, most: int = CACHED_UNITS) -> dict:
    if len(cache) > most:
        cache.clear()
    return cache


def encode_texts(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
                 tokenizer: str = TOKENIZER) -> DataFrame:
    """``keys`` and ``ids`` (array of long) of every whole text."""
    def make():
        bpe, cache = codec(tokenizer)

        def work(texts):
            made = bpe.encode([t.decode() for t in texts], bounded(cache))
            return {"ids": [np.frombuffer(b, "<u4").astype(np.int64) for b in made]}

        return work

    return map_texts(docs, text, list(keys), [("ids", T.ArrayType(T.LongType()))], make)


def round_trip(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
               tokenizer: str = TOKENIZER) -> DataFrame:
    """``keys``, ``n_tokens`` and digests: of the ids as little-endian unsigned 32-bit integers, of the decoded text."""
    def make():
        bpe, cache = codec(tokenizer)

        def work(texts):
            made = bpe.encode([t.decode() for t in texts], bounded(cache))
            decoded = [bpe.decode(np.frombuffer(b, "<u4").tolist()) for b in made]
            return {"n_tokens": [len(b) // 4 for b in made],
                    "ids_sha256": [hashlib.sha256(b).hexdigest() for b in made],
                    "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for d in decoded]}

        return work

    return map_texts(docs, text, list(keys), [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()),
                                              ("decoded_sha256", T.StringType())], make)
