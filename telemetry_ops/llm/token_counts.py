"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces inside each unit of text, and dynamic programming carries
the best score and its number of pieces from position to position; no back pointers and no pieces are kept.

Tie rules of the unigram tokenizer: an edge replaces the best one found for its end only if its score is strictly
greater, and edges arrive by start position, so of equal scores the longest last piece wins. A character that is no
piece itself is an unknown edge of the lowest score minus 10, and counts as one piece per UTF-8 byte (byte fallback).
Scores are added exactly; a library that adds in single precision may round differently on very long units.

A space becomes the mark U+2581 and one is put before a text that is not empty. Only runs of marks hold a mark after
their first character, so a mark after any other character starts a new unit, and the best path of a text is the
best paths of its units. Null and empty texts have no tokens. Rows are independent: repeated rows give repeated
results, and other columns are ignored.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import public_tokenizers
from pyspark.sql import DataFrame, types as T

from telemetry_ops.llm.common import map_texts

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNKNOWN_PENALTY = 10
CACHED_UNITS = 300_000  # units whose counts a worker remembers
_COUNT_BITS = 40  # a unit's count sits below these bits, its negated score above


@functools.lru_cache(maxsize=2)
def unigram_pieces(path: str) -> tuple[tuple[str, int], ...]:
    """Ordinary pieces of a sentencepiece model with their (whole-number) scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), round(model.get_score(i))) for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))


class Counter:
    """Best score and piece count of units, from (piece, score) pairs."""

    def __init__(self, pieces):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def unit(self, text: str) -> tuple[int, int]:
        n = len(text)
        edges = [()] * n
        for end, edge in self.automaton.iter(text):  # of one end, the longest piece comes first
            edges[end] = (*edges[end], edge)
        best, count = [0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            top, pieces, single = None, 0, False
            for length, score in edges[end]:
                start = end + 1 - length
                total = best[start] + score
                if top is None or total > top:
                    top, pieces = total, count[start] + 1
                single = single or length == 1
            if not single:
                total = best[end] + self.unknown
                if top is None or total > top:
                    top, pieces = total, count[end] + len(text[end].encode())
            best[end + 1], count[end + 1] = top, pieces
        return best[n], count[n]


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> tuple[Counter, dict]:
    return Counter(unigram_pieces(path)), {}


_UNITS = re.compile(f"{MARK}+[^{MARK}]*")


def units_of(text: str) -> list[str]:
    """Units of a text, each without its first mark."""
    if not text:
        return []
    if "  " not in text and not text.startswith(" ") and MARK not in text:
        return text.split(" ")
    return [unit[1:] for unit in _UNITS.findall(MARK + text.replace(" ", MARK))]


def token_counts(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``keys``, ``n_tokens``, ``path_score`` (score of the best segmentation) and ``n_units`` of every whole text."""
    def make():
        counter, cache = _counter(vocabulary)

        def work(texts):
            cut = [units_of(t.decode()) for t in texts]
            if len(cache) > CACHED_UNITS:
                cache.clear()
            for unit in set().union(*cut).difference(cache):
                score, count = counter.unit(MARK + unit)
                cache[unit] = (-score << _COUNT_BITS) + count
            totals = [sum(map(cache.__getitem__, units)) for units in cut]
            return {"n_tokens": [t & (1 << _COUNT_BITS) - 1 for t in totals],
                    "path_score": [float(-(t >> _COUNT_BITS)) for t in totals],
                    "n_units": [len(units) for units in cut]}

        return work

    return map_texts(docs, text, list(keys), [("n_tokens", T.LongType()), ("path_score", T.DoubleType()),
                                              ("n_units", T.LongType())], make)
