"""Language-model scores by the likelihood of a subword lattice.

Every way to cut a word into pieces of an existing unigram vocabulary is a path of its lattice; a path weighs the
product of its pieces' probabilities, and a forward recursion in log space adds all paths to the probability of the
word. Pieces never hold a word's mark after their start, so a document's lattice is its words' lattices in a row, and
its marginal probability the product of theirs and of the end.

The vocabulary and its scores are given, and weigh the segmentations to begin with: a score is minus the rank of a
piece, and ranks weigh as 1 / (rank + ``RANK_SHIFT``). Expectation maximisation over the training documents (expected
piece counts by forward and backward recursion, the given weights as prior) then learns the probabilities. The lattice
also has one edge for every whole word seen in training, with its count less an absolute discount; the discounts'
mass goes to the paths of pieces. So frequent words cost what they cost in training, any other word can be spelt, and
probabilities of all words add up to at most one. ``lattice_score`` leaves the whole-word edges out.

Tokens are words (runs of characters other than ASCII white space, A-Z lower-cased) and one end per document. A null
text is empty: it has the end alone. Training documents are those whose crc32(id as text) mod 10 is not 0; a null id is
never trained on. Repeated rows count each. Without training documents the base score is 0 and words are only spelt.

Scale: training counts are summed in tasks before they are shuffled. Scores of the most frequent words, at most
``HEAD_WORDS`` by count, go to every task; a document's other words are joined with the rest of the vocabulary, where no
word is frequent, so neither side has a hot key.
"""

from __future__ import annotations

import functools
from collections import Counter
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from telemetry_ops.llm.common import fold, map_texts, slices, with_row_ids, written
from telemetry_ops.llm.token_counts import MARK, VOCABULARY, unigram_pieces

FOLDS, HELD_OUT = 10, 0
RANK_SHIFT = 10
ROUNDS = 2  # of expectation maximisation
PRIOR = 1000.0  # weight of the given scores, in pieces
DISCOUNT = 0.75
HEAD_WORDS = 200_000  # words whose scores every task holds, at most
_FLUSH = 200_000  # distinct words counted in a task before they are passed on
_CHUNK = 20_000  # words whose lattices are built together
_LN10 = float(np.log(10))


class Lattices:
    """Lattices of many words at once over pieces with log probabilities."""

    def __init__(self, pieces: tuple):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, (piece, _) in enumerate(pieces):
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.size = np.array([*(len(p) for p, _ in pieces), 1], np.int64)  # the last one is any unknown character
        self.unknown = len(pieces)

    def edges(self, words: list[str]):
        """(word starts, word ends, from, to, piece, extra log weight) on one line of characters with gaps."""
        line = "\n".join(MARK + w for w in words)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])).astype(np.int64)
        flat = np.fromiter(chain.from_iterable(self.automaton.iter(line)), np.int64).reshape(-1, 2)
        to, piece = flat[:, 0] + 1, flat[:, 1]
        single = np.zeros(len(line) + 1, bool)
        single[to[self.size[piece] == 1]] = True
        single[starts[1:]] = True  # after a gap
        odd = np.flatnonzero(~single[1:]) + 1
        extra = np.array([-len(line[i - 1].encode()) * np.log(256) for i in odd.tolist()])
        to = np.concatenate((to, odd))
        piece = np.concatenate((piece, np.full(len(odd), self.unknown)))
        weight = np.concatenate((np.zeros(len(flat)), extra))
        return starts, starts + lengths, to - self.size[piece], to, piece, weight

    @staticmethod
    def _recursion(value, origin, target, weight, level):
        """Log-space sums into ``target`` from ``origin``, level by level."""
        order = np.lexsort((target, level))
        origin, target, weight, level = origin[order], target[order], weight[order], level[order]
        cuts = np.flatnonzero(np.diff(level, prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:]):
            x = value[origin[a:b]] + weight[a:b]
            first = np.flatnonzero(np.diff(target[a:b], prepend=-1))
            top = np.maximum.reduceat(x, first)
            sums = np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.append(first, b - a)))), first)
            value[target[a:b][first]] = top + np.log(sums)

    def forward(self, words: list[str], log_p: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability, over all segmentations."""
        return np.concatenate([self._run(words[i:i + _CHUNK], log_p)[0] for i in range(0, len(words), _CHUNK)]
                              or [np.zeros(0)])

    def _run(self, words, log_p):
        starts, ends, origin, target, piece, extra = self.edges(words)
        weight = log_p[piece] + extra
        alpha = np.full(int(ends[-1]) + 1, -np.inf)
        alpha[starts] = 0.0
        base = starts[np.searchsorted(starts, origin, side="right") - 1]
        self._recursion(alpha, origin, target, weight, target - base)
        return alpha[ends], alpha, (starts, ends, origin, target, piece, weight)

    def expected(self, words: list[str], counts: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Expected uses of every piece in the words, each taken ``counts`` times."""
        out = np.zeros(len(self.size))
        for i in range(0, len(words), _CHUNK):
            total, alpha, (starts, ends, origin, target, piece, weight) = self._run(words[i:i + _CHUNK], log_p)
            own = np.searchsorted(starts, origin, side="right") - 1
            beta = np.full(len(alpha), -np.inf)
            beta[ends] = 0.0
            self._recursion(beta, target, origin, weight, ends[own] - origin)
            share = np.exp(alpha[origin] + weight + beta[target] - total[own]) * counts[i:i + _CHUNK][own]
            out += np.bincount(piece, share, len(out))
        return out


@functools.lru_cache(maxsize=2)
def _lattices(path: str) -> Lattices:
    return Lattices(unigram_pieces(path))


def given_weights(path: str) -> np.ndarray:
    """Probabilities of pieces, the unknown character and the end, from the vocabulary's scores alone."""
    rank = -np.array([score for _, score in unigram_pieces(path)], float)
    usual = rank[rank < 1e6].max()
    weight = 1 / (np.append(rank, [usual, usual]) + RANK_SHIFT)
    return weight / weight.sum()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): every word of ``docs`` (text, train) with its count in training rows, 0 included."""
    def run(batches):
        seen: Counter = Counter()

        def flush():
            words = pa.array(list(seen), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for part in slices(batch, 0, 64, 1 << 20):
                texts, train = part.column(0).to_pylist(), part.column(1).to_pylist()
                seen.update(chain.from_iterable(t.lower().split() for t, use in zip(texts, train) if use))
                others = set(chain.from_iterable(t.lower().split() for t, use in zip(texts, train) if not use))
                seen.update(dict.fromkeys(others, 0))
                if len(seen) > _FLUSH:
                    yield flush()
        yield flush()

    return (docs.select("text", "train").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def learn(counts: DataFrame, n_ends: int, vocabulary: str = VOCABULARY, rounds: int = ROUNDS,
          prior: float = PRIOR) -> np.ndarray:
    """Probabilities of pieces, the unknown character and the end, learned from word counts (word, n)."""
    given = given_weights(vocabulary)
    p = given
    for _ in range(rounds):
        log_p = np.log(p)

        def run(batches, log_p=log_p):
            lattices = _lattices(vocabulary)
            total = np.zeros(len(lattices.size))
            for batch in batches:
                words = batch.column(0).to_pylist()
                if words:
                    total += lattices.expected(words, np.asarray(batch.column(1), float), log_p)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

        uses = np.zeros(len(given))
        found = counts.where("n > 0").select("word", "n").mapInArrow(run, "piece long, uses double")
        for r in found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():  # one row per piece at most
            uses[r["piece"]] = r["uses"]
        uses[-1] = n_ends
        p = (uses + prior * given) / (uses.sum() + prior)
    return p


def lm_scores(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY,
              head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per document: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``lattice_score`` (log10)."""
    out_of = F.col(key).isNull() | (fold(F.col(key), FOLDS) == HELD_OUT)
    source = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
                         (~out_of).alias("train"))
    counts = written(word_counts(source), "words")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                        F.count_if(F.col("n") > 0).alias("v")).first()
    n_ends = source.where("train").count()
    n, v = totals["n"] + n_ends, totals["v"] + (n_ends > 0)
    p = learn(counts, n_ends, vocabulary)
    log_p = np.log(p)
    marks = [i for i, (piece, _) in enumerate(unigram_pieces(vocabulary)) if piece.startswith(MARK)]
    log_end = float(log_p[-1] - np.log(p[marks].sum() + p[-1]))  # of words and end, which open a token

    def mixed(c, spelt):
        """Log of the probability of a token that was counted ``c`` times and is spelt with log ``spelt``."""
        if not n:
            return spelt
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(np.maximum(c - DISCOUNT, 0) / n), spelt + np.log(DISCOUNT * v / n))

    def base(c):
        return np.log10((c + 0.1) / (n + 0.1 * (v + 1)))

    def spell(batches):
        lattices = _lattices(vocabulary)
        for batch in batches:
            c = np.asarray(batch.column(1), float)
            spelt = lattices.forward(batch.column(0).to_pylist(), log_p[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(base(c)), pa.array(mixed(c, spelt) / _LN10),
                 pa.array(spelt / _LN10)], names=["word", "n", "base", "score", "spelt"])

    scored = written(counts.select("word", "n").mapInArrow(
        spell, "word string, n long, base double, score double, spelt double"), "scored")
    # the least count that at most ``head_words`` words reach, from a histogram of bounded size
    step = F.floor(F.log2("n") * 8).cast("int")
    size, least = 0, None
    for r in scored.where("n > 0").groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("w"), F.min("n").alias("n")
                                                                ).orderBy(F.desc("b")).collect():
        size += r["w"]
        if size > head_words:
            break
        least = r["n"]
    frequent = F.col("n") >= least if least is not None else F.lit(False)
    top = scored.where(frequent).collect()  # at most ``head_words`` rows
    head = {r["word"].encode(): i for i, r in enumerate(top)}
    values = np.array([[r["base"], r["score"], r["spelt"], r["n"] > 0] for r in top] + [[0.0] * 4])
    end = np.array([base(n_ends), mixed(n_ends, log_end) / _LN10, log_end / _LN10, n_ends > 0], float)
    fields = [("n_tokens", T.LongType()), ("known", T.LongType()), ("base", T.DoubleType()),
              ("score", T.DoubleType()), ("spelt", T.DoubleType()), ("rest", T.ArrayType(T.StringType())),
              ("rest_n", T.ArrayType(T.LongType()))]

    def make():
        def one(text_):
            words = text_.lower().split()
            at = np.fromiter(map(head.get, words, repeat(-1)), np.int64, len(words))
            sums = values[at].sum(0) + end
            rest = Counter([words[i] for i in np.flatnonzero(at < 0).tolist()])
            return (len(words) + 1, int(sums[3]), sums[0], sums[1], sums[2], [w.decode() for w in rest],
                    list(rest.values()))

        return lambda texts: dict(zip([f for f, _ in fields], zip(*map(one, texts))))

    table = with_row_ids(map_texts(source, "text", ["k"], fields, make, rows=128), "doc", "documents")
    rest = table.select("doc", F.explode(F.arrays_zip("rest", "rest_n")).alias("x")).select(
        "doc", F.col("x.rest").alias("word"), F.col("x.rest_n").alias("m"))
    others = scored.where(~frequent).select("word", *[F.col(c).alias(f"w_{c}") for c in ("n", "base", "score", "spelt")])
    added = (rest.join(others, "word").groupBy("doc").agg(
        F.sum(F.when(F.col("w_n") > 0, F.col("m")).otherwise(0)).alias("a_known"),
        *[F.sum(F.col("m") * F.col(f"w_{c}")).alias(f"a_{c}") for c in ("base", "score", "spelt")]))

    def whole(column):
        return F.col(column) + F.coalesce(F.col(f"a_{column}"), F.lit(0))

    return table.drop("rest", "rest_n").join(added, "doc", "left").select(
        F.col("k").alias(key),
        (F.col("k").isNull() | (fold(F.col("k"), FOLDS) == HELD_OUT)).alias("held_out"), "n_tokens",
        whole("known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        whole("base").alias("base_score"), whole("score").alias("score"), whole("spelt").alias("lattice_score"))
