"""Packing documents into sequences of a fixed number of tokens, by a configuration linear program.

A configuration is a multiset of lengths that fits one sequence. The program covers the histogram of piece lengths
with as few configurations as possible. Multiplicative weights solve it: each round prices every length by how little
of it is covered, a knapsack dynamic program gives the highest price of a configuration, and configurations within a
tolerance of that price, read off the program's table, cover a small share more of their lengths. The tolerance starts
tight and widens when a round finds little. Whole parts of every configuration are used, waste included; what rounding
leaves is solved again, and once little has a whole part, configurations are used once each, dearest first. Only the
last tokens, a share of ``LAST``, go by best fit, longest first, into what the program left free or new sequences.

Only the histogram (at most one count for each length up to the capacity) reaches the driver, and the plan that goes
back is bounded by the capacity and the rounds, not by the documents. Ranks within a length come from counts by task,
so a length that a third of all pieces share is dealt out without meeting in one task.

A document is its token ids and an end id; a null text is empty, so it has one token. Longer documents are cut into
pieces of exactly the capacity, the first piece being the shorter rest. Repeated rows are packed again each; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from telemetry_ops.llm.byte_bpe import CACHED_UNITS, TOKENIZER, UnitCutter, bounded, byte_letters, literal
from telemetry_ops.llm.common import arrow_type, slices, written

CAPACITY = 1024
END_ID = 2
STEP = 0.1  # share of a length that one round may cover
NEAR = 0.001  # tolerance of the first round: share of the highest price that a configuration may fall short of
RATE = 1.0  # of the prices' fall with cover
UNDONE = 0.02  # share of the program's sequences, the cheapest, that best fit packs again
SHARE = 0.6  # of a solution that is rounded before the rest is solved again
FILL = 0.1  # weight of plain lengths in the first prices, so that full configurations win among equals
LAST = 0.03  # share of the tokens that best fit packs


# -- tokenising ---------------------------------------------------------------------------------------------------


class LibraryEncoder:
    """Ids as the tokenizers library gives them, remembered by unit.

    If the vocabulary numbers its tokens in the order of its merges, unknown units go through tiktoken, which then
    gives the same ids several times faster; else through the library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        vocabulary = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.cutter = UnitCutter(special)
        self.cache: dict[str, bytes] = {}
        self.size = np.zeros(max([*vocabulary.values(), *special.values()]) + 1, np.int64)  # bytes of each token
        for token, i in [*vocabulary.items(), *special.items()]:
            self.size[i] = len(token.encode()) if token in special else len(token)
        self.special = special
        if [vocabulary[a + b] for a, b in merges] == list(range(256, 256 + len(merges))):
            ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocabulary.items()}
            import tiktoken

            self.ids = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self.ids = lambda text: library.encode(text, add_special_tokens=False).ids

    def _remember(self, keys: list[str]) -> None:
        """Units that start with a space are encoded as one text, cut again by the tokens' bytes; others alone."""
        joint = [key for key in keys if not key.startswith(" ")]
        for i in range(0, len(joint), 4096):
            group = joint[i:i + 4096]
            ids = np.array(self.ids(" " + " ".join(group)), "<u4")
            ends = np.cumsum([len(key.encode()) + 1 for key in group])
            cuts = [0, *(4 * np.searchsorted(np.cumsum(self.size[ids]), ends) + 4).tolist()]
            joined = ids.tobytes()
            self.cache.update(zip(group, map(joined.__getitem__, map(slice, cuts, cuts[1:]))))
        for key in keys:
            if key.startswith(" "):
                unit = literal(key)
                self.cache[key] = np.array([self.special[unit]] if unit in self.special else self.ids(unit),
                                           "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        plans = [self.cutter.units(t) for t in texts]
        cache = bounded(self.cache, CACHED_UNITS)
        self._remember(list(set().union(*plans).difference(cache)))
        return [b"".join(map(cache.__getitem__, plan)) for plan in plans]


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def token_pieces(docs: DataFrame, text: str, key: str, capacity: int, tokenizer: str, end_id: int) -> DataFrame:
    """One row per piece, with the task that made it and its number among that task's pieces of the same length."""
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
              ("ids_crc32", T.LongType()), ("task", T.IntegerType()), ("nth", T.LongType())]
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType)]
                          + [T.StructField(n, kind) for n, kind in fields])
    source = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encoder, seen, task = _encoder(tokenizer), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, 1, 512, 4 << 20):
                rows = []
                owner = []
                for i, ids in enumerate(encoder.encode([t.decode() for t in part.column(1).to_pylist()])):
                    ids += end
                    for piece, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                        rows.append((piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), task,
                                     seen[length]))
                        seen[length] += 1
                        owner.append(i)
                columns = [pa.array(c, arrow_type(kind)) for c, (_, kind) in zip(zip(*rows), fields)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *columns], names=schema.names)

    return source.mapInArrow(run, schema)


# -- the plan -----------------------------------------------------------------------------------------------------


def best_fit(counts: dict[int, int], capacity: int, begun=()) -> list[tuple[dict[int, int], int]]:
    """Best fit of the longest first, for whole runs of equal sequences: (configuration, number of sequences).

    Sequences already ``begun`` are filled further.
    """
    groups = [[capacity - sum(x * k for x, k in c.items()), c, n] for c, n in begun]  # [free, configuration, number]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = [g for g in groups if g[0] >= length and g[2]]
            if fits:
                group = min(fits, key=lambda g: g[0])
                number = min(left, group[2])
                group[2] -= number
                config, free, each = dict(group[1]), group[0], 1
            else:
                each = min(capacity // length, left)
                number, config, free = left // each, {}, capacity
            config[length] = config.get(length, 0) + each
            groups.append([free - each * length, config, number])
            left -= number * each
            groups = [g for g in groups if g[2]]
    return [(config, number) for _, config, number in groups]


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Highest price of lengths (each used any number of times) within every capacity."""
    best = np.zeros(capacity + 1)
    for c in range(1, capacity + 1):
        n = np.searchsorted(lengths, c, side="right")
        best[c] = max(best[c - 1], (prices[:n] + best[c - lengths[:n]]).max() if n else 0.0)
    return best


def first_prices(lengths: np.ndarray, n: np.ndarray, capacity: int) -> np.ndarray:
    """Prices no configuration of which exceeds 1, with the highest worth of the histogram: for some t, lengths that
    leave less than t count as whole sequences, lengths under t as nothing, others by their share of the capacity."""
    share = lengths / capacity
    choices = [share, *(np.where(lengths > capacity - t, 1.0, np.where(lengths >= t, share, 0.0))
                        for t in range(1, capacity // 2 + 1))]
    return max(choices, key=lambda prices: float(n @ prices))


def fractional(counts: dict[int, int], capacity: int) -> tuple[dict, dict[int, float], float]:
    """Multiplicative weights for the configuration program: amounts by configuration (sorted (length, number) pairs),
    which together cover ``counts`` exactly, the first prices, and a number of sequences that no packing can go below.

    Prices fall exponentially with cover, so the scarcest lengths are bought first. A configuration starts with the
    longest piece that is left and adds lengths whose loss against the best price of the room stays in the tolerance,
    long ones first (short ones are easily placed later); every configuration uses up the round's share of a length, so a round has at most as many
    as there are lengths.
    """
    lengths = np.array(sorted(counts))
    n = np.array([counts[x] for x in lengths.tolist()], float)
    base = first_prices(lengths, n, capacity)
    bound, base = float(n @ base), (1 - FILL) * base + FILL * lengths / capacity
    covered, near, amount = np.zeros(len(lengths)), NEAR, {}
    while (open_ := np.flatnonzero(covered < 1 - 1e-9)).size:
        live, held, cover = lengths[open_], n[open_], covered[open_]
        prices = base[open_] * np.exp(-RATE * (cover - cover.min()))
        best = knapsack(live, prices, capacity)
        highest = best[capacity]
        bound = max(bound, float(held @ prices) / highest)
        supply = np.minimum(STEP, 1 - cover) * held
        left, least = supply.copy(), 1e-9 * supply
        for i in range(len(live) - 1, -1, -1):
            while left[i] > least[i]:
                used, room = np.zeros(len(live)), capacity - int(live[i])
                used[i] = 1
                slack = near * highest - (highest - prices[i] - best[room]) + 1e-12
                while slack >= 0 and room >= live[0]:
                    m = int(np.searchsorted(live, room, side="right"))
                    loss = best[room] - prices[:m] - best[room - live[:m]]
                    fits = np.flatnonzero((loss <= slack) & (left[:m] > least[:m]) & (used[:m] < held[:m]))
                    if not fits.size:
                        break
                    j = int(fits[np.argmin(loss[fits] / (near * highest) - live[fits] / room)])
                    used[j] += 1
                    slack -= loss[j]
                    room -= int(live[j])
                if slack < best[room]:
                    break
                at = np.flatnonzero(used)
                size = float((left[at] / used[at]).min())
                left[at] -= size * used[at]
                config = tuple(zip(live[at].tolist(), used[at].astype(int).tolist()))
                amount[config] = amount.get(config, 0.0) + size
        covered[open_] += (supply - left) / held
        if (supply - left) @ live < 0.25 * (supply @ live):
            near *= 2
    return amount, dict(zip(lengths.tolist(), base.tolist())), bound


def rounded(amount: dict, prices: dict[int, float], counts: dict[int, int]) -> list[tuple[dict[int, int], int]]:
    """Whole multiples of a fractional solution; takes what they hold out of ``counts``.

    The first ``SHARE`` of the solution is used, in the order found. If whole parts are under a fifth of it,
    configurations are used once, the dearest by ``prices`` first, then by amount. At least one is used.
    """
    out = []

    def use(config, number):
        number = min(number, *(counts[x] // k for x, k in config))
        if number > 0:
            out.append((dict(config), number))
            for x, k in config:
                counts[x] -= number * k
        return number

    total = sum(amount.values())
    wanted = SHARE * total
    for config in amount:  # in the order found, so under the tightest tolerance first
        if wanted > 0:
            wanted -= use(config, int(amount[config] + 1e-9))
    if wanted > (SHARE - 0.2) * total:
        for config in sorted(amount, key=lambda c: (-sum(prices[x] * k for x, k in c), -amount[c], c)):
            if wanted > 0:
                wanted -= use(config, 1)
    return out


def plan_parts(counts: dict[int, int], capacity: int) -> tuple[list[tuple[dict[int, int], int]], int, float]:
    """Configurations with their numbers of sequences, how many sequences the program began (best fit fills those
    further before it begins others), and the program's lower bound on all sequences."""
    left = {x: n for x, n in counts.items() if n}
    program, bound = [], 0.0
    prices = None
    least = LAST * sum(x * n for x, n in left.items())
    while sum(x * n for x, n in left.items()) > least:
        amount, phase, lower = fractional(left, capacity)
        prices = prices or phase
        bound = bound or lower  # of the first solution, which holds all lengths
        program += rounded(amount, phase, left)
        left = {x: n for x, n in left.items() if n}
    worth = prices
    undo = int(UNDONE * sum(n for _, n in program))
    kept = []
    for config, number in sorted(program, key=lambda p: sum(worth[x] * k for x, k in p[0].items())):
        again = min(number, undo)
        undo -= again
        for x, k in config.items():
            if again:
                left[x] = left.get(x, 0) + k * again
        if number > again:
            kept.append((config, number - again))
    return best_fit(left, capacity, kept), sum(n for _, n in kept), bound


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Configurations and how many sequences follow each; together they hold exactly ``counts``."""
    return plan_parts(counts, capacity)[0]


def slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, first sequence, pieces per sequence, place in the sequence), ordered by rank."""
    rows: dict[int, list] = {}
    filled: Counter = Counter()
    first = 0
    for config, number in plan:
        place = 0
        for length, each in sorted(config.items(), reverse=True):
            rows.setdefault(length, []).append((filled[length], first, each, place))
            filled[length] += number * each
            place += length * each
        first += number
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
         tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``key``, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(token_pieces(docs, text, key, capacity, tokenizer, end_id), "pieces")
    full = pieces.where(F.col("length") == capacity).select(
        key, "piece", "start", "length", "ids_crc32",
        (F.lit(-1) - F.shiftleft(F.col("task").cast("long"), 40) - F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col("length") < capacity)
    sizes = short.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length = slots(plan_sequences(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("task").alias("_task"), F.col("length").alias("_length"),
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    ranked = short.join(before, (F.col("task") == F.col("_task")) & (F.col("length") == F.col("_length"))).select(
        key, "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("nth")).alias("rank"))

    names = full.columns

    def place(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(i)) for i in (3, 5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                rows = by_length[x]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                inside = rank[at] - row[:, 0]
                sequence[at] = row[:, 1] + inside // row[:, 2]
                offset[at] = row[:, 3] + inside % row[:, 2] * x
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(sequence),
                                              pa.array(offset)], names=names)

    return full.unionByName(ranked.mapInArrow(place, full.schema))
