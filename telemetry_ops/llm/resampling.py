"""Importance resampling towards a target: documents drawn by how much more often the target uses their word features.

Words are runs of digits, letters a-z and characters from U+0080 on, A-Z lower-cased. Features are all runs of one to
``most_words`` consecutive words joined by one space, repeats counted; a feature's bucket is the CRC-32 of its UTF-8
bytes modulo ``buckets``. A bucket's gain is the rounded-down thousandfold log-ratio of its smoothed shares in target and
documents; a document's weight is the floored mean gain of its features (0 without any). The draw adds Gumbel noise from
a hash of the id to the weight and takes the highest scores among documents of at least ``min_words`` words.

The checksums are taken without a loop over bytes. CRC-32 is affine: a span's checksum is the XOR of one table entry per
byte, chosen by the byte and its distance from the span's end, and of a constant for the length. ``SpanCrc`` gathers the
entries of many spans at once and folds them by ``bitwise_xor.reduceat``; spans beyond the table are cut into blocks,
whose values are carried on block by block.

Spark adds up bucket counts per task, then over tasks; only the table of ``buckets`` numbers passes the driver. Ranks come
from a range layout by score and id (``scan.positions``), so no task sorts all documents.

A null text has no words: no features, weight 0, never drawn. A null id counts as the empty text in the noise and comes
first among ties. Repeated rows are documents of their own; equal ones tie. A very long text is gathered in parts of
bounded size. Without documents or target texts all counts are 0; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from telemetry_ops.llm.common import map_texts, slices, written
from telemetry_ops.operators.scan import positions

BUCKETS = 10_000
MOST_WORDS = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
BLOCK = 64  # bytes a table row reaches from the end of a span
GATHERED = 1 << 20  # table entries gathered at once
ALL = 0xFFFFFFFF

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = ((_LOWER >= 0x30) & (_LOWER <= 0x39)) | ((_LOWER >= 0x61) & (_LOWER <= 0x7A)) | (_LOWER >= 0x80)


class SpanCrc:
    """CRC-32 of many spans of one byte buffer."""

    def __init__(self, block: int = BLOCK):
        step = np.array([zlib.crc32(bytes([b]), ALL) ^ ALL for b in range(256)], np.uint32)  # one byte from state 0
        on = lambda state: step[state & 0xFF] ^ (state >> 8)  # noqa: E731  # the state after one zero byte
        rows = [step]
        for _ in range(block - 1):
            rows.append(on(rows[-1]))
        self.block, self.entries = block, np.concatenate(rows)
        self.start = np.array([zlib.crc32(bytes(n)) ^ ALL for n in range(block + 1)], np.uint32)
        state = np.stack([np.arange(256, dtype=np.uint32) << (8 * k) for k in range(4)])
        for _ in range(block):
            state = on(state)
        self.carry = state  # by place and value of a state's byte: that byte's part after a whole block of zeros

    def _xor(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """XOR of the table entries of spans of 1 to ``block`` bytes."""
        out, upto = np.empty(len(starts), np.uint32), np.cumsum(lengths)
        first = 0
        while first < len(starts):
            base = upto[first] - lengths[first]
            last = max(first + 1, int(np.searchsorted(upto, base + GATHERED, "right")))
            length, begin = lengths[first:last], upto[first:last] - lengths[first:last] - base
            place = np.arange(int(upto[last - 1] - base))
            byte = buffer[np.repeat(starts[first:last] - begin, length) + place]
            distance = np.repeat(begin + length - 1, length) - place
            out[first:last] = np.bitwise_xor.reduceat(self.entries[distance * 256 + byte], begin)
            first = last
        return out

    def __call__(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint32)
        head = (lengths - 1) % self.block + 1  # the first block takes what whole blocks leave
        state = self._xor(buffer, starts, head) ^ self.start[head]
        rest = (lengths - head) // self.block
        long = np.flatnonzero(rest)
        if len(long):
            # the further blocks of all long spans in one go, then carried on in order
            counts = rest[long]
            begin = np.cumsum(counts) - counts
            nth = np.arange(int(counts.sum())) - np.repeat(begin, counts)
            blocks = self._xor(buffer, np.repeat((starts + head)[long], counts) + nth * self.block,
                               np.full(len(nth), self.block))
            at = 0
            while len(long):
                old = state[long]
                moved = np.bitwise_xor.reduce([self.carry[k][(old >> (8 * k)) & 0xFF] for k in range(4)])
                state[long] = moved ^ blocks[begin + at]
                at += 1
                more = counts > at
                long, counts, begin = long[more], counts[more], begin[more]
        return state ^ np.uint32(ALL)


class Features:
    """Word counts, feature counts and feature buckets of a slice of texts."""

    def __init__(self, buckets: int = BUCKETS, most_words: int = MOST_WORDS):
        self.buckets, self.most_words, self.crc = buckets, most_words, SpanCrc()

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, the bucket of every feature, and the text that holds it."""
        buffer = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        word = _IN_WORD[buffer]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        sizes = np.array([len(t) + 1 for t in texts])
        text_of = np.searchsorted(np.cumsum(sizes), starts, "right")
        # words with one space after each
        spaced = np.concatenate([buffer, [0x20]]).astype(np.uint8)
        spaced[ends] = 0x20
        keep = np.concatenate([word, [False]])
        keep[ends] = True
        spaced = spaced[keep]
        length = ends - starts
        place = np.cumsum(length + 1) - (length + 1)
        begin, size, owner = [], [], []
        for n in range(1, self.most_words + 1):
            first = np.arange(max(0, len(starts) - n + 1))
            first = first[text_of[first] == text_of[first + n - 1]]
            begin.append(place[first])
            size.append(place[first + n - 1] + length[first + n - 1] - place[first])
            owner.append(text_of[first])
        found = self.crc(spaced, np.concatenate(begin), np.concatenate(size)) % np.uint32(self.buckets)
        return np.bincount(text_of, minlength=len(texts)), found.astype(np.int64), np.concatenate(owner)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, most_words: int = MOST_WORDS) -> DataFrame:
    """``bucket`` and ``n``: features of all texts by bucket, added up in each task first."""
    source = docs.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))

    def run(batches):
        features, total = Features(buckets, most_words), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0, 512, 1 << 20):
                total += np.bincount(features(part.column(0).to_pylist())[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["bucket", "n"])

    return source.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS,
          most_words: int = MOST_WORDS) -> np.ndarray:
    """The gain of every bucket. At most ``buckets`` counts a table come to the driver."""
    def counts(df):
        got = [0] * buckets
        for bucket, n in bucket_counts(df, text, buckets, most_words).collect():
            got[bucket] = n
        return got, sum(got)

    (source, total), (wanted, of_target) = counts(docs), counts(target)
    return np.array([math.floor(1000 * math.log((t + 1) * (total + buckets) / ((s + 1) * (of_target + buckets))))
                     for s, t in zip(source, wanted)], np.int64)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise times 1000, rounded down, from the first 32 bits of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS,
             most_words: int = MOST_WORDS) -> DataFrame:
    """Every document's ``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn)."""
    table = gains(docs, target, text, buckets, most_words)

    def make():
        features = Features(buckets, most_words)

        def work(texts):
            words, found, owner = features(texts)
            number = np.bincount(owner, minlength=len(texts))
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, owner, table[found])
            return {"n_words": words, "n_features": number, "weight": total // np.maximum(number, 1)}
        return work

    fields = [(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    scored = map_texts(docs.select(F.col(key).alias("row"), F.col(text).alias("text")), "text", ["row"], fields, make,
                       size=1 << 20)
    scored = written(scored.withColumn("score", F.col("weight") + noise(F.col("row"), seed)), "scores")
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * percent // 100
    placed = positions(scored.where(fit), [F.desc("score"), F.asc("row"), "n_features", "weight"], "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    out = placed.withColumn("rank", rank).drop("place").unionByName(
        scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("row").alias(key), "n_words", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; ids must tell documents apart."""
    chosen = resample(docs, target, text, key, **options).where(F.col("rank").isNotNull()).select(key)
    return docs.join(chosen.distinct(), key, "left_semi").select(docs.columns)
