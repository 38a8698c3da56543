"""Reversible line dedup: exact counts of documents by line, and sharded cuckoo filters of the lines to drop.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; it is known by 128 bits of its SHA-256. A
``Store`` holds three written tables:

* ``counts``: for every key, how many documents hold it, exactly;
* ``filters``: one cuckoo filter per shard (by hash of the key) over the keys held by ``min_docs`` documents or more. Cuckoo
  filters allow deletion, so a key that falls below the limit is taken out again;
* ``wrong``: the counted keys below the limit that a filter mistakes for members. Filters corrected by this table answer
  exactly, for every counted key.

``insert`` and ``delete`` add the key counts of a batch of documents with a sign, and hand the keys that cross the limit to
their shards' filters; so deleting documents gives back what the store was without them. ``apply`` drops lines of
documents that are in the store, and leaves the store as it is.

Scale: a task counts its keys before the shuffle, so a line in a third of all documents is one row per slice. Shards
hold at most ``PER_SHARD`` keys each, so filters are built and changed in groups of bounded size. Where filters and
wrong keys are small (counted: ``FILTER_BYTES``, ``MOST_WRONG``), they are sent to all tasks and texts pass once,
unshuffled. Beyond that, lines are joined with the counts: very frequent keys through a counted broadcast, others by
shuffle, and the dropped places go to the texts.

A row is a document, so repeated rows count each, and null ids need no care. A null or empty text is one empty line; empty lines have no
key and stay. Texts of any length pass whole. An empty table changes nothing and gives no rows. Other columns are not read. Deleting
what was never inserted is an error.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from telemetry_ops.llm.common import by_size, map_texts, slices, with_row_ids, written

MIN_DOCS = 10
MIN_CHARS = 1
PER_SHARD = 1 << 16  # keys of a filter, at most, before the shards are made more
FILTER_BYTES = 64 << 20
MOST_WRONG = 100_000
HEAVY_SHARE = 1000  # a key in more than one of so many documents is joined by broadcast, if the list is small
SLOTS = 4
LOAD = 0.85
KICKS = 500
SPACE = b" \t\n\v\f\r"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits that stand for the line's key; None for keys of too few code points."""
    key = line_key(line)
    if len(key) < min_chars or len(key.decode()) < min_chars:
        return None
    return hashlib.sha256(key).digest()[:16]


def _words(keys: list[bytes]) -> np.ndarray:
    """The four 32-bit words of each key: shard, fingerprint, first bucket, unused."""
    return np.frombuffer(b"".join(keys), ">u4").reshape(-1, 4).astype(np.uint32)


def shard_of(key):
    """Column of the shard hash; the same as the first word of ``_words``."""
    return F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long")


def _fingerprints(words: np.ndarray) -> np.ndarray:
    return np.maximum(words[:, 1], 1)  # 0 is an empty slot


def _other(bucket, fingerprint):
    """The second bucket, from either bucket (before the mask)."""
    return bucket ^ (fingerprint * np.uint32(0x5BD1E995))


class CuckooFilter:
    """Fingerprints of 32 bits in buckets of four slots; each key has two buckets, found from one another."""

    def __init__(self, keys: int = 0, cells: bytes | None = None):
        if cells is None:
            buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
            self.cells = np.zeros((buckets, SLOTS), np.uint32)
        else:
            self.cells = np.frombuffer(cells, np.uint32).reshape(-1, SLOTS).copy()
        self.mask = len(self.cells) - 1

    def _place(self, words: np.ndarray):
        prints = _fingerprints(words)
        with np.errstate(over="ignore"):
            second = _other(words[:, 2], prints)
        return prints.tolist(), (words[:, 2] & self.mask).tolist(), (second & self.mask).tolist()

    def insert(self, keys: list[bytes]) -> bool:
        """False if a key finds no place; the filter must then be built anew, larger."""
        if not keys:
            return True
        cells, turn = self.cells, 0
        for kept, a, b in zip(*self._place(_words(keys))):
            for bucket in (a, b):
                free = np.flatnonzero(cells[bucket] == 0)
                if len(free):
                    cells[bucket, free[0]] = kept
                    break
            else:
                for _ in range(KICKS):
                    turn = (turn + 1) % SLOTS
                    kept, cells[bucket, turn] = int(cells[bucket, turn]), kept
                    bucket = (bucket ^ (kept * 0x5BD1E995 & 0xFFFFFFFF)) & self.mask
                    free = np.flatnonzero(cells[bucket] == 0)
                    if len(free):
                        cells[bucket, free[0]] = kept
                        break
                else:
                    return False
        return True

    def delete(self, keys: list[bytes]) -> None:
        if keys:
            for kept, a, b in zip(*self._place(_words(keys))):
                for bucket in (a, b):
                    at = np.flatnonzero(self.cells[bucket] == kept)
                    if len(at):
                        self.cells[bucket, at[0]] = 0
                        break

    def holds(self, keys: list[bytes]) -> np.ndarray:
        return Members({0: self.cells}, 1, frozenset()).hits(keys)


class Members:
    """All filters side by side, corrected by the wrong keys."""

    def __init__(self, filters: dict[int, np.ndarray], shards: int, wrong: frozenset):
        sizes = [len(filters[s]) if s in filters else 1 for s in range(shards)]
        self.start = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.mask = np.array(sizes, np.uint32) - np.uint32(1)
        empty = np.zeros((1, SLOTS), np.uint32)
        self.cells = np.concatenate([filters.get(s, empty) for s in range(shards)])
        self.wrong = wrong

    def hits(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, bool)
        words = _words(keys)
        shard = words[:, 0] % np.uint32(len(self.mask))
        prints, mask, start = _fingerprints(words), self.mask[shard], self.start[shard]
        with np.errstate(over="ignore"):
            second = _other(words[:, 2], prints)
        found = (self.cells[start + (words[:, 2] & mask)] == prints[:, None]).any(1)
        found |= (self.cells[start + (second & mask)] == prints[:, None]).any(1)
        if self.wrong:
            for i in np.flatnonzero(found):
                found[i] = keys[i] not in self.wrong
        return found


@dataclass(frozen=True)
class Store:
    counts: DataFrame  # key, docs
    filters: DataFrame  # shard, cells
    wrong: DataFrame  # key
    shards: int
    min_docs: int
    min_chars: int


_COUNTS, _FILTERS = "key binary, docs long", "shard long, cells binary"


def empty_store(spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> Store:
    return Store(spark.createDataFrame([], _COUNTS), spark.createDataFrame([], _FILTERS),
                 spark.createDataFrame([], "key binary"), 1, min_docs, min_chars)


def key_counts(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``key`` and ``docs``: documents by key they hold, counted within each slice of texts (keys may repeat)."""
    source = docs.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 0, 4096, 8 << 20):
                found = Counter()
                for value in part.column(0).to_pylist():
                    found.update({key_of(line, min_chars) for line in value.split(b"\n")})
                found.pop(None, None)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(found.values(), pa.int64())],
                                                 names=["key", "docs"])

    return source.mapInArrow(run, _COUNTS)


def _members(store: Store) -> Members:
    filters = {s: np.frombuffer(bytes(c), np.uint32).reshape(-1, SLOTS) for s, c in store.filters.collect()}
    return Members(filters, store.shards, frozenset(bytes(r[0]) for r in store.wrong.collect()))


def _filter_bytes(store: Store) -> int:
    return store.filters.agg(F.coalesce(F.sum(F.length("cells")), F.lit(0))).first()[0]


def _rebuilt(store: Store, members: int) -> Store:
    """All filters anew from the counts, in as many shards as ``members`` keys need."""
    shards = 1 << max(0, int(np.ceil(np.log2(max(1, members) / PER_SHARD * 2))))

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        held = [bytes(k) for k in keys["key"]]
        made = CuckooFilter(len(held))
        while not made.insert(held):
            made = CuckooFilter(len(made.cells) * SLOTS)
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "cells": [made.cells.tobytes()]})

    drop = store.counts.where(F.col("docs") >= store.min_docs).select(
        F.pmod(shard_of(F.col("key")), F.lit(shards)).alias("shard"), "key")
    filters = written(drop.groupBy("shard").applyInPandas(build, _FILTERS), "filters")
    return replace(store, filters=filters, shards=shards)


def _changed(store: Store, crossed: DataFrame) -> Store | None:
    """Keys that crossed the limit put in or taken out; None where a filter is full."""
    def change(keys: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        if not len(keys):
            return old[["shard", "cells"]]
        added = [bytes(k) for k in keys["key"][keys["member"]]]
        made = CuckooFilter(cells=bytes(old["cells"].iloc[0])) if len(old) else CuckooFilter(2 * len(added))
        made.delete([bytes(k) for k in keys["key"][~keys["member"]]])
        fits = made.insert(added)
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "cells": [made.cells.tobytes() if fits else None]})

    keys = crossed.select(F.pmod(shard_of(F.col("key")), F.lit(store.shards)).alias("shard"), "key", "member")
    filters = written(keys.groupBy("shard").cogroup(store.filters.groupBy("shard")).applyInPandas(change, _FILTERS),
                      "filters")
    if not filters.where(F.col("cells").isNull()).isEmpty():
        return None
    return replace(store, filters=filters)


def _corrected(store: Store) -> Store:
    """The wrong keys, found by trying every counted key below the limit; beyond the bounds ``apply`` needs none."""
    empty = store.counts.select("key").limit(0)
    if _filter_bytes(store) > FILTER_BYTES:
        return replace(store, wrong=empty)
    spark = store.counts.sparkSession
    sent = spark.sparkContext.broadcast(_members(replace(store, wrong=empty)))

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            yield pa.RecordBatch.from_arrays([keys.filter(pa.array(sent.value.hits(keys.to_pylist())))], names=["key"])

    below = store.counts.where(F.col("docs") < store.min_docs).select("key")
    return replace(store, wrong=written(below.mapInArrow(run, "key binary"), "wrong"))


def _update(store: Store, docs: DataFrame, text: str, sign: int) -> Store:
    delta = key_counts(docs, text, store.min_chars).select("key", F.lit(0).cast("long").alias("was"),
                                                           (F.col("docs") * sign).alias("docs"))
    before = store.counts.select("key", F.col("docs").alias("was"), "docs")
    merged = written(before.unionByName(delta).groupBy("key").agg(F.sum("was").alias("was"), F.sum("docs").alias("docs")),
                     "counts")
    is_member, was_member = F.col("docs") >= store.min_docs, F.col("was") >= store.min_docs
    least, members, crossed = merged.agg(
        F.min("docs"), F.count_if(is_member), F.count_if(is_member != was_member)).first()
    if (least or 0) < 0:
        raise ValueError("documents to delete were not in the store")
    store = replace(store, counts=merged.where(F.col("docs") > 0).select("key", "docs"))
    changed = store if not crossed else None
    if crossed and members <= store.shards * PER_SHARD:
        changed = _changed(store, merged.where(is_member != was_member).select("key", is_member.alias("member")))
    return _corrected(changed or _rebuilt(store, members))


def insert(store: Store, docs: DataFrame, text: str = "text") -> Store:
    return _update(store, docs, text, 1)


def delete(store: Store, docs: DataFrame, text: str = "text") -> Store:
    """The store without documents inserted before (each row takes one document of that text out)."""
    return _update(store, docs, text, -1)


def _without(value: bytes, gone) -> tuple[int, bytes]:
    """Lines dropped and the text left, from one flag per line."""
    if not any(gone):
        return 0, value
    lines = value.split(b"\n")
    return sum(gone), b"\n".join([x for x, drop in zip(lines, gone) if not drop])


_KEPT = [("n_lines", T.LongType()), ("n_dropped", T.LongType()), ("kept", T.StringType())]


def apply(store: Store, docs: DataFrame, text: str = "text", keys: list[str] | None = None,
          filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``keys`` of every document with ``n_lines``, ``n_dropped`` and ``kept``, the text without dropped lines."""
    keys = keys or ["doc_id"]
    rows = docs.select(F.struct(*keys).alias("row"), F.col(text).alias("text"))
    if _filter_bytes(store) <= filter_bytes and store.wrong.count() <= MOST_WRONG:
        out = _applied_by_filters(store, rows)
    else:
        out = _applied_by_join(store, rows)
    return out.select(*[F.col("row").getField(k).alias(k) for k in keys], *[n for n, _ in _KEPT])


def _applied_by_filters(store: Store, rows: DataFrame) -> DataFrame:
    sent, least = rows.sparkSession.sparkContext.broadcast(_members(store)), store.min_chars

    def work(texts):
        lines = [[key_of(line, least) for line in t.split(b"\n")] for t in texts]
        flat = [k for found in lines for k in found if k]
        hit = dict(zip(flat, sent.value.hits(flat).tolist()))
        kept = [_without(t, [hit.get(k, False) for k in found]) for t, found in zip(texts, lines)]
        return {"n_lines": [len(found) for found in lines], "n_dropped": [n for n, _ in kept],
                "kept": [t.decode() for _, t in kept]}

    return map_texts(rows, "text", ["row"], _KEPT, lambda: work)


def _applied_by_join(store: Store, rows: DataFrame) -> DataFrame:
    least = store.min_chars
    table = with_row_ids(rows, "id", "texts")
    fields = [("places", T.ArrayType(T.LongType())), ("keys", T.ArrayType(T.BinaryType()))]

    def work(texts):
        found = [{i: k for i, k in enumerate(key_of(x, least) for x in t.split(b"\n")) if k} for t in texts]
        return {"places": [list(f) for f in found], "keys": [list(f.values()) for f in found]}

    lines = map_texts(table, "text", ["id"], fields, lambda: work).select(
        "id", F.explode(F.arrays_zip("places", "keys")).alias("x")).select(
        "id", F.col("x.places").alias("place"), F.col("x.keys").alias("key"))
    drop = store.counts.where(F.col("docs") >= store.min_docs)
    often = F.col("docs") > F.lit(max(1, table.count() // HEAVY_SHARE))
    heavy, light = by_size(drop.where(often).select("key")), drop.where(~often).select("key")
    gone = lines.join(heavy, "key", "left_semi").unionByName(lines.join(light, "key", "left_semi"))
    gone = gone.groupBy("id").agg(F.collect_list("place").alias("gone"))
    joined = table.join(gone, "id", "left").select(
        "row", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"),
        F.coalesce("gone", F.array().cast("array<long>")).alias("gone"))
    left = F.filter("lines", lambda _, i: ~F.array_contains("gone", i.cast("long")))
    return joined.select("row", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
                         F.array_join(left, "\n").alias("kept"))


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", min_docs: int = MIN_DOCS,
               min_chars: int = MIN_CHARS) -> DataFrame:
    """Every document of a table without the lines that many of them hold: ``key``, ``n_lines``, ``n_dropped``, ``kept``."""
    store = insert(empty_store(docs.sparkSession, min_docs, min_chars), docs, text)
    return apply(store, docs, text, [key])


SQL = f"""
with lines as (
    select doc_id, i, a[i] as line,
        translate(trim(a[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
    from (select doc_id, a, unnest(range(1, len(a) + 1)) as i
          from (select doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents))),
often as (select k from lines where length(k) >= {MIN_CHARS} group by k having count(distinct doc_id) >= {MIN_DOCS})
select doc_id, count(*) as n_lines, count(*) filter (k in (from often)) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (k not in (from often)), '')) as kept_sha256
from lines group by doc_id"""
