"""Near duplicates by SimHash, found through deletion variants of fewer segments.

The 64 fingerprint bits are cut into three segments. Two fingerprints that differ in at most four bits differ in at
most one bit of one segment, so they agree on a segment with one bit left out. Every fingerprint is indexed under all
64 one-wildcard segments; those that share a key are candidates and are verified on all bits.

Equal fingerprints are one node. In buckets of at most ``SMALL_BUCKET`` members all pairs are compared. In larger ones no
pairs are written out: their members are first compared with one pivot; what is linked so far, in all buckets, becomes
classes, and then only members outside the largest class of their bucket are compared with the members of other classes. Two
fingerprints of one class are already connected, so no link between components is lost, while a dense group costs about
as many comparisons as it has members.

Texts: A-Z lower-cased, words are runs of characters other than ASCII white space, 4-word shingles with repeats joined
by spaces (fewer words: all of them; none: fingerprint zero). A null text is empty. A null id never names a component
unless all its ids are null. Repeated rows are copies. Other columns are ignored or carried, whatever their names.

``deduplicate`` links texts by the Jaccard similarity of their sets of 5-word shingles, 0.8 or more, since texts that
similar may differ in ten of 64 bits. Candidates are the SimHash classes of the fingerprints of these shingles, each member
with the class's pivot, and, for what bits cannot reach, texts that agree on one of 20 bands of five minima of the set (MinHash).
All are verified on the whole sets; a pair at just 0.8 is missed with a probability of 0.04 %, a closer one with less. Sets
are sent only for pairs that may be similar by the sets' bits (four for each shingle or more), a bound that holds for every pair,
so what is shuffled follows the similar pairs rather than all candidates. Equal sets are one node. In each bucket all are compared with one pivot, then only members of different classes. Texts stay where
they are: tasks are sent the ids of the rows asked for, counted first (``SEND_IDS``), else the join shuffles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from telemetry_ops.llm.common import by_size, map_texts, with_row_ids, written
from telemetry_ops.llm.graph import components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # (lowest bit, width): one differs in at most MAX_BITS // 3 = 1 bit
SMALL_BUCKET = 64  # members of a bucket whose pairs are all compared
SET_SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 20, 5
SEND_IDS = 4_000_000  # row ids of 8 bytes that a join may send to every task
_DRAWS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS, 1), np.uint64)


def shingle_hashes(text: bytes, width: int, seed: int = SEED) -> np.ndarray:
    """Hashes of the shingles of one text, with repeats."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())], np.uint64)


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text."""
    return majority(shingle_hashes(text, width, seed))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint as a signed long)."""
    def make():
        return lambda texts: {"fp": [_signed(fingerprint(t)) for t in texts]}

    return map_texts(docs, text, keys, [("fp", T.LongType())], make)


def _index_keys(fp: Column) -> Column:
    """The one-wildcard variants of every segment; a key holds segment and wildcard above the masked bits."""
    keys, n = [], 0
    for low, width in SEGMENTS:
        for bit in range(width):
            masked = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)).cast("long"))
            keys.append(masked.bitwiseOR(F.lit(n << 22).cast("long")))
            n += 1
    return F.array(*keys)


def _bits_apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _first_key(a: str, b: str) -> Column:
    """The lowest-numbered segment in which two fingerprints differ by at most one bit, as a key's number range test.

    Of the buckets two fingerprints share, exactly one passes: the wildcard is the differing bit, or bit 0.
    """
    xor = F.col(a).bitwiseXOR(F.col(b))
    number, n = F.lit(-1), sum(w for _, w in SEGMENTS)
    for low, width in reversed(SEGMENTS):
        n -= width
        part = F.shiftrightunsigned(xor, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        bit = F.when(part == 0, 0).otherwise(F.bit_count(part - 1))  # of a power of two
        number = F.when(F.bit_count(part) <= 1, bit + n).otherwise(number)
    return number


def _links_between(a: DataFrame, b: DataFrame, more: Column) -> DataFrame:
    """Verified links of members (key, a) and (key, b) of the same buckets, each pair in one bucket only.

    Spark takes the 64 keys of a fingerprint for one row, and repeated keys for as small as their file, so a join it sized
    itself would broadcast members that fill the driver: both sides are shuffled.
    """
    return a.hint("merge").join(b.hint("merge"), (a["key"] == b["key"]) & (_bits_apart("a", "b") <= MAX_BITS) & more
                  & (F.shiftright(a["key"], 22) == _first_key("a", "b")))


def linked_classes(fps: DataFrame) -> DataFrame:
    """(fp, label) for distinct fingerprints, read several times: equal labels mean the same component; single ones label
    themselves."""
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = fps.repartition(tasks, "fp").select(F.explode(_index_keys(F.col("fp"))).alias("key"), "fp")
    large = written(index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("pivot"))
                    .where(F.col("n") > SMALL_BUCKET).select("key", "pivot"), "large")
    small = index.join(large, "key", "left_anti")  # one shuffle serves both sides
    links = _links_between(small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b")),
                           F.col("a") < F.col("b")).select("a", "b")
    if large.isEmpty():
        labels = components(links)
    else:
        members = written(index.join(large, "key"), "buckets")
        near = members.where((F.col("fp") != F.col("pivot")) & (_bits_apart("fp", "pivot") <= MAX_BITS))
        labels = components(links.union(near.select("fp", "pivot").distinct()))
        labels = _between_classes(members.select("key", "fp"), labels)
    return fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) after links (a, b) between nodes or labels are added."""
    return labels if links.isEmpty() else components(links.toDF("a", "b").union(labels.select("node", "label")))


def _between_classes(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) once all links inside large buckets (key, fp) are added to the classes ``labels``."""
    named = members.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "key", "fp", F.coalesce("label", "fp").alias("label"))
    main = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    named = written(named.join(main.drop("classes"), "key"), "members")  # in the buckets that still hold several classes
    a = named.where("label != main").select("key", F.col("fp").alias("a"), F.col("label").alias("la"))
    b = named.select("key", F.col("fp").alias("b"), F.col("label").alias("lb"), (F.col("label") == F.col("main"))
                     .alias("inside"))
    more = _links_between(a, b, (F.col("la") != F.col("lb")) & (F.col("inside") | (F.col("a") < F.col("b"))))
    # a link between classes, once; labels are nodes too
    return _merged(labels, written(more.select("la", "lb").distinct(), "between"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (16 hexadecimal digits), ``component_id``."""
    asked = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    table = written(fingerprints(asked, "t", ["k"]), "simhash")
    named = _component_ids(table)
    return table.join(named, "fp").select(F.col("k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0"))
                                          .alias("fingerprint"), F.col("least").alias("component_id"))


def _component_ids(table: DataFrame) -> DataFrame:
    """(fp, label, least) from (k, fp): the least id of each fingerprint's component."""
    least = written(table.groupBy("fp").agg(F.min("k").alias("own")), "fingerprints")
    labels = written(linked_classes(least.select("fp")), "labels")
    named = least.join(labels, "fp")
    ids = named.groupBy("label").agg(F.min("own").alias("least"))
    return named.select("fp", "label").join(ids, "label")


def shingle_set(text: bytes, width: int = SET_SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def bands(values: np.ndarray) -> list[int]:
    """Signed hashes of the bands of minima of a set; none of an empty set."""
    if not len(values):
        return []
    odd, add = _DRAWS[0] | np.uint64(1), _DRAWS[1]
    least = np.full(len(odd), (1 << 64) - 1, np.uint64)
    for i in range(0, len(values), 1 << 12):
        np.minimum(least, (values[None, i:i + (1 << 12)] * odd + add).min(1), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    return [_signed(xxhash.xxh64_intdigest(row.tobytes(), n)) for n, row in enumerate(rows)]


def _sketched(docs: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``keys``, ``fp`` (SimHash of the shingles), ``node`` (hash of the text's shingle set), ``size`` (of the set), ``bands``."""
    def sketch(text):
        hashes = shingle_hashes(text, width)
        values = np.unique(hashes)
        return _signed(majority(hashes)), _signed(xxhash.xxh64_intdigest(values.tobytes(), SEED)), len(values), bands(values)

    def make():
        return lambda texts: dict(zip(("fp", "node", "size", "bands"), zip(*map(sketch, texts))))

    return map_texts(docs, "t", keys, [("fp", T.LongType()), ("node", T.LongType()), ("size", T.LongType()),
                                       ("bands", T.ArrayType(T.LongType()))], make)


def bit_set(values: np.ndarray) -> bytes:
    """A bit for each value at its remainder by a power of two, at least four times the number of values."""
    n = max(64, 1 << (4 * len(values) - 1).bit_length())
    marks = np.zeros(n, bool)
    marks[(values & np.uint64(n - 1)).astype(np.intp)] = True
    return np.packbits(marks).tobytes()


def most_common(a: bytes, size_a: int, b: bytes, size_b: int) -> int:
    """No fewer values than two sets share, from their bits and sizes: a bit in one only is a value in that one only."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] | y[len(y) // 2:]
    only_a, only_b = (int(np.bitwise_count(one & ~other).sum()) for one, other in ((x, y), (y, x)))
    return min(size_a - only_a, size_b - only_b)


def _likely(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that may be as similar as asked by the bits of their sets (node, size, bits)."""
    def run(batches):
        for batch in batches:
            keep = []
            for size_a, bits_a, size_b, bits_b in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                most = most_common(bits_a, size_a, bits_b, size_b)
                keep.append(most >= similarity * (size_a + size_b - most))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    asked = sets.select("node", "size", "bits")
    both = pairs.join(asked.toDF("a", "size_a", "bits_a"), "a").join(asked.toDF("b", "size_b", "bits_b"), "b")
    return both.select("a", "b", "size_a", "bits_a", "size_b", "bits_b").mapInArrow(run, "a long, b long")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _similar(pairs: DataFrame, table: DataFrame, one: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are as similar as asked; ``one`` has a row (node, n) per node, ``table`` the
    texts (n, node, t)."""
    def sketch(text):
        values = shingle_set(text, width)
        return values.view(np.int64), len(values), bit_set(values)

    def make():
        return lambda part: dict(zip(("set", "size", "bits"), zip(*map(sketch, part))))

    pairs = written(pairs.distinct(), "pairs")
    rows = by_size(one.join(_nodes(pairs), "node", "left_semi").select("n"), most=SEND_IDS)
    sets = written(map_texts(table.join(rows, "n", "left_semi").select("node", "t"), "t", ["node"],
                             [("set", T.ArrayType(T.LongType())), ("size", T.LongType()), ("bits", T.BinaryType())], make), "sets")
    pairs = written(_likely(pairs, sets, similarity), "likely")
    sets = sets.join(by_size(_nodes(pairs), most=SEND_IDS), "node", "left_semi").select("node", "set")
    # never broadcast: Spark counts a list as one entry
    both = pairs.join(sets.toDF("a", "sa").hint("merge"), "a").join(sets.toDF("b", "sb").hint("merge"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= similarity * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _alike(x, y, similarity: float) -> Column:
    return F.least(x, y) >= similarity * F.greatest(x, y)


def simhash_pairs(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Candidates (a, b): every node of a SimHash class with the class's least one, from (node, fp, size)."""
    labels = linked_classes(written(nodes.select("fp").distinct(), "fingerprints"))
    named = nodes.join(labels, "fp").select("node", "size", "label")
    pivots = named.groupBy("label").agg(F.min(F.struct("node", "size")).alias("p"), F.max("node").alias("last")).where(
        "p.node < last").select("label", F.col("p.node").alias("a"), F.col("p.size").alias("pivot_size"))
    return named.join(pivots, "label").where((F.col("node") != F.col("a")) & _alike("size", "pivot_size", similarity)).select(
        "a", F.col("node").alias("b"))


def similar_classes(table: DataFrame, width: int = SET_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(node, label) of nodes with links, from (n, t, fp, node, size, bands) with unique row ids ``n``."""
    one = written(table.groupBy("node").agg(F.min(F.struct("n", "fp", "size", "bands")).alias("r")).select("node", "r.*"), "nodes")
    index = one.select("node", "size", F.explode("bands").alias("key"))
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = index.repartition(tasks, "key")  # one shuffle serves both sides
    pivots = index.groupBy("key").agg(F.min(F.struct("node", "size")).alias("p"), F.max("node").alias("last")).where(
        "p.node < last").select("key", F.col("p.node").alias("pivot"), F.col("p.size").alias("pivot_size"))
    members = written(index.join(pivots, "key"), "buckets")

    pairs = members.where((F.col("node") != F.col("pivot")) & _alike("size", "pivot_size", similarity)).select(
        F.col("pivot").alias("a"), F.col("node").alias("b"))
    pairs = simhash_pairs(one, similarity).union(pairs)
    labels = components(_similar(pairs, table, one, width, similarity))
    named = members.select("key", "node", "size").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    main = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    named = written(named.join(main, "key"), "members")
    a, b = (named.select("key", F.col("node").alias(x), F.col("size").alias(f"size_{x}"), F.col("label").alias(f"label_{x}"),
                         (F.col("label") == F.col("main")).alias(f"main_{x}")) for x in "ab")
    more = a.where("NOT main_a").hint("merge").join(b.hint("merge"), "key").where(  # files of repeated keys look small
        (F.col("label_a") != F.col("label_b")) & (F.col("main_b") | (F.col("a") < F.col("b")))
        & _alike("size_a", "size_b", similarity))
    pairs = more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return _merged(labels, written(_similar(pairs, table, one, width, similarity), "between"))


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SET_SHINGLE,
                similarity: float = SIMILARITY) -> DataFrame:
    """One document of each component of similar texts, the one with the least id (of several, the first row), with all
    columns."""
    source = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"), F.col(key).alias("k"))
    table = with_row_ids(_sketched(source, ["row", "k"], width), "n", "minhash")
    labels = similar_classes(table.withColumn("t", F.col("row").getField(text)), width, similarity)
    first = (table.select("n", "k", "node").join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label"))
             .agg(F.min(F.struct(F.col("k").isNull().alias("no_id"), "k", "n"))["n"].alias("n")))
    gone = by_size(table.select("n").join(first.select("n"), "n", "left_anti"), most=SEND_IDS)
    return table.join(gone, "n", "left_anti").select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])
