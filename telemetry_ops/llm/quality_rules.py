"""Quality rules: counts of each document, and lines that many documents of a host share.

Words are runs of characters other than ASCII white space. The base rule rejects documents of fewer than 10 words, or
with more than a fifth of their words inside repeated 5-word windows.

The method: every line is normalised (A-Z lower-cased, white space collapsed) and hashed; per host, the distinct documents
that hold it are counted; lines in more than ``max_docs`` of them are removed, and a document is rejected as depleted if
removal leaves fewer than ``min_words`` words or less than ``min_share`` of its words. Documents with the same set of
lines are copies and count as one. Near copies are documents of their own: pages that are mostly a menu lose it and may be
depleted, however little else they hold. A line in few documents cannot exceed the limit, so documents are told apart only where
a line might. Texts stay where they are: tasks are sent the lines to remove, which are counted first (``BROADCAST_ITEMS``); only
beyond that are texts and the lines each loses joined by a shuffle.

A null or empty text has no words and fails the base rule. A null host is a host of its own. Repeated rows are copies.
Other columns are ignored (or carried, by ``clean``) whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from telemetry_ops.llm.common import BROADCAST_ITEMS, map_texts, with_row_ids, written

SYMBOLS = "#*$%&|<>"
MAX_DOCS = 10  # documents of a host that may share a line
MIN_WORDS = 10
MIN_SHARE = 0.3
WINDOW = 5

_FIELDS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
           ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("lines", T.ArrayType(T.LongType())),
           ("line_words", T.ArrayType(T.LongType()))]


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(normal_line(line)) - (1 << 63)


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that the list holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    seen, total, upto = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            total += i + width - max(i, upto)
            upto = i + width
    return total


def document_counts(text: bytes) -> tuple:
    """The values of ``_FIELDS`` of one text; ``lines`` has each distinct line with a word once."""
    words = text.split()
    lines: dict[int, int] = {}
    earlier, dup = set(), 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            dup += line in earlier
            earlier.add(line)
            h = line_hash(line)
            lines[h] = lines.get(h, 0) + n
    chars = text.decode()
    spaces = sum(map(text.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    return (len(words), len(chars) - spaces, sum(map(chars.count, SYMBOLS)), dup, repeat_words(words),
            list(lines), list(lines.values()))


def _counted(docs: DataFrame, text: str, keys: list[str]) -> DataFrame:
    def make():
        return lambda texts: dict(zip([n for n, _ in _FIELDS], zip(*map(document_counts, texts))))

    return map_texts(docs, text, keys, _FIELDS, make)


def _without(text: str, gone) -> str:
    return "\n".join(x for x in text.split("\n") if not x.strip() or line_hash(x.encode()) not in gone)


def _losing(table: DataFrame, shared: DataFrame, keep: list[str], text: int | None) -> DataFrame:
    """``keep``, ``removed_words`` and ``new`` (the text without its removed lines; both null: none is removed) by the lines to
    remove (_h, _l), which go to every task; ``text`` is the text's place in ``row``, None if no text is asked for."""
    by_host: dict = {}
    for r in shared.collect():
        by_host.setdefault(r["_h"], set()).add(r["_l"])
    sent = table.sparkSession.sparkContext.broadcast(by_host)
    at = len(keep)

    def lost(part):
        for i, (host, lines, words) in enumerate(zip(*(part.column(at + j).to_pylist() for j in range(3)))):
            gone = sent.value.get(host, ())
            held = {line: n for line, n in zip(lines, words) if line in gone}
            if held:
                new = None if text is None else _without(part.column(0).field(text)[i].as_py(), held)
                yield sum(held.values()), new
            else:
                yield None, None

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                n, new = zip(*lost(part))
                yield pa.RecordBatch.from_arrays([*(part.column(j) for j in range(at)), pa.array(n, pa.int64()),
                                                  pa.array(new, pa.string())], names=[*keep, "removed_words", "new"])

    schema = T.StructType([*(table.schema[c] for c in keep), T.StructField("removed_words", T.LongType()),
                           T.StructField("new", T.StringType())])
    return table.select(*keep, "host", "lines", "line_words").mapInArrow(run, schema)


def judged(source: DataFrame, max_docs: int, min_words: int, min_share: float, text: int | None = None) -> DataFrame:
    """``row``, the counts, ``base_failed``, ``kept``, ``n_removed_words`` from (row, text, host); where the text's place in ``row``
    is given, ``new`` is the text without its removed lines (null: none is removed)."""
    table = with_row_ids(_counted(source, "text", ["row", "host"]), "doc", "quality")
    lines = table.select("doc", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select(
        "doc", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    same = F.col("host").eqNullSafe(F.col("_h")) & (F.col("line") == F.col("_l"))

    def frequent(counted: DataFrame, n) -> DataFrame:
        return (counted.groupBy("host", "line").agg(n.alias("n")).where(F.col("n") > max_docs)
                .select(F.col("host").alias("_h"), F.col("line").alias("_l")))

    held = lines.join(frequent(lines, F.count(F.lit(1))), same, "left_semi").join(
        table.select("doc", F.xxhash64(F.sort_array("lines")).alias("whole")), "doc")
    held = written(held, "held")
    shared = written(frequent(held, F.countDistinct("whole")), "shared")
    if shared.count() <= BROADCAST_ITEMS:
        marked = _losing(table, shared, ["row", *[n for n, _ in _FIELDS[:5]]], text)
    else:
        removed = held.join(shared, same, "left_semi").groupBy("doc").agg(
            F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed"))
        marked = table.drop("lines", "line_words").join(removed, "doc", "left").withColumn("new", F.lit(None).cast("string"))
        if text is not None:
            # the function runs on every row, whatever condition stands before it, so texts without removed lines stay out
            shown = F.when(F.col("removed").isNotNull(), F.col("row").getField(source.schema["row"].dataType.names[text]))
            without = F.udf(lambda value, gone: gone and _without(value, set(gone)), T.StringType(), useArrow=True)
            marked = marked.withColumn("new", without(shown, "removed"))
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = F.coalesce((left < min_words) | (left < min_share * F.col("n_words")), F.lit(False))
    return marked.select(
        "row", *[n for n, _ in _FIELDS[:5]], failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        F.coalesce("removed_words", F.lit(0)).cast("long").alias("n_removed_words"), "new")


def quality_rules(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source",
                  max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per document: ``key``, the five counts, ``base_failed``, ``kept``, ``n_removed_words``."""
    asked = docs.select(F.struct(F.col(key).alias("k")).alias("row"), F.col(text).alias("text"),
                        F.col(host).alias("host"))
    out = judged(asked, max_docs, min_words, min_share)
    return out.select(F.col("row.k").alias(key), *[c for c in out.columns if c not in ("row", "new")])


def clean(docs: DataFrame, text: str = "text", host: str = "source", n_chars: str | None = "n_chars",
          max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """The kept documents without their removed lines, with the columns of ``docs``; ``n_chars`` is counted anew."""
    source = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.col(host).alias("host"))
    out = judged(source, max_docs, min_words, min_share, docs.columns.index(text)).where("kept")
    columns = {c: F.col("row").getField(c) for c in docs.columns}
    if n_chars in columns:
        columns[n_chars] = F.when(F.col("new").isNull(), columns[n_chars]).otherwise(
            F.length("new").cast(docs.schema[n_chars].dataType))
    columns[text] = F.coalesce("new", F.col("row").getField(text))
    return out.select(*[c.alias(n) for n, c in columns.items()])
