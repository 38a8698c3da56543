"""Fill-in-the-middle: texts cut at two places between lines and put together anew, streamed in pieces.

A text's units are its lines with their line ends. Two hashes of seed and id choose the cuts; two more whether the text is
transformed (``share`` in 100) and which form it takes (``spm_share`` in 100): ``psm`` is ``<P>`` prefix ``<S>`` suffix
``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. Empty texts and texts that hold a mark stay ``plain``.

No task builds a whole output. Each row becomes pieces of whole units, up to ``CHUNK`` code points (a longer unit is cut),
keyed by document and output position. ``repartitionAndSortWithinPartitions`` brings a document's pieces together in
order, and they run one by one through an incremental digest. For the check, the output stream alone (and the form) is
parsed for its marks; the parts found are sorted again within their partition by place in the text (the partitioning is
known, so nothing is shuffled) and digested too. Partitions are as many as the counted bytes of text need; sorting spills to
disk, and a task keeps one piece of one document.

A document's key is a digest of id and text, with the number of the input partition: equal rows of one partition share
pieces and are counted, equal rows of other partitions go to other tasks, so a group of copies of any size is dealt
out. A recomputed task makes the same pieces.

A null text is empty; a null id hashes like the empty text. Repeated rows give repeated results. Other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

SEED = 7
SHARE = 100
SPM_SHARE = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK = 8192  # code points of a piece, at most
PART_BYTES = 32 << 20  # of text in a partition of pieces, about; longer texts have one of their own

# order of marks in the output, with the place of what follows in the text
_LAYOUT = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
_HEAD, _LAST = 0, 3  # places: output position of the first piece; part after prefix, middle and suffix


def hashes(doc_id, seed: int = SEED) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def plan(text: str, doc_id, seed: int = SEED, share: int = SHARE, spm_share: int = SPM_SHARE) -> tuple:
    """Units, form, and the ends of prefix and middle in code points."""
    h1, h2, h3, h4 = hashes(doc_id, seed)
    n = text.count("\n") + (text[-1:] not in ("", "\n"))
    if not text or h3 % 100 >= share or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    ends, at = [], 0
    for units in (low, high - low):
        for _ in range(units):
            at = text.find("\n", at) + 1 or len(text)
        ends.append(at)
    return n, "spm" if h4 % 100 < spm_share else "psm", *ends


def chunks(text: str, start: int, end: int, size: int = CHUNK) -> Iterator[str]:
    """Pieces of whole units up to ``size`` code points; a longer unit is cut."""
    while start < end:
        stop = min(end, start + size)
        if stop < end:
            stop = text.rfind("\n", start, stop) + 1 or stop
        yield text[start:stop]
        start = stop


def output_pieces(text: str, form: str, first: int, second: int, size: int = CHUNK) -> Iterator[str]:
    """The output in order."""
    if form == "plain":
        yield from chunks(text, 0, len(text), size)
        return
    spans = ((0, first), (first, second), (second, len(text)))
    for mark, place in _LAYOUT[form]:
        yield mark
        yield from chunks(text, *spans[place], size)


class Parts:
    """Tells prefix, middle and suffix apart in an output that arrives in pieces of any size."""

    def __init__(self, form: str):
        self.left = [] if form == "plain" else list(_LAYOUT[form])
        self.place, self.held = 0, ""

    def feed(self, piece: str, last: bool = False) -> Iterator[tuple[int, str]]:
        """(place in the text, what belongs there); the end of a piece that may begin a mark is held back."""
        text = self.held + piece
        while self.left:
            mark, place = self.left[0]
            at = text.find(mark)
            if at < 0:
                break
            if at:
                yield self.place, text[:at]
            text, self.place = text[at + len(mark):], place
            self.left.pop(0)
        keep = 0
        if self.left and not last:
            mark = self.left[0][0]
            keep = next((k for k in (2, 1) if text.endswith(mark[:k])), 0)
        self.held = text[len(text) - keep:]
        if len(text) > keep:
            yield self.place, text[:len(text) - keep]


def restore(output: str, form: str) -> str:
    """The text an output was made from."""
    found = ["", "", ""]
    for place, part in Parts(form).feed(output, last=True):
        found[place] += part
    return "".join(found)


def transformed(text: str | None, doc_id, **options) -> str:
    """The whole output of one text, for texts that fit in memory anyway."""
    text = text or ""
    return "".join(output_pieces(text, *plan(text, doc_id, **options)[1:]))


def _partition(key) -> int:
    return int.from_bytes(key[0][:8], "big") ^ (key[1] * 0x9E3779B1)


def _pieces(split: int, rows, seed: int, share: int, spm_share: int, size: int):
    """((document, split, output position), (piece, facts of the document with the first one))."""
    for doc_id, text in rows:
        text = text or ""
        n, form, first, second = plan(text, doc_id, seed, share, spm_share)
        name = hashlib.sha256(f"{doc_id!r} {text}".encode()).digest()[:16]
        head = (doc_id, n, form, *((first, second - first) if form != "plain" else (None, None)))
        place = _HEAD
        for piece in output_pieces(text, form, first, second, size):
            yield (name, split, place), (piece, head if place == _HEAD else None)
            place += 1
        if place == _HEAD:
            yield (name, split, place), ("", head)


def _digested(rows):
    """Runs outputs through a digest; gives ((document, split, place in the text, number), part) and the facts last."""
    doc = at = None
    copies = number = 0

    def closed():
        for place, part in parts.feed("", last=True):
            yield (*doc, place, number), part
        yield (*doc, _LAST, 0), (head, digest.hexdigest(), copies)

    for (name, split, place), (piece, facts) in rows:
        if (name, split) == doc and place == at:  # an equal row's piece
            copies += place == _HEAD
            continue
        if (name, split) != doc:
            if doc:
                yield from closed()
            doc, head, digest, parts = (name, split), facts, hashlib.sha256(), Parts(facts[2])
            copies, number = 1, 0
        at = place
        digest.update(piece.encode())
        for part_of, part in parts.feed(piece):
            yield (*doc, part_of, number), part
            number += 1
    if doc:
        yield from closed()


def _restored(rows):
    """Runs the parts, now in the order of the text, through a second digest; gives the result rows."""
    digest = hashlib.sha256()
    for (_, _, place, _), value in rows:
        if place != _LAST:
            digest.update(value.encode())
            continue
        head, output, copies = value
        for _ in range(copies):
            yield (*head, output, digest.hexdigest())
        digest = hashlib.sha256()


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = SEED, share: int = SHARE,
                   spm_share: int = SPM_SHARE, chunk: int = CHUNK) -> DataFrame:
    """Per document: ``key``, units ``n``, ``form``, ``prefix_chars``, ``middle_chars``, digests of output and restored text."""
    rows = docs.select(F.col(key), F.col(text).cast("string")).rdd
    held = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // PART_BYTES))
    pieces = rows.mapPartitionsWithIndex(lambda split, part: _pieces(split, part, seed, share, spm_share, chunk))
    placed = pieces.repartitionAndSortWithinPartitions(parts, _partition)
    ordered = placed.mapPartitions(_digested, preservesPartitioning=True).repartitionAndSortWithinPartitions(
        parts, _partition)
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())])
    return docs.sparkSession.createDataFrame(ordered.mapPartitions(_restored), schema, verifySchema=False)


_H = "('0x' || substr(hash, {}, 8))::bigint"
SQL = f"""
with base as (
    select doc_id, coalesce(text, '') as text, sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as hash from documents),
units as (
    select *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') as u,
        {_H.format(1)} as h1, {_H.format(9)} as h2, {_H.format(17)} as h3, {_H.format(25)} as h4 from base),
cut as (
    select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as low,
        greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as high,
        case when text = '' or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}')
            or h3 % 100 >= {SHARE} then 'plain' when h4 % 100 < {SPM_SHARE} then 'spm' else 'psm' end as form from units),
parts as (
    select *, array_to_string(u[1:low], '') as p, array_to_string(u[low + 1:high], '') as m,
        array_to_string(u[high + 1:n], '') as s from cut)
select doc_id, n::bigint as n, form,
    case when form <> 'plain' then length(p) end::bigint as prefix_chars,
    case when form <> 'plain' then length(m) end::bigint as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
        else '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m end) as output_sha256,
    sha256(text) as restored_sha256
from parts"""
