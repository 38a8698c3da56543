"""WARC derivatives: metadata and plain-text conversion records linked to the responses they come from.

A response has an id, a target, a date, its HTTP headers and its payload. For each, two records are built: a
``metadata`` record (``application/warc-fields``: the source's headers and digests, title, language, character set,
links) and a ``conversion`` record (``text/plain``). Both name the response in WARC-Refers-To, repeat its target and
date, and carry digests of their own blocks; ids are derived from the response's id, so a repeated run or a recomputed
task gives the same records. ``render`` gives the bytes of a record, ``write`` files that any WARC reader takes.

Null or empty pages give empty payloads and still two records; a null address is empty. Repeated rows give repeated
records. Pages are read in time proportional to their length, broken ones too. Other columns are ignored, whatever their names; an
empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from bisect import bisect_left
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from telemetry_ops.llm.common import arrow_type, slices

DATE = "2024-01-01T00:00:00Z"  # pages carry no date
VERSION = "WARC/1.1"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:records")

_TAG = re.compile(r"<[!/?a-z]", re.I)
_OPENS = re.compile(r"<(script|style|noscript|template|title)\b", re.I)
_CLOSES = re.compile(r"</(script|style|noscript|template|title)\s*>", re.I)
_BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|div|dd|dl|dt|fieldset|figure|footer|form|h[1-6]"
                    r"|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|tr|ul)\b", re.I)
_HTML, _META, _ANCHOR = (re.compile(rf"<{name}\b", re.I) for name in ("html", "meta", "a"))
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
_CHARSET = re.compile(r"""\bcharset\s*=\s*["']?([A-Za-z0-9_-]+)""", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"""[^\s>"']+""")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


class Page:
    """Markup of one page, found in one pass forward.

    Where marks end is known before any tag is looked at: places of ``>`` and quotes are listed once, the end of a tag from each
    of them is filled in from the back, and so are closing tags by name. So broken markup, whose ends are missing, costs
    no second search.
    """

    def __init__(self, page: str):
        self.page = page
        self.marks = [m.start() for m in re.finditer("[\"'>]", page)]
        self.ends = [-1] * (len(self.marks) + 1)  # the end of a tag that comes to this mark outside quotes, or -1
        following = {}
        for k in range(len(self.marks) - 1, -1, -1):
            kind = page[self.marks[k]]
            if kind == ">":
                self.ends[k] = self.marks[k] + 1
            elif kind in following:
                self.ends[k] = self.ends[following[kind] + 1]
            following[kind] = k
        self.angles = [m for m in self.marks if page[m] == ">"]
        self.closes: dict[str, list] = {}
        for m in _CLOSES.finditer(page):
            self.closes.setdefault(m[1].casefold(), []).append(m.span())
        self.comments = [m.start() for m in re.finditer("-->", page)]

    def angle(self, at: int) -> int:
        """The first ``>`` from a place on; -1 if there is none."""
        k = bisect_left(self.angles, at)
        return self.angles[k] if k < len(self.angles) else -1

    def element(self, opened: re.Match) -> tuple[int, int, int] | None:
        """Start and end of the content of an element that hides it, and the end of its closing tag."""
        start, closes = self.angle(opened.end()) + 1, self.closes.get(opened[1].casefold(), [])
        k = bisect_left(closes, (start,))
        return (start, *closes[k]) if start and k < len(closes) else None

    def end(self, at: int) -> int:
        """The end of the comment, hidden element or tag that starts at a ``<``; -1 if none does."""
        if self.page.startswith("<!--", at):
            k = bisect_left(self.comments, at + 4)
            if k < len(self.comments):
                return self.comments[k] + 3
        opened = _OPENS.match(self.page, at)
        found = opened and self.element(opened)
        if found:
            return found[2]
        return self.ends[bisect_left(self.marks, at + 2)] if _TAG.match(self.page, at) else -1

    def text(self) -> str:
        page, out, done = self.page, [], 0
        at = page.find("<")
        while at >= 0:
            end = self.end(at)
            if end < 0:
                at = page.find("<", at + 1)
                continue
            out.append(page[done:at])
            if _BLOCK.match(page, at):
                out.append("\n")
            done, at = end, page.find("<", end)
        out.append(page[done:])
        return "".join(out)

    def title(self) -> str | None:
        for opened in _OPENS.finditer(self.page):
            if opened[1].casefold() == "title":
                found = self.element(opened)
                return found and self.page[found[0]:found[1]]  # without an end here no later title has one
        return None

    def attribute(self, tag: re.Pattern, pattern: re.Pattern) -> str | None:
        """The value in the first tag that has one; a tag's attributes end at ``>`` or with the page."""
        at = 0
        while opened := tag.search(self.page, at):
            at = self.angle(opened.end())
            at = len(self.page) if at < 0 else at
            if found := pattern.search(self.page, opened.end(), at):
                return found[1]
        return None

    def links(self) -> list[str]:
        page, out, at = self.page, [], 0
        last = {q: page.rfind(q) for q in "\"'"}
        while found := _ANCHOR.search(page, at):
            stop = self.angle(found.end())
            at = stop = len(page) if stop < 0 else stop
            for name in _HREF.finditer(page, found.end(), stop):
                value = name.end()
                quote = page[value:value + 1]
                if quote in last and quote:
                    if last[quote] > value:
                        at = page.index(quote, value + 1) + 1
                        out.append(page[value + 1:at - 1])
                        break
                elif bare := _BARE.match(page, value):
                    at = bare.end()
                    out.append(bare[0])
                    break
        return out


def plain_text(page: str) -> str:
    """Visible text: one line per block, white space collapsed, entities resolved; no scripts, styles, comments, title."""
    text = _LINES.sub("\n", _BLANKS.sub(" ", entities.unescape(Page(page).text())))
    return text.strip()


def _one_line(value: str) -> str:
    return " ".join(entities.unescape(value).split())


def page_fields(page: str, target: str) -> list[tuple[str, str]]:
    """Metadata fields read from a page."""
    marked = Page(page)
    found = (("title", marked.title()), ("language", marked.attribute(_HTML, _LANG)),
             ("charset", marked.attribute(_META, _CHARSET)))
    out = [(name, _one_line(value)) for name, value in found if value is not None]
    for link in map(_one_line, marked.links()):
        try:
            out.append(("outlink", urljoin(target, link)))
        except ValueError:  # no valid address
            out.append(("outlink", link))
    return out


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
              date: str = DATE) -> DataFrame:
    """Pages as responses: ``key``, response_id, target_uri, date, http_headers, payload."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    name = F.sha2(F.concat_ws("\0", F.coalesce(F.col(url), F.lit("")),
                              F.coalesce(F.col(key).cast("string"), F.lit("")), F.sha2(payload, 256)), 256)
    urn = F.concat_ws("-", F.substring(name, 1, 8), F.substring(name, 9, 4), F.concat(F.lit("5"), F.substring(name, 14, 3)),
                      F.concat(F.lit("8"), F.substring(name, 18, 3)), F.substring(name, 21, 12))
    return pages.select(
        F.col(key), F.concat(F.lit("<urn:uuid:"), urn, F.lit(">")).alias("response_id"),
        F.coalesce(F.col(url), F.lit("")).alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                 F.length(payload).cast("string"), F.lit("\r\n\r\n")).alias("http_headers"), payload.alias("payload"))


_FIELDS = [("record_type", T.StringType()), ("record_id", T.StringType()), ("refers_to", T.StringType()),
           ("target_uri", T.StringType()), ("date", T.StringType()), ("content_type", T.StringType()),
           ("content_length", T.LongType()), ("block_digest", T.StringType()),
           ("source_payload_digest", T.StringType()), ("source_headers", T.StringType()), ("block", T.StringType())]


def _pair(source: str, target: str, date: str, headers: str, payload: bytes) -> list[tuple]:
    page = payload.decode("utf-8", "replace")
    body = digest(payload)
    fields = [("source-block-digest", digest(headers.encode() + payload)), ("source-payload-digest", body),
              *(("source-header", line) for line in headers.split("\r\n") if line), *page_fields(page, target)]
    out = []
    for kind, content, block in (
            ("metadata", "application/warc-fields", "".join(f"{n}: {v}\r\n" for n, v in fields)),
            ("conversion", "text/plain; charset=utf-8", plain_text(page))):
        data = block.encode()
        out.append((kind, record_id(source, kind), source, target, date, content, len(data), digest(data), body,
                    headers, block))
    return out


def derive(answers: DataFrame, key: str = "page_id") -> DataFrame:
    """Two records per response (columns as from :func:`responses`)."""
    schema = T.StructType([T.StructField(key, answers.schema[key].dataType)]
                          + [T.StructField(n, kind) for n, kind in _FIELDS])
    names = schema.names
    source = answers.select(F.col(key).alias("k"), "response_id", "target_uri", "date", "http_headers", "payload")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 5, 512, 4 << 20):
                inputs = zip(*(part.column(i).to_pylist() for i in range(1, 6)))
                rows = [row for given in inputs for row in _pair(*given)]
                columns = [pa.array(c, arrow_type(kind)) for c, (_, kind) in zip(zip(*rows), _FIELDS)]
                twice = pa.array([i for i in range(part.num_rows) for _ in range(2)])
                yield pa.RecordBatch.from_arrays([part.column(0).take(twice), *columns], names=names)

    return source.mapInArrow(run, schema)


def render(records: DataFrame) -> DataFrame:
    """``record``: header and block of each record, without the two line ends that close it."""
    def line(name, column):
        return F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit("\r\n"))

    return records.select(F.concat(
        F.lit(VERSION + "\r\n"), line("WARC-Type", "record_type"), line("WARC-Record-ID", "record_id"),
        line("WARC-Refers-To", "refers_to"), line("WARC-Target-URI", "target_uri"), line("WARC-Date", "date"),
        line("WARC-Block-Digest", "block_digest"), line("Content-Type", "content_type"),
        line("Content-Length", "content_length"), F.lit("\r\n"), F.col("block")).alias("record"))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files, one per task."""
    render(records).write.text(path, lineSep="\r\n\r\n", compression=compression)


def derivatives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    return derive(responses(pages, key, url, html), key)
