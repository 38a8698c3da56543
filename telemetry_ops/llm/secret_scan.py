"""Secret scans through a trigram inverted index, in DataFrame functions only.

For every rule a Boolean trigram query is derived from its regular expression: strings that a match must hold become
conjunctions of their trigrams, alternatives become disjunctions. The index lists, per trigram that a rule asks for and
per block of documents, the documents whose lower-cased text holds it; the lists of a block are intersected and united
as the query says, and only the documents left are verified with the expression. Rules without mandatory trigrams are
run over every document. Blocks bound every list, whatever the documents hold.

Matches of a kind are leftmost and do not overlap; a match fails if its checked group is shorter than the rule's least
length. Positions are code points, ends exclusive. They come from the lengths of the parts between matches, added up by
document and kind. A null text is empty. Repeated rows are reported each; other columns are ignored or carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetry_ops.llm.common import by_size, with_row_ids

MASK = "[SECRET]"
BLOCK_BITS = 12  # documents of a block of the index: at most 2 ** BLOCK_BITS
_MOST_STRINGS = 64  # alternatives kept as exact strings while a query is derived


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # in the syntax that Python and Java share
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 40),
    Rule("url_password", "://[^\\x20\\x09-\\x0D/:@]+:[^\\x20\\x09-\\x0D/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES


# -- trigram queries ----------------------------------------------------------------------------------------------
# A query is a list that must all hold; each item is a list of alternatives; each alternative a set of trigrams.


def _grams(strings: set[str]) -> list[list[frozenset]]:
    """The query of an exact set of strings: nothing if one is shorter than three characters."""
    if min(map(len, strings)) < 3:
        return []
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    return [sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)]


def _exact(op, value) -> set[str] | None:
    """All lower-cased strings a node may match, if they are few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
        return {chr(v).lower() for _, v in value}
    if name == "SUBPATTERN":
        return _all_exact(value[3])
    if name == "BRANCH":
        found = [_all_exact(part) for part in value[1]]
        return set().union(*found) if all(f is not None for f in found) else None
    if name == "MAX_REPEAT" and value[1] == 1:
        inner = _all_exact(value[2])
        return inner and inner | ({""} if value[0] == 0 else set())
    return None


def _all_exact(nodes) -> set[str] | None:
    strings = {""}
    for op, value in nodes:
        found = _exact(op, value)
        if found is None or len(found) * len(strings) > _MOST_STRINGS:
            return None
        strings = {a + b for a, b in product(strings, found)}
    return strings


def _derive(nodes) -> list[list[frozenset]]:
    query, strings = [], {""}
    for op, value in nodes:
        found = _exact(op, value)
        if found is not None and len(found) * len(strings) <= _MOST_STRINGS:
            strings = {a + b for a, b in product(strings, found)}
            continue
        query += _grams(strings)
        strings = {""}
        if str(op) == "SUBPATTERN":
            query += _derive(value[3])
        elif str(op) == "MAX_REPEAT" and value[0]:
            query += _derive(value[2])
    return query + _grams(strings)


def trigram_query(pattern: str) -> list[list[frozenset]]:
    """What the lower-cased text of every match holds; empty if the expression has no mandatory trigram."""
    return _derive(re._parser.parse(pattern))


# -- index --------------------------------------------------------------------------------------------------------


def postings(table: DataFrame, grams: list[str]) -> DataFrame:
    """(block, gram, docs): the documents of a block whose lower-cased text holds the trigram. ``table``: doc, text."""
    low = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in grams]))
    return (table.select(F.shiftright("doc", BLOCK_BITS).alias("block"), "doc", F.explode(held).alias("gram"))
            .groupBy("block", "gram").agg(F.collect_list("doc").alias("docs")))


def _of(query: list[list[frozenset]]) -> Column:
    def both(columns):
        out = columns[0]
        for c in columns[1:]:
            out = F.array_intersect(out, c)
        return out

    def listed(gram):
        return F.coalesce(F.col("lists")[gram], F.array().cast("array<bigint>"))

    return both([F.array_distinct(F.flatten(F.array(*[both([listed(g) for g in sorted(alternative)])
                                                      for alternative in item]))) for item in query])


def candidates(table: DataFrame, queries: dict[str, list]) -> DataFrame:
    """(doc, kind) of the documents that satisfy the trigram queries."""
    grams = sorted({g for q in queries.values() for item in q for a in item for g in a})
    lists = postings(table, grams).groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("gram", "docs"))).alias("lists"))
    found = F.array(*[F.struct(F.lit(kind).alias("kind"), _of(q).alias("docs")) for kind, q in queries.items()])
    return (lists.select(F.explode(found).alias("x")).select("x.kind", F.explode("x.docs").alias("doc")))


# -- verification -------------------------------------------------------------------------------------------------


def _lengths(texts: DataFrame, rules: list[Rule], wanted) -> DataFrame:
    """(doc, kind, pos, m, g, p): lengths of every match, its checked group and the part of the text before it.

    ``wanted`` gives the condition under which a rule is run on a row of ``texts`` (doc, text).
    """
    def of(rule):
        pattern = F.lit(rule.pattern)
        found = F.arrays_zip(
            F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.length).alias("m"),
            F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.length).alias("g"),
            F.transform(F.split("text", rule.pattern, -1), F.length).alias("p"))
        return F.when(wanted(rule), F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"),
                                             found.alias("found")))

    each = texts.select("doc", F.explode(F.array_compact(F.array(*map(of, rules)))).alias("x"))
    return each.select("doc", "x.kind", "x.least", F.posexplode("x.found")).select(
        "doc", "kind", "least", "pos", "col.*").where("m IS NOT NULL")


def _whole_run(rule: Rule) -> Column:
    """A rule that is one repeated class has a passing match only where a run is long enough."""
    class_run = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return F.col("text").rlike(f"{class_run[1]}{{{rule.least}}}" if class_run else rule.pattern)


def find_spans(table: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc, kind, start, end) of all secrets; ``table`` holds unique ids ``doc`` and ``text``."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [r for r in rules if queries[r.kind]]
    whole = [r for r in rules if not queries[r.kind]]
    parts = []
    if indexed:
        kinds = candidates(table, {r.kind: queries[r.kind] for r in indexed}).groupBy("doc").agg(
            F.collect_set("kind").alias("kinds"))
        kinds = by_size(kinds)  # few documents are candidates, so their texts are seldom shuffled
        parts.append(_lengths(table.join(kinds, "doc"), indexed, lambda r: F.array_contains("kinds", r.kind)))
    if whole:
        parts.append(_lengths(table, whole, _whole_run))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    upto = Window.partitionBy("doc", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("p") + F.col("m")).over(upto)
    return found.withColumn("end", end).where("g >= least").select(
        "doc", "kind", (F.col("end") - F.col("m")).alias("start"), "end")


def _by_doc(spans: DataFrame, rules) -> DataFrame:
    number = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)]), F.col("kind"))
    return spans.groupBy("doc").agg(F.sort_array(F.collect_list(
        F.struct("start", number.alias("n"), "end", "kind"))).alias("all"))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``key``, counts ``n_<kind>`` and digest of the base kinds, and all ``spans``."""
    table = with_row_ids(docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text")), "doc",
                         "secrets")
    base = [r.kind for r in BASE_RULES]
    found = _by_doc(find_spans(table.select("doc", "text"), rules), rules)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    every = F.coalesce(F.col("all"), F.filter(F.array(F.struct(
        F.lit(0).cast("long").alias("start"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("end"),
        F.lit("").alias("kind"))), lambda x: F.lit(False)))
    def of(kinds):
        return F.filter(every, lambda x: x["kind"].isin(kinds))

    own = of(base)
    counts = [F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in base]
    return table.select("doc", "k").join(found, "doc", "left").select(
        F.col("k").alias(key), *counts, F.sha2(joined(own), 256).alias("base_sha256"), joined(every).alias("spans"))


def masked(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``MASK`` (overlapping spans by one); ``n_chars`` is counted anew."""
    others = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(c) for c in others], F.lit(True).alias("_row"))
    table = with_row_ids(docs.select(row.alias("row"), F.col(text).alias("text")), "doc", "secrets")
    spans = find_spans(table.select("doc", F.coalesce("text", F.lit("")).alias("text")), rules)
    before = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce((F.col("start") > F.max("end").over(before)).cast("int"), F.lit(1))
    islands = (spans.withColumn("opens", opens).withColumn("island", F.sum("opens").over(upto))
               .groupBy("doc", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    cuts = islands.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("cuts", lambda x: x["end"]))
    starts = F.concat(F.transform("cuts", lambda x: x["start"]), F.array(F.length("text").cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring("text", (a + 1).cast("int"), (b - a).cast("int")))
    joined = table.join(by_size(cuts, F.size("cuts")), "doc", "left").withColumn(
        "new", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(kept, MASK)))
    columns = {c: F.col("new") if c == text else F.col("row").getField(c) for c in docs.columns}
    if n_chars in columns:
        columns[n_chars] = F.when(F.col("cuts").isNull(), columns[n_chars]).otherwise(
            F.length("new").cast(docs.schema[n_chars].dataType))
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The result of :func:`scan` over ``documents`` in DuckDB."""
    parts = []
    for n, r in enumerate(rules):
        p = _quoted(r.pattern)
        parts.append(f"""SELECT doc_id, {n} AS n, '{r.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, g, p FROM (
  SELECT doc_id, regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {r.group}) AS g,
         string_split_regex(t, {p}) AS p FROM texts)
WHERE len(m) > 0""")
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}),
placed AS (SELECT doc_id, n, kind, length(m[i]) AS size, length(g[i]) AS checked,
  length(array_to_string(p[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS start FROM found),
spans AS (SELECT doc_id, n, kind, start, CAST(start AS VARCHAR) || ':' || CAST(start + size AS VARCHAR) AS place
  FROM placed WHERE checked >= [{', '.join(str(r.least) for r in rules)}][n + 1]),
joined AS (SELECT doc_id, count(*) FILTER (n = 0) AS n_assign, count(*) FILTER (n = 1) AS n_access,
  count(*) FILTER (n = 2) AS n_hex,
  coalesce(string_agg(kind || ':' || place, ',' ORDER BY start, n) FILTER (n < 3), '') AS base,
  string_agg(kind || ':' || place, ',' ORDER BY start, n) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id"""
