"""Line dedup, fill-in-the-middle and resampling against brute force, round trips and hand-made edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_ops.llm import fill_in_middle as fim, line_dedup, queries, resampling

SPACE = " \t\n\v\f\r"
EDGES = [(1, "The cat\nsat on the mat"), (2, None), (3, ""), (4, " \n\t \n"), (5, "x" * 200_000 + "\né梦\n\n end <"), (6, "same\nsame"),
         (6, "same\nsame"), (6, "same\nother"), (None, "no id"), (None, None), (7, "holds <S> a mark\nand more"), (8, "\n"),
         (9, "a<\n<S\nb<P"), (10, "THE CAT \r\n the cat")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, blank, very long, odd and repeated rows, and columns whose names the operators use themselves."""
    names = ("row", "id", "key", "kept", "gone", "place", "score", "rank", "n", "form", "bucket", "weight", "lines", "docs")
    return spark.createDataFrame(EDGES, "doc_id long, text string").withColumns({n: F.lit(1) for n in names}).repartition(3)


def random_texts(n, seed=3):
    rng = random.Random(seed)
    lines = ["", " ", "menu", " Menu\t", "MENU", "é", "footer é", "a b", "own <", "x" * 50]
    return ["\n".join(rng.choice([*lines, f"own {i}"]) for _ in range(rng.randint(0, 9))) for i in range(n)]


def brute_dedup(texts, min_docs, min_chars=1):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    held = Counter(k for t in texts for k in {key(x) for x in t.split("\n")} if len(k) >= min_chars)
    out = []
    for t in texts:
        lines = t.split("\n")
        kept = [x for x in lines if held[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def members(store):
    return {bytes(r[0]) for r in store.counts.where(F.col("docs") >= store.min_docs).collect()}


@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, -1])
@pytest.mark.parametrize("min_docs, min_chars", [(2, 1), (10, 5)])
def test_line_dedup_matches_brute_force(spark, filter_bytes, min_docs, min_chars):
    texts = random_texts(120)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    store = line_dedup.insert(line_dedup.empty_store(spark, min_docs, min_chars), df)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.apply(store, df, filter_bytes=filter_bytes).collect()}
    assert got == dict(enumerate(brute_dedup(texts, min_docs, min_chars)))
    assert sum(n for _, n, _ in got.values())


@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, -1])
def test_line_dedup_edges(spark, docs, filter_bytes):
    store = line_dedup.insert(line_dedup.empty_store(spark, 2), docs)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept)
                  for r in line_dedup.apply(store, docs, filter_bytes=filter_bytes).collect())
    want = Counter((i, *x) for (i, _), x in zip(EDGES, brute_dedup([t or "" for _, t in EDGES], 2)))
    assert got == want
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_deleting_documents_gives_back_the_store(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PER_SHARD", 4)  # many shards, made anew as keys are added
    texts = [f"line {i % 40}\nline {i % 7}\nown {i}" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first, second = df.where("doc_id < 90"), df.where("doc_id >= 90")
    empty = line_dedup.empty_store(spark, 4)
    one = line_dedup.insert(empty, first)
    both = line_dedup.insert(one, second)
    back = line_dedup.delete(both, second)
    assert both.shards > 1
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, one.counts.collect()))
    for store, of in ((one, first), (both, df), (back, first)):
        held, keys = members(store), [bytes(r[0]) for r in store.counts.collect()]
        assert dict(zip(keys, line_dedup._members(store).hits(keys))) == {k: k in held for k in keys}
        out = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.apply(store, of).collect()}
        ids = [r.doc_id for r in of.collect()]
        assert [out[i] for i in ids] == brute_dedup([texts[i] for i in ids], 4)
    nothing = line_dedup.delete(back, first)
    assert nothing.counts.count() == 0
    with pytest.raises(ValueError):
        line_dedup.delete(one, second)


def test_a_full_filter_is_built_anew(spark):
    def made(a, b):
        return spark.createDataFrame([("\n".join(f"line {i}" for i in range(a, b)),)], "text string")
    store = line_dedup.insert(line_dedup.empty_store(spark, 1), made(0, 5))
    store = line_dedup.insert(store, made(5, 3000))
    keys = [line_dedup.key_of(f"line {i}".encode()) for i in range(3000)]
    assert line_dedup._members(store).hits(keys).all()


def test_cuckoo_filter_keeps_every_key_and_forgets_deleted_ones():
    keys = [hashlib.sha256(str(i).encode()).digest()[:16] for i in range(6000)]
    made = line_dedup.CuckooFilter(4000)
    assert made.insert(keys[:4000]) and made.holds(keys[:4000]).all()
    assert made.holds(keys[4000:]).sum() <= 1
    made.delete(keys[:2000])
    assert made.holds(keys[2000:4000]).all() and made.holds(keys[:2000]).sum() <= 1
    full = line_dedup.CuckooFilter(8)
    assert not full.insert(keys[:200])


def test_wrong_keys_of_the_filters_are_corrected():
    keys = [hashlib.sha256(str(i).encode()).digest()[:16] for i in range(2)]
    twin = bytes([*keys[0][:12], *keys[1][12:]])  # same shard, fingerprint and bucket
    made = line_dedup.CuckooFilter(10)
    made.insert(keys[:1])
    assert line_dedup.Members({0: made.cells}, 1, frozenset()).hits([keys[0], twin]).tolist() == [True, True]
    assert line_dedup.Members({0: made.cells}, 1, frozenset([twin])).hits([keys[0], twin]).tolist() == [True, False]


def brute_middle(doc_id, text, share=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= share:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


@pytest.mark.parametrize("chunk", [1, 3, 8192])
def test_fill_in_middle_matches_brute_force(spark, docs, chunk):
    rows = EDGES + [(100 + i, t) for i, t in enumerate(random_texts(60))]
    rows = [(i, t) for i, t in rows if chunk > 3 or len(t or "") < 1000]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).repartition(3)
    got = Counter(map(tuple, fim.fill_in_middle(df, chunk=chunk).collect()))
    assert got == Counter(brute_middle(*r) for r in rows)
    half = Counter(map(tuple, fim.fill_in_middle(df, share=40, spm_share=20, chunk=chunk).collect()))
    assert half == Counter(brute_middle(*r, 40, 20) for r in rows)
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_fill_in_middle_of_many_equal_rows(spark):
    df = spark.createDataFrame([(1, "a\nb\nc\n")] * 500 + [(2, "a\nb\nc\n")] * 3, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, fim.fill_in_middle(df).collect()))
    assert got == {brute_middle(1, "a\nb\nc\n"): 500, brute_middle(2, "a\nb\nc\n"): 3}


def test_texts_come_back_from_outputs_in_pieces_of_any_size():
    rng = random.Random(1)
    for doc_id in range(300):
        text = "".join(rng.choice("<PSM>\n ab") for _ in range(rng.randint(0, 40)))
        form = fim.plan(text, doc_id)[1]
        out = fim.transformed(text, doc_id)
        assert sha(out) == brute_middle(doc_id, text)[5] and fim.restore(out, form) == text
        parts, found = fim.Parts(form), ["", "", ""]
        at = 0
        while at < len(out):
            size = rng.randint(1, 4)
            for place, part in parts.feed(out[at:at + size]):
                found[place] += part
            at += size
        for place, part in parts.feed("", last=True):
            found[place] += part
        assert "".join(found) == text


def test_span_checksums_match_the_library():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 20_000).astype(np.uint8)
    lengths = np.concatenate([np.arange(1, 200), rng.integers(1, 5000, 50), [64, 128, 65, 127]])
    starts = np.array([rng.integers(0, len(data) - n) for n in lengths])
    for block in (1, 5, 64):
        got = resampling.SpanCrc(block)(data, starts, lengths)
        assert got.tolist() == [zlib.crc32(data[s:s + n].tobytes()) for s, n in zip(starts, lengths)]


def test_span_checksums_are_gathered_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(resampling, "GATHERED", 50)
    data = np.arange(2000, dtype=np.uint8)
    starts, lengths = np.arange(0, 900, 3), np.arange(1, 301)
    assert resampling.SpanCrc()(data, starts, lengths).tolist() == [
        zlib.crc32(data[s:s + n].tobytes()) for s, n in zip(starts, lengths)]


def brute_draw(rows, target, min_words=20, percent=25):
    def features(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return words, [zlib.crc32(x.encode()) % 10_000 for x in [*words, *map(" ".join, zip(words, words[1:]))]]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    total, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total + 10_000) / ((s[b] + 1) * (wanted + 10_000))))
    out = []
    for i, text in rows:
        words, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(sha(f"7:{'' if i is None else i}")[:8], 16)
        out.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is not None, x[0] or 0, x[2]))
    ranks = {id(x): k + 1 for k, x in enumerate(order[:len(order) * percent // 100])}
    return Counter((*x, ranks.get(id(x))) for x in out)


def test_resampling_matches_brute_force(spark, docs):
    rng = random.Random(4)
    parts = ["word", "Word", "é", "12", "benchmark", "x-y", "\x00", "ÀB", "w" * 300]
    rows = EDGES + [(100 + i // 2, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    target = ["benchmark word 12", None, "word benchmark", ""]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    of = spark.createDataFrame([(t,) for t in target], "text string")
    got = Counter(map(tuple, resampling.resample(df, of).collect()))
    assert got == brute_draw(rows, target)
    loose = Counter(map(tuple, resampling.resample(df, of, min_words=1, percent=60).collect()))
    assert loose == brute_draw(rows, target, 1, 60)
    assert resampling.resample(docs.limit(0), of).count() == 0
    assert resampling.resample(docs, of.limit(0)).count() == len(EDGES)
    chosen = resampling.drawn(docs, of, min_words=1, percent=50)
    assert chosen.columns == docs.columns and chosen.count()


def test_registered_queries_match_brute_force_on_the_smallest_data(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{tiny}/benchmark.parquet").select("text").collect()]
    got = queries.op13_resampling(spark, tiny).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, got)) == brute_draw(rows, target)
    assert Counter(map(tuple, queries.op12_fill_in_middle(spark, tiny).collect())) == Counter(brute_middle(*r) for r in rows)
    got = queries.op11_line_dedup(spark, tiny).collect()
    want = [(i, a, b, sha(c)) for (i, _), (a, b, c) in zip(rows, brute_dedup([t or "" for _, t in rows], 10))]
    assert sorted(map(tuple, got)) == sorted(want)
