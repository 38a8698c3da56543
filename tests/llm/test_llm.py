"""Operators of the llm package against brute force, public libraries and hand-made edge rows."""

import gzip
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from telemetry_ops.llm import (
    byte_bpe, exact_topk, graph, lattice_lm, packing, quality_rules, queries, secret_scan, simhash_dedup, token_counts,
    toxicity, warc)

EDGES = [(1, "The cat sat on the mat today and it was good there", "s"), (2, None, "s"), (3, "", None),
         (4, " \n\t ", "s"), (5, "x" * 3000 + " é梦\n\n  <|endoftext|> ok", "s"),
         (6, "same line here\nsame line here", "s"), (6, "same line here\nsame line here", "s"), (None, "no id", "s")]


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, blank, long, odd and repeated rows, and columns whose names the operators use themselves."""
    df = spark.createDataFrame(EDGES, "doc_id long, text string, source string")
    return df.withColumns({"doc": F.lit(1), "row": F.lit("r"), "k": F.lit(2), "score": F.lit(0.5), "n": F.lit(3),
                           "n_chars": F.length("text").cast("long"), "lang": F.lit("en"), "kept": F.lit("x")})


def _texts(n=400, seed=5):
    rng = random.Random(seed)
    parts = ["a", "b", " ", " ", "  ", "\n", "\t", "é", "梦", "'s", "12", "!", "the", " th", "#", "<|endoftext|>", "\x85"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_every_operator_takes_edge_rows_and_empty_tables(spark, docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, None)], "doc_id long, toxic int")
    runs = [token_counts.token_counts, quality_rules.quality_rules, simhash_dedup.near_duplicates, lattice_lm.lm_scores,
            lambda d: toxicity.classify(d, labels), secret_scan.scan, byte_bpe.round_trip, byte_bpe.encode_texts]
    for run in runs:
        assert run(docs).count() == len(EDGES)
        assert run(docs.limit(0)).count() == 0
    for run in (quality_rules.clean, simhash_dedup.deduplicate, secret_scan.masked,
                lambda d: toxicity.clean(d, d, labels)):
        assert run(docs).columns == docs.columns and run(docs.limit(0)).count() == 0
    assert packing.pack(docs).groupBy("doc_id").count().count() == 7 and packing.pack(docs.limit(0)).count() == 0


def test_token_counts_match_the_unigram_tokenizer():
    pieces = token_counts.unigram_pieces(token_counts.VOCABULARY)
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *[(p, float(s)) for p, s in pieces]], unk_id=0))
    counter = token_counts.Counter(pieces)
    for word in ["thouwhor,", "theasttion", "hello", "worthless", "a", "gekeitst", "12,5", "ouèaux"]:
        assert counter.unit(token_counts.MARK + word)[1] == len(library.encode(token_counts.MARK + word).ids)
    assert counter.unit("梦\U0001f9ff")[1] == 1 + 4  # a character that is no piece counts by bytes
    assert token_counts.units_of("a  b c") == ["a", token_counts.MARK + "b", "c"]


def test_bpe_matches_the_library():
    library = Tokenizer.from_file(byte_bpe.TOKENIZER)
    bpe, _ = byte_bpe.codec(byte_bpe.TOKENIZER)
    other = packing.LibraryEncoder(byte_bpe.TOKENIZER)
    rng = random.Random(1)
    texts = _texts() + ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (63, 64, 65, 129, 1000)] + ["#" * 300]
    for text, ids, same in zip(texts, bpe.encode(texts, {}), other.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and ids == same
        assert bpe.decode(want) == library.decode(want, skip_special_tokens=False)


def test_quality_counts_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 20))]
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        marked = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
        assert quality_rules.repeat_words([w.encode() for w in words]) == len(marked)
    n, chars, symbols, dup, *_ = quality_rules.document_counts("a# |b\n\nc é\nc é\nC É".encode())
    assert (n, chars, symbols, dup) == (8, 10, 2, 1)


def test_shared_lines_go_but_copies_stay(spark):
    own = [(i, f"own words of number{i} stand here alone for the test today\nshared by all hosts", "h") for i in range(30)]
    copies = [(200 + i, "one text that many documents repeat word for word here\nand its second line", "h")
              for i in range(50)]
    near = [(300 + i, "near copies share this long line of words with each other\nand this one as well\n"
             f"but end in v{i}", "h") for i in range(50)]
    only = [(400, "shared by all hosts\nshared by all hosts\nshared by all hosts", "h")]
    df = spark.createDataFrame(own + copies + near + only, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(df).collect()}
    assert all(got[i]["kept"] and got[i]["n_removed_words"] == 4 for i in range(30))
    assert all(got[i]["kept"] for i in range(200, 250))
    assert not any(got[i]["kept"] for i in [*range(300, 350), 400])  # near copies are distinct documents
    assert quality_rules.clean(df).where("text LIKE '%shared by all%'").count() == 0


def test_pages_mostly_of_shared_lines_are_depleted(spark):
    menu = "\n".join(" ".join(f"{k}{j}" for j in range(11)) for k in "abc")
    stubs = [(i, menu + "\n" + " ".join(f"w{i}x{j}" for j in range(12)), "h") for i in range(40)]
    copies = [(100 + i, menu + "\n" + " ".join(f"w{j}" for j in range(12)), "g") for i in range(40)]
    few = [(200 + i, stubs[i][1], "f") for i in range(10)]
    df = spark.createDataFrame(stubs + copies + few, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(df).collect()}
    assert all(not got[i]["kept"] and got[i]["n_removed_words"] == 33 for i in range(40))
    assert all(got[i]["kept"] and got[i]["n_removed_words"] == 0 for i in [*range(100, 140), *range(200, 210)])
    assert {r["doc_id"] for r in quality_rules.clean(df).collect()} == {*range(100, 140), *range(200, 210)}


@pytest.mark.parametrize("own", [2, 5, 8, 9, 12])
def test_pages_with_few_words_of_their_own_are_depleted(spark, own):
    menu = "\n".join(" ".join(f"{k}{j}" for j in range(11)) for k in "abc")
    df = spark.createDataFrame([(i, menu + "\n" + " ".join(f"w{i}x{j}" for j in range(own)), "h") for i in range(60)],
                               "doc_id long, text string, source string")
    got = quality_rules.quality_rules(df).collect()
    assert not any(r["kept"] for r in got) and all(r["n_removed_words"] == 33 for r in got)


def test_quality_verdicts_against_brute_force(spark):
    rng = random.Random(12)
    lines = [f"{w} line of some words {w}" for w in "abcdefgh"] + ["", " \t", "A  line of SOME words a "]
    rows = []
    for i in range(300):
        body = [rng.choice(lines) for _ in range(rng.randint(0, 5))]
        body += [f"own {rng.randrange(40)} of a few more words {rng.randrange(9)}" for _ in range(rng.randint(0, 3))]
        rows.append((i, "\n".join(body), rng.choice(["x", "x", "y", None])))
    normal = lambda x: " ".join(x.lower().split())
    sets = {i: frozenset(normal(x) for x in t.split("\n") if x.split()) for i, t, _ in rows}
    held = defaultdict(set)
    for i, _, host in rows:
        for line in sets[i]:
            held[host, line].add(sets[i])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for max_docs in (3, 10):
        got = {r["doc_id"]: r for r in quality_rules.quality_rules(df, max_docs=max_docs).collect()}
        for i, text, host in rows:
            words = text.split()
            gone = sum(len(x.split()) for x in text.split("\n") if len(held[host, normal(x)]) > max_docs)
            left = len(words) - gone
            failed = len(words) < 10 or 100 * quality_rules.repeat_words([w.encode() for w in words]) > 20 * len(words)
            assert got[i]["n_removed_words"] == gone and got[i]["base_failed"] == failed
            assert got[i]["kept"] == (not failed and not (gone and (left < 10 or left < 0.3 * len(words))))


def _brute_components(values):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def _same_partition(a, b):
    seen = {}
    return all(seen.setdefault(a[k], b[k]) == b[k] for k in a) and len(set(a.values())) == len(set(b.values()))


@pytest.mark.parametrize("small", [64, 2])
def test_simhash_links_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(simhash_dedup, "SMALL_BUCKET", small)
    rng = random.Random(3)
    fps = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(120):
            value = centre
            for _ in range(rng.randint(0, 9)):
                value ^= 1 << rng.randrange(64)
            fps.add(simhash_dedup._signed(value))
    got = simhash_dedup.linked_classes(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    assert _same_partition(_brute_components(fps), {r["fp"]: r["label"] for r in got})


def test_fingerprint_by_definition():
    import xxhash

    for text in ("One two three FOUR five six", "a b", "", "x " * 50):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash_dedup.fingerprint(text.encode()) == want


def test_similar_texts_are_found_whatever_their_bits(spark):
    rng = random.Random(5)
    rows, sets = [], {}
    for g in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        for j in range(4):
            words = base[:]
            for _ in range(j * 2):
                words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
            sets[rows[-1][0]] = {tuple(words[i:i + 5]) for i in range(196)}
    label = {a: a for a in sets}
    for a in sets:
        for b in range(4 * (a // 4), a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = sorted((label[a], label[b]))[::-1]
                label = {k: new if v == old else v for k, v in label.items()}
    want = {k for k, v in label.items() if k == v}
    assert 30 < len(want) < 120
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in simhash_dedup.deduplicate(df).collect()} == want


def test_the_pipeline_stage_takes_candidates_from_simhash_classes(spark, monkeypatch):
    """Without any MinHash band, texts whose fingerprints link are still found; they are verified on their sets."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(5000)}" for _ in range(2000)]
    near = base[:-1] + ["other"]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(reversed(base)))]
    prints = [simhash_dedup.fingerprint(t.encode(), simhash_dedup.SET_SHINGLE) for _, t in rows]
    assert (prints[0] ^ prints[1]).bit_count() <= 4 < (prints[0] ^ prints[2]).bit_count()
    monkeypatch.setattr(simhash_dedup, "bands", lambda values: [])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in simhash_dedup.deduplicate(docs).collect()} == {1, 3}
    nodes = spark.createDataFrame([(n, fp, size) for n, fp, size in ((10, 0, 100), (11, 1, 90), (12, 3, 50), (13, -1, 100))],
                                  "node long, fp long, size long")
    assert [tuple(r) for r in simhash_dedup.simhash_pairs(nodes).collect()] == [(10, 11)]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


@pytest.mark.parametrize("task_links", [1_000_000, 40])
def test_components_of_random_links(spark, task_links):
    rng = random.Random(task_links)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(1000, 1000 + i) for i in range(1, 80)]
    parent = {x: x for pair in links for x in pair}
    for _ in range(400):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    edges = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r["node"]: r["label"] for r in graph.components(edges, task_links).collect()}
    assert got == {x: label for x, label in parent.items() if any(x in p and p[0] != p[1] for p in links)}
    assert graph.components(edges.limit(0)).count() == 0


def test_lattice_probability_against_enumeration():
    pieces = (("▁", -3), ("▁a", -1), ("a", -2), ("b", -2), ("ab", -4), ("▁ab", -5), ("ba", -6))
    lattices = lattice_lm.Lattices(pieces)
    p = np.array([0.1, 0.2, 0.1, 0.15, 0.2, 0.1, 0.1, 0.05])
    table = {piece: p[i] for i, (piece, _) in enumerate(pieces)}

    def paths(s):
        if not s:
            return [[]]
        out = [[x] + rest for x in table if s.startswith(x) for rest in paths(s[len(x):])]
        if s[0] not in table:
            out += [["?"] + rest for rest in paths(s[1:])]
        return out

    words = ["ab", "abab", "aécb", "b"]
    uses = Counter()
    for word, got in zip(words, lattices.forward(words, np.log(p))):
        weights = []
        for path in paths("▁" + word):
            unknown = [c for c in word if c not in "ab"]
            weights.append(math.prod(table.get(x, p[-1]) for x in path) / 256 ** len("".join(unknown).encode()))
        assert got == pytest.approx(math.log(sum(weights)))
        for path, weight in zip(paths("▁" + word), weights):
            for x in path:
                uses[x] += weight / sum(weights)
    expected = lattices.expected(words, np.ones(len(words)), np.log(p))
    for i, piece in enumerate([x for x, _ in pieces] + ["?"]):
        assert expected[i] == pytest.approx(uses[piece])


def test_language_model_base_and_held_out_scores(spark, tiny):
    df = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    rows = df.collect()
    train = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10]
    counts = Counter(w for r in train for w in r["text"].encode().lower().split())
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    texts = {r["doc_id"]: r["text"].encode().lower().split() for r in rows}
    wide, narrow = (({r["doc_id"]: r for r in lattice_lm.lm_scores(df, head_words=h).collect()}) for h in (10**6, 20))
    for i, words in texts.items():
        want = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[w] for w in words), len(train)])
        for got in (wide[i], narrow[i]):
            assert got["base_score"] == pytest.approx(want, rel=1e-9) and got["n_tokens"] == len(words) + 1
            assert got["n_known"] == sum(w in counts for w in words) + 1 and got["train_tokens"] == n
            assert got["score"] < 0 and got["score"] == pytest.approx(wide[i]["score"], rel=1e-9)


def test_toxicity_on_held_out_rows():
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(300)]

    def text(bad):
        words = [rng.choice(plain) for _ in range(60)]
        if bad:
            words[rng.randrange(60)] = "vile" + rng.choice("abcdefgh") + "ness"
        return " ".join(words).encode()

    labels = [i % 3 == 0 for i in range(600)]
    model = toxicity.fit([text(b) for b in labels], [int(b) for b in labels])
    scores = toxicity.Scorer(model).scores([text(i % 2 == 0) for i in range(200)])
    right = sum((s >= toxicity.THRESHOLD) == (i % 2 == 0) for i, s in enumerate(scores))
    assert right >= 190 and all(0 <= s <= 1 for s in scores)


def test_toxicity_of_a_text_does_not_depend_on_its_neighbours():
    rng = random.Random(6)
    texts = [b" ".join(rng.choice([b"a", b"b", b"c d", b"vileness", b"kind"]) for _ in range(rng.randint(0, 4)))
             for _ in range(300)] + [b"", b"vileness", b"", b"vileness x y"]
    model = toxicity.fit(texts, [int(b"vileness" in t) for t in texts])
    scorer = toxicity.Scorer(model)
    alone = [scorer.scores([t])[0] for t in texts]
    assert max(alone) - min(alone) > 0.5
    for size in (2, 7, len(texts)):
        together = [x for a in range(0, len(texts), size) for x in scorer.scores(texts[a:a + size])]
        assert np.allclose(together, alone, rtol=0, atol=1e-6)
    assert np.allclose(scorer.scores(texts[::-1])[::-1], alone, rtol=0, atol=1e-6)
    # by definition: every filter's best window, places after the text are empty words
    vector = lambda w: model.embed[toxicity.features(w)].sum(0)
    for text, got in zip(texts[-40:], alone[-40:]):
        words, pooled = toxicity.words_of(text), []
        for width, kernel in zip(toxicity.WIDTHS, model.kernel):
            windows = [sum(vector(w) @ kernel[j] for j, w in enumerate(words[i:i + width])) for i in range(len(words))]
            pooled.append(np.max([*windows, np.zeros(toxicity.FILTERS)], axis=0))
        odds = np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.weight + model.offset
        odds += model.shift[toxicity.language(words)]
        assert abs(1 / (1 + np.exp(-odds)) - got) < 1e-4


def _brute_spans(text):
    out = []
    for n, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), n, f"{rule.kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def test_toxicity_thresholds_are_from_all_labelled_rows(spark):
    rng = random.Random(8)
    words = {"en": "the of and to".split(), "fr": "le les et des".split()}
    rows = []
    for i in range(6000):
        bad = i % 10 == 0
        tongue = "fr" if i // 10 % 5 == 0 else "en"
        text = [rng.choice(words[tongue]) for _ in range(12)] + [f"n{rng.randrange(300)}" for _ in range(8)]
        text += ["vile" if rng.random() < (0.8 if bad else 0.1) else "kind" for _ in range(2)]
        rows.append((i, " ".join(text), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.drop("toxic"), df.drop("text"), sample=200)
    shift = dict(zip(toxicity.LANGUAGES, model.shift))
    assert shift["de"] == shift["es"] != shift["fr"]  # French has enough toxic rows in the table, not in the sample
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    hits = sum(got[i] >= toxicity.THRESHOLD for i, _, bad in rows if bad)
    wrong = sum(got[i] >= toxicity.THRESHOLD for i, _, bad in rows if not bad)
    assert hits > 200 and wrong < 600


def test_secrets_against_brute_force(spark):
    rng = random.Random(6)
    parts = ["token", "API_KEY", "api-key", "secret", " ", "=", ":", '"', "abcdef12", "AKIA", "A" * 18, "0123456789abcdef",
             "é梦", "\n", "ghp_", "x" * 40, "://u:p@", "eyJab.eyJcd.ef" + "g" * 30, "passwd", "Password",
             "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secret_scan.scan(df).collect():
        spans = _brute_spans(texts[r["doc_id"]])
        base = ",".join(s for s in spans.split(",") if s.split(":")[0] in ("assign", "access", "hex"))
        assert r["spans"] == spans and r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()


def test_trigram_queries_hold_for_matches():
    assert secret_scan.trigram_query("[0-9a-f]+") == []
    assert secret_scan.trigram_query("(abcd|xyz)q?") == [[frozenset({"abc", "bcd"}), frozenset({"xyz"})]]


def _histograms():
    rng = np.random.default_rng(1)
    spread = Counter(np.clip(rng.lognormal(5.5, 0.8, 20000).astype(int), 1, 1023).tolist())
    yield "spread", spread, 1.002
    yield "few", Counter(np.clip(rng.lognormal(5.5, 0.8, 1300).astype(int), 1, 1023).tolist()), 1.01
    yield "one hot length", Counter({300: 20000}), 1.001
    yield "tens", Counter((10 * rng.integers(1, 102, 20000)).tolist()), 1.005
    yield "three lengths", Counter({700: 5000, 333: 9000, 97: 3000}), 1.01
    yield "hot among others", spread + Counter({610: 10000}), 1.005
    yield "one piece", Counter({5: 1}), 200


@pytest.mark.parametrize("name, counts, within", list(_histograms()), ids=lambda x: x if isinstance(x, str) else "")
def test_sequences_come_from_the_program(name, counts, within):
    plan, own, bound = packing.plan_parts(dict(counts), 1024)
    held = Counter()
    for config, number in plan:
        assert number > 0 and sum(x * k for x, k in config.items()) <= 1024
        held.update({x: k * number for x, k in config.items()})
    assert held == counts
    total = sum(n for _, n in plan)
    assert own > 0.95 * total and bound <= total + 1e-6 and total <= math.ceil(bound) * within + 1
    assert bound >= sum(x * n for x, n in counts.items()) / 1024 - 1e-6


def test_no_lengths_need_no_sequences():
    assert packing.plan_sequences({}, 1024) == [] == packing.plan_sequences({7: 0}, 1024)


def test_packing_is_gapless_and_whole(spark, tiny):
    df = spark.read.parquet(f"{tiny}/documents.parquet").unionByName(
        spark.read.parquet(f"{tiny}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10**6))
    library = Tokenizer.from_file(packing.TOKENIZER)
    ids = {r["doc_id"]: np.array([*library.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
           for r in df.collect()}
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in packing.pack(df).collect():
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for places in by_sequence.values():
        upto = 0
        for offset, length in sorted(places):
            assert offset == upto
            upto += length
        assert upto <= 1024
    for i, want in ids.items():
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and sum(p["length"] for p in pieces) == len(want)
        for p in pieces:
            assert p["ids_crc32"] == zlib.crc32(want[p["start"]:p["start"] + p["length"]].tobytes())
        assert all(p["length"] == 1024 for p in pieces[1:])
    total = sum(map(len, ids.values()))
    assert len(by_sequence) <= 1.01 * total / 1024 + 2


def test_new_words_are_projected_a_few_at_a_time(monkeypatch):
    texts = [b"vileness and more" if i % 2 else b"quiet words only" for i in range(60)]
    model = toxicity.fit(texts, [i % 2 for i in range(60)])
    seen, projections = [], toxicity.Model.projections
    monkeypatch.setattr(toxicity.Model, "projections", lambda self, words: seen.append(len(words)) or projections(self, words))
    many = b" ".join(b"word%d" % i for i in range(30_000))
    scorer = toxicity.Scorer(model)
    assert scorer.scores([many, texts[1]])[1] == toxicity.Scorer(model).scores([texts[1]])[0]
    assert max(seen) <= 4096 and len(scorer.table) >= 30_001 and scorer.scores([many]) == scorer.scores([many])


def test_clean_sends_rows_as_they_are(spark, monkeypatch):
    """Rows go to Python once and come back unchanged, null texts and odd names included."""
    rows = [(i, None if i == 3 else "" if i == 4 else f"text {i}", i * 0.5, [i], f"t{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, row array<long>, t string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    asked, run = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a: asked.append(self.columns) or run(self, *a))
    assert sorted(map(tuple, toxicity.clean(docs, docs, labels).collect())) == sorted(rows)
    assert asked == [docs.columns]


def test_plan_holds_exactly_the_histogram():
    rng = random.Random(7)
    counts = dict(Counter(rng.randint(1, 1023) for _ in range(3000)))
    plan, held = packing.plan_sequences(dict(counts), 1024), Counter()
    for config, number in plan:
        assert sum(x * k for x, k in config.items()) <= 1024
        for x, k in config.items():
            held[x] += k * number
    assert held == counts and sum(n for _, n in plan) <= sum(n for _, n in packing.best_fit(counts, 1024))


def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", 70)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.2, 12).tolist()) for i in range(400)] + [(i, [0.1] * 12) for i in range(400, 520)]
    rows += [(600, None), (601, [None] + [0.1] * 11), (602, [float("nan")] * 12), (7, rows[7][1])]
    got = exact_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    good = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows[:520] + rows[-1:]]
    for q, vector in good[:520]:
        if q % 100 == 0:
            want = sorted((-int(vector @ v), i) for i, v in good if i != q)[:10]
            assert [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [
                (-s, i) for s, i in want]


def test_warc_records_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a.example/x", '<html lang="de"><head><title>A &amp; B</title><script>var t="</p>";</script></head>'
          '<body><p>Eins</p><!-- no --><a href="/y">zwei</a> drei &lt;</body></html>'), (2, None, None), (2, None, None)],
        "page_id long, url string, html string")
    records = warc.derivatives(pages).collect()
    assert len(records) == 6 and warc.derivatives(pages.limit(0)).count() == 0
    text = next(r for r in records if r["page_id"] == 1 and r["record_type"] == "conversion")
    assert text["block"] == "Eins\nzwei drei <" and text["block_digest"] == warc.digest(text["block"].encode())
    meta = next(r for r in records if r["page_id"] == 1 and r["record_type"] == "metadata")
    assert "title: A & B\r\n" in meta["block"] and "outlink: http://a.example/y\r\n" in meta["block"]
    assert meta["refers_to"] == text["refers_to"] and "source-header: HTTP/1.1 200 OK" in meta["block"]
    warc.write(warc.derivatives(pages), str(tmp_path / "out"))
    found = 0
    for path in (tmp_path / "out").glob("*.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert warc.digest(rest[:size]).encode() in head and rest[size:size + 4] == b"\r\n\r\n"
            data, found = rest[size + 4:], found + 1
    assert found == 6


_HIDDEN = r"<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>"
_MARKUP = re.compile(rf"<!--.*?-->|{_HIDDEN}|<title\b[^>]*>.*?</title\s*>"
                     r"""|<[!/?a-z](?:[^"'>]|"[^"]*"|'[^']*')*>""", re.I | re.S)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.I | re.S)
_LANG = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
_CHARSET = re.compile(r"""<meta\b[^>]*?\bcharset\s*=\s*["']?([A-Za-z0-9_-]+)""", re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)


def _same_as_patterns(page):
    """The forward pass against plain (quadratic) patterns that define the markup."""
    marked = warc.Page(page)
    assert marked.text() == _MARKUP.sub(lambda m: "\n" if warc._BLOCK.match(m[0]) else "", page), page
    first = lambda pattern: (m := pattern.search(page)) and m[1]
    assert marked.title() == first(_TITLE) and marked.attribute(warc._HTML, warc._LANG) == first(_LANG), page
    assert marked.attribute(warc._META, warc._CHARSET) == first(_CHARSET), page
    assert marked.links() == [next((g for g in m if g), "") for m in _LINK.findall(page)], page


def test_markup_by_patterns(spark, small):
    rng = random.Random(9)
    parts = ["<!--", "-->", "<script", "</script", "<title", "</title >", "<a ", "href", "=", '"', "'", ">", "<", "x", " ", "\n",
             "<p>", "</style>", "<style>", "<html ", "lang", "<meta ", "charset", "utf-8", "</SCRIPT>", "<br/>", "<A HREF=y>"]
    for _ in range(20_000):
        _same_as_patterns("".join(rng.choice(parts) for _ in range(rng.randint(0, 14))))
    for row in spark.read.parquet(f"{small}/pages.parquet").select("html").collect():
        _same_as_patterns(row[0] or "")


@pytest.mark.parametrize("part", ["<!--", "<script>", '<a "', "<title>", "<a href=\"", "<html lang", "<meta charset", "<a href='x",
                                  "< ", "<p ", "</script ", "<a href=", "\n ", "&amp"])
def test_broken_pages_take_time_in_proportion(part):
    page = part * (2_000_000 // len(part))
    start = time.time()
    warc.plain_text(page)
    warc.page_fields(page, "http://a.example/")
    assert time.time() - start < 6


def test_pipeline_stages(spark, docs, tiny):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality rules", "near duplicates", "secrets", "packing"]
    rows = corpus_pipeline.run(spark, tiny)
    before = {r["doc_id"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows.select("doc_id").distinct().collect()} <= before and rows.count() > 0
    assert sorted(queries.QUERIES, key=lambda n: int(re.match(r"op(\d+)", n)[1]))[0].startswith("op1_")
