"""What the stages of the pipeline move between tasks."""

import random
import re

import numpy as np
import pytest

from pyspark import RDD

from telemetry_ops.llm import quality_rules, simhash_dedup, toxicity


@pytest.fixture
def no_small_sides(spark):
    """Sizes count for nothing, as in a large run: Spark broadcasts what is marked for it only."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def _pages(spark):
    rows = [(i, f"the menu of this site\nown words of page {i} that stand here only today\n" + ("A  Footer" if i % 2 else ""),
             None if i % 3 == 0 else "h") for i in range(90)]
    rows += [(100, None, "h"), (101, "", None), (102, "the menu of this site", "alone"), (102, "the menu of this site", "alone")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_lines_are_removed_where_the_texts_are(spark, no_small_sides):
    cleaned = quality_rules.clean(_pages(spark))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert cleaned.count() == 90 and cleaned.where("text LIKE '%menu%' OR text LIKE '%Footer%'").count() == 0


def test_removal_is_the_same_with_more_lines_than_may_be_sent(spark, monkeypatch):
    docs = _pages(spark)
    sent = [sorted(map(str, run(docs).collect())) for run in (quality_rules.clean, quality_rules.quality_rules)]
    monkeypatch.setattr(quality_rules, "BROADCAST_ITEMS", 0)
    assert sent == [sorted(map(str, run(docs).collect())) for run in (quality_rules.clean, quality_rules.quality_rules)]


def test_bits_never_say_less_than_sets_share():
    rng = np.random.default_rng(3)
    for size in (0, 1, 15, 16, 17, 200, 255, 256, 257, 3000):
        for share in (0, 0.5, 0.9, 1):
            a = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
            b = np.union1d(a[:int(share * len(a))], rng.integers(0, 1 << 64, size // 5 + 1, np.uint64))
            common = len(np.intersect1d(a, b))
            most = simhash_dedup.most_common(simhash_dedup.bit_set(a), len(a), simhash_dedup.bit_set(b), len(b))
            assert common <= most <= min(len(a), len(b))
            assert most <= common + 0.25 * max(len(a), len(b)) + 1


def test_sets_are_sent_for_likely_pairs_only(spark, monkeypatch):
    """A group of texts that share half their shingles: many candidates, few that may be similar."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = [(i, " ".join(base[:100] + [f"x{rng.randrange(10**6)}" for _ in range(100)])) for i in range(40)]
    rows.append((40, rows[7][1] + " end"))
    monkeypatch.setattr(simhash_dedup, "bands", lambda values: [1])
    counted, write = {}, simhash_dedup.written

    def seen(df, name="table", keep=False):
        out = write(df, name, keep)
        counted.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(simhash_dedup, "written", seen)
    got = simhash_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in got.collect()} == set(range(40))
    assert sum(counted["pairs"]) > 500 and 1 <= sum(counted["likely"]) <= 5


@pytest.mark.parametrize("run", [simhash_dedup.near_duplicates, simhash_dedup.deduplicate])
def test_members_of_buckets_are_never_broadcast(spark, monkeypatch, run):
    """Spark sizes 64 keys of a fingerprint as one row, and a list as one entry, so all these sides look small."""
    plans, join = [], simhash_dedup.components

    def seen(edges, *more):
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return join(edges, *more)

    monkeypatch.setattr(simhash_dedup, "components", seen)
    docs = spark.createDataFrame([(i, f"some words of text number {i // 2} and no more than that") for i in range(40)],
                                 "doc_id long, text string")
    assert run(docs).select("doc_id").distinct().count() == (20 if run is simhash_dedup.deduplicate else 40)
    links = [p for p in plans if "Join" in p]
    assert links and not [x for p in links for x in re.findall(r"Broadcast\w+Join \[(?:key|a|b)#.*Inner", p)]


@pytest.mark.parametrize("kind", ["int", "long", "string"])
def test_thresholds_need_no_second_pool_of_workers(spark, monkeypatch, kind):
    """Rows of the driver that Spark pickles go through Python workers of their own, which stay."""
    rows = [(str(i) if kind == "string" else i, "vile filth text" if i % 2 else "calm good text", i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string, toxic int").localCheckpoint()
    monkeypatch.setattr(RDD, "_to_java_object_rdd", lambda self: pytest.fail("rows were pickled"))
    got = toxicity.classify(docs, docs.select("doc_id", "toxic")).collect()
    assert {str(r["doc_id"]): r["predicted"] for r in got} == {str(k): y for k, _, y in rows}
