import random

import pytest
from pyspark.sql import Window, functions as F

from telemetry_ops.operators import scan


@pytest.fixture(scope="module")
def skewed(spark):
    """One time stamp holds a third of the rows, one key half of them."""
    random.seed(1)
    rows = [(i, "hot" if i % 2 else f"k{i % 7}", 50 if i % 3 == 0 else random.randrange(200), float(i % 13))
            for i in range(3000)]
    return spark.createDataFrame(rows, "id long, key string, t int, v double")


def test_positions_follow_the_total_order(skewed):
    got = {r["id"]: r["pos"] for r in scan.positions(skewed, ["t", "id"]).collect()}
    want = {r["id"]: i for i, r in enumerate(sorted(skewed.collect(), key=lambda r: (r["t"], r["id"])))}
    assert got == want


def test_positions_split_a_hot_value(skewed):
    placed = scan.positions(skewed, ["key", "t", "id"], partitions=8)
    parts = placed.groupBy(scan.block_of("pos", 400)).count().collect()
    assert max(r["count"] for r in parts) == 400


def test_running_totals(skewed):
    placed = scan.positions(skewed, ["t", "id"])
    got = scan.running(placed, "pos", sums={"total": "v"}, lasts={"latest": "v"}, block_rows=97).collect()
    total = 0.0
    for r in sorted(got, key=lambda r: r["pos"]):
        total += r["v"]
        assert r["total"] == total and r["latest"] == r["v"]


def test_running_last_skips_nulls_across_blocks(spark):
    rows = [(i, 1.0 * i if i in (2, 30) else None) for i in range(50)]
    got = scan.running(spark.createDataFrame(rows, "pos long, v double"), "pos", lasts={"f": "v"}, block_rows=5)
    filled = {r["pos"]: r["f"] for r in got.collect()}
    assert filled[1] is None and filled[2] == 2.0 and filled[29] == 2.0 and filled[49] == 30.0


def test_halo_equals_the_plain_window(skewed):
    placed = scan.positions(skewed, ["key", "t", "id"])
    whole = Window.partitionBy("key").orderBy("pos").rowsBetween(-9, 0)
    block = Window.partitionBy("_block", "key").orderBy("pos").rowsBetween(-9, 0)
    want = {r["id"]: r["m"] for r in placed.select("id", F.sum("v").over(whole).alias("m")).collect()}
    cut = scan.halo(placed, "pos", 9, 40).select("id", "_ghost", F.sum("v").over(block).alias("m")).where("NOT _ghost")
    assert {r["id"]: r["m"] for r in cut.collect()} == want
    with pytest.raises(ValueError):
        scan.halo(placed, "pos", 41, 40)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_percentiles_both_ways(skewed, limit):
    ps = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}
    got = scan.exact_percentiles(skewed, "key", "t", ps, max_distinct=limit).collect()
    want = {r["key"]: r for r in skewed.groupBy("key").agg(
        *[F.percentile("t", p).alias(n) for n, p in ps.items()]).collect()}
    assert len(got) == len(want)
    for r in got:
        assert all(abs(r[n] - want[r["key"]][n]) < 1e-9 for n in ps)
    whole = scan.exact_percentiles(skewed, [], "t", {"m": 0.5}, max_distinct=limit).collect()
    assert whole[0]["m"] == skewed.agg(F.percentile("t", 0.5)).first()[0]


def test_chunks_have_the_asked_size(skewed):
    sizes = scan.chunk_ids(skewed, "t", "id", 700).groupBy("chunk_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [200, 700, 700, 700, 700]
