"""Connected components of a link table: forests inside tasks, then alternating large and small stars between them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from telemetry_ops.llm.common import written

TASK_LINKS = 250_000  # links of a task, about; a table of up to so many links is one partition


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them (``u > v`` in every edge)."""
    joined = edges.join(_least(edges), "u")
    links = joined.select("v", "m").where("v > m").union(joined.select("u", "m"))
    return links.toDF("u", "v").distinct()


def _forest(batches):
    """The links of one task as stars: every node but the least of its component in the task, with that least node."""
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())],
                                     names=["u", "v"])


def components(edges: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, label) for every node that has a link; ``label`` is the least node of its component.

    ``edges`` has two columns of long ids, in any order. The links, once each, are dealt to as many tasks as their number asks
    for, and each task turns its own into stars. With several tasks, star rounds between them follow, each written to shared
    storage, until a round changes nothing; no node's neighbours are ever gathered, only their minimum.
    """
    a, b = edges.columns
    links = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links")
    tasks = max(1, -(-links.count() // task_links))

    def round_of(pairs):
        seen = Observation()
        stars = pairs.coalesce(tasks).mapInArrow(_forest, "u long, v long").observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("x"))
        return written(stars, "links"), seen

    state, before = round_of(links)
    while tasks > 1:
        state, now = round_of(_small_star(_large_star(state)))
        if now.get == before.get:
            break
        before = now
    return state.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
