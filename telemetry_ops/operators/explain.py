"""Additive contributions of each feature to a boosted-tree score, and their summaries.

Contributions are path-dependent Shapley values of the trees (Lundberg et al., "Consistent individualized feature
attribution for tree ensembles"). They add up, with the base value, to the raw margin; the probability is
``1 / (1 + exp(-2 margin))``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetry_ops.config import FEATURE_GROUPS
from telemetry_ops.functions import lcg
from telemetry_ops.scratch import new_path

CONTRIBUTIONS = "array<struct<feature: string, value: double, contribution: double>>"


def tree_table(spark, model):
    """Nodes of every tree from the saved model: at most trees x 2^(depth + 1) rows, so it fits on the driver."""
    path = new_path(spark, "model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()
    return [t.set_index("id") for _, t in nodes.sort_values(["treeID", "id"]).groupby("treeID")]


@dataclass
class Tree:
    """One tree as arrays by node; ``left`` is -1 in leaves, ``share`` the part of its parent's rows a node has."""

    left: list
    right: list
    feature: list
    threshold: list
    share: list
    value: list

    def leaf_values(self, x: np.ndarray) -> np.ndarray:
        """What the tree adds to the margin of every row."""
        left, right, feature, threshold = (np.array(v) for v in (self.left, self.right, self.feature, self.threshold))
        at = np.zeros(len(x), np.int64)
        rows = np.flatnonzero(left[at] >= 0)
        while len(rows):
            here = at[rows]
            at[rows] = np.where(x[rows, feature[here]] <= threshold[here], left[here], right[here])
            rows = rows[left[at[rows]] >= 0]
        return np.array(self.value)[at]

    def mean(self) -> float:
        """The value a row is expected to get when nothing is known of it."""
        def below(node):
            if self.left[node] < 0:
                return self.value[node]
            return sum(self.share[c] * below(c) for c in (self.left[node], self.right[node]))
        return below(0)

    def depth(self) -> int:
        def below(node):
            return 0 if self.left[node] < 0 else 1 + max(below(self.left[node]), below(self.right[node]))
        return below(0)


def as_tree(nodes, weight: float = 1.0) -> Tree:
    """A tree from a table of Spark ML nodes, indexed by node id."""
    number = {node: i for i, node in enumerate(nodes.index)}
    out = Tree(*([] for _ in range(6)))
    share = {0: 1.0}
    for node, row in nodes.iterrows():
        inner = row["leftChild"] >= 0
        if inner:
            for child in (row["leftChild"], row["rightChild"]):
                share[child] = nodes.at[child, "rawCount"] / row["rawCount"]
        split = row["split"]
        out.left.append(number[row["leftChild"]] if inner else -1)
        out.right.append(number[row["rightChild"]] if inner else -1)
        out.feature.append(split["featureIndex"] if inner else 0)
        out.threshold.append(split["leftCategoriesOrThreshold"][0] if inner else 0.0)
        out.value.append(0.0 if inner else row["prediction"] * weight)
    out.share = [share[node] for node in nodes.index]
    return out


def trees_of(spark, model) -> list[Tree]:
    """The weighted trees of a fitted boosted-tree model."""
    return [as_tree(nodes, weight) for nodes, weight in zip(tree_table(spark, model), model.treeWeights)]


def _add_tree(tree: Tree, x: np.ndarray, total: np.ndarray) -> None:
    """Add a tree's contributions to ``total``; the work grows with nodes times depth, not with subsets of features.

    A leaf reached by features with shares z, of which a row meets those with hit = 1, gives feature j
    value (hit_j - z_j) times the integral over t in [0, 1] of the product over its other features of
    (t hit + (1 - t) z): the Shapley weights are moments of t. The product is a polynomial, so Gauss-Legendre points,
    half as many as the tree is deep, integrate it exactly. Going down, a node's product is extended by its feature's factor (one
    that came earlier on the path is divided out first); going up, the leaf sums of each branch are unwound by that factor.
    """
    points, weights = np.polynomial.legendre.leggauss(max(1, (tree.depth() + 1) // 2))
    t, w = (points + 1) / 2, weights / 2

    def factors(z):
        hit, miss = t + (1 - t) * z, (1 - t) * z
        return hit, miss, w * (1 - z) / hit, -w / (1 - t)

    def pick(hit, yes, no):
        return np.where(hit[:, None], yes, no)

    def gained(hit, below, known):
        return np.where(hit, below @ known[2], below @ known[3])

    def walk(node, product, path):
        if tree.left[node] < 0:
            return tree.value[node] * product
        feature, sums = tree.feature[node], 0.0
        goes_left = x[:, feature] <= tree.threshold[node]
        for child, hit in ((tree.left[node], goes_left), (tree.right[node], ~goes_left)):
            before = path.get(feature)
            z = tree.share[child]
            extended = product
            if before:
                hit, z = hit & before[0], z * before[1]
                extended = extended / pick(before[0], *before[2][:2])
            known = factors(z)
            below = walk(child, extended * pick(hit, *known[:2]), {**path, feature: (hit, z, known)})
            total[:, feature] += gained(hit, below, known)
            if before:
                total[:, feature] -= gained(before[0], below, before[2])
            sums = sums + below
        return sums

    walk(0, np.ones((len(x), len(t))), {})


def shapley_matrix(trees: list[Tree], x: np.ndarray, rows: int = 2048) -> np.ndarray:
    """Contributions of a matrix of rows, shape (rows, features)."""
    total = np.zeros(x.shape)
    for start in range(0, len(x), rows):
        for tree in trees:
            _add_tree(tree, x[start:start + rows], total[start:start + rows])
    return total


def contributions(model, df: DataFrame, columns, keep=()) -> DataFrame:
    """Per row the contribution of every feature, as ``contributions``; ``base_value`` is the same for all rows.

    ``df`` has the plain feature columns; missing values count as 0, as in scoring. The nodes are broadcast: at most
    2^(depth + 1) a tree, whatever the data.
    """
    spark, columns, keep = df.sparkSession, list(columns), list(keep)
    trees = trees_of(spark, model)
    base = sum(tree.mean() for tree in trees)
    shared = spark.sparkContext.broadcast(trees)
    data = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in columns])

    def explain(batches):
        for batch in batches:
            x = np.column_stack([batch.column(f"_x_{c}").to_numpy(zero_copy_only=False) for c in columns])
            phi = shapley_matrix(shared.value, x)
            n = len(x)
            arrays = [batch.column(c) for c in keep] + [pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1) * len(columns), pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(np.tile(np.array(columns, dtype=object), n), pa.string()), pa.array(x.ravel()),
                     pa.array(phi.ravel())], ["feature", "value", "contribution"]))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "contributions"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields if f.name in keep)
    schema = ", ".join(s for s in (kept, f"contributions {CONTRIBUTIONS}") if s)
    return data.mapInArrow(explain, schema).withColumn("base_value", F.lit(float(base)))


def contribution_array(df: DataFrame, columns: dict, values: dict | None = None) -> Column:
    """Array of contributions from wide columns: ``columns`` maps feature names to contribution expressions."""
    values = values or {}
    return F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(values.get(f, f)).cast("double").alias("value")
                 if values.get(f, f) in df.columns else F.lit(None).cast("double").alias("value"),
                 (F.expr(c) if isinstance(c, str) else c).cast("double").alias("contribution"))
        for f, c in columns.items()])


def top_contributors(column="contributions", n: int = 10) -> Column:
    """The ``n`` largest by magnitude (ties keep their order), each with the direction of its effect."""
    c = F.col(column) if isinstance(column, str) else column
    numbered = F.transform(c, lambda x, i: F.struct(
        (-F.abs(x["contribution"])).alias("size"), i.alias("i"), x.alias("x")))
    return F.transform(F.slice(F.sort_array(numbered), 1, n), lambda s: F.struct(  # array_sort compares by a lambda
        s["x"]["feature"].alias("feature"), s["x"]["value"].alias("value"),
        s["x"]["contribution"].alias("contribution"),
        F.when(s["x"]["contribution"] > 0, "increases_risk").otherwise("decreases_risk").alias("direction")))


def group_impacts(column="contributions", groups: dict | None = None, known=()) -> Column:
    """Map of domain to summed contribution; a feature counts for every group whose base name it contains, once each.

    ``known`` names features that are likely: they are looked up in sets, other names are searched row by row.
    """
    groups, known = groups or FEATURE_GROUPS, list(known)
    c = F.col(column) if isinstance(column, str) else column

    def member(feature, names):
        pattern = "|".join(names)
        inside = [k for k in known if re.search(pattern, k)]
        found = feature.rlike(pattern) if len(inside) == len(known) else ~feature.isin(known) & feature.rlike(pattern)
        return feature.isin(inside) | found if inside else found

    def total(names):
        return F.aggregate(F.filter(c, lambda x: member(x["feature"], names)), F.lit(0.0),
                           lambda a, x: a + x["contribution"])

    return F.create_map(*[v for g, names in groups.items() for v in (F.lit(g), total(names))])


def group_impacts_long(long: DataFrame, row: str, groups: dict | None = None) -> DataFrame:
    """As :func:`group_impacts` for one row per (row, feature): the few distinct groups are attached per feature."""
    groups = groups or FEATURE_GROUPS
    member = F.array_compact(F.array(*[F.when(F.col("feature").rlike("|".join(n)), F.lit(g))
                                       for g, n in groups.items()]))
    return (long.select(row, "contribution", F.explode(member).alias("domain"))
            .groupBy(row, "domain").agg(F.sum("contribution").alias("impact")))


def global_importance(long: DataFrame, rid: str | None = None, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Mean magnitude per feature, ranked. ``sample`` limits it to that many rows, drawn by row id; default all."""
    if sample is not None:
        drawn = long.select(rid).distinct().orderBy(lcg(rid, seed), rid).limit(sample)
        long = long.join(drawn, rid, "left_semi")
    return (long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))


def top_features(importance: DataFrame, n: int = 15, width: int = 30) -> DataFrame:
    """The ``n`` most important features with a bar length relative to the first."""
    top = importance.orderBy(F.desc("importance"), "feature").limit(n)
    # of the same rows: means summed anew may differ in the last bit, and the longest bar would fall short
    best = F.max("importance").over(Window.partitionBy())  # n rows
    return top.withColumn("bar", F.floor(F.col("importance") / best * width).cast("int")).orderBy(F.desc("importance"), "feature")
