import itertools
import math
import pathlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telemetry_ops import scratch
from telemetry_ops.config import TrainConfig
from telemetry_ops.operators import explain as ex, train
from telemetry_ops.sources import telemetry as t

COLUMNS = ["torque_Nm", "tool_wear_min", "network_latency_ms", "vibration_mm_s", "pressure_psi"]
QUICK = TrainConfig(folds=2, max_trees=6, max_depth=3, step_size=0.3)


def _tree():
    """x0 <= 0.5 ? (x1 <= 0.3 ? 1 : 5) : (x0 <= 0.8 ? 2 : (x2 <= 0.5 ? -3 : 7)) with given covers."""
    nodes = [  # id, left, right, feature, threshold, prediction, cover
        (0, 1, 2, 0, 0.5, 0.0, 100), (1, 3, 4, 1, 0.3, 0.0, 60), (2, 5, 6, 0, 0.8, 0.0, 40), (3, -1, -1, -1, 0, 1.0, 25),
        (4, -1, -1, -1, 0, 5.0, 35), (5, -1, -1, -1, 0, 2.0, 10), (6, 7, 8, 2, 0.5, 0.0, 30),
        (7, -1, -1, -1, 0, -3.0, 12), (8, -1, -1, -1, 0, 7.0, 18)]
    return pd.DataFrame([{"id": i, "leftChild": a, "rightChild": b, "prediction": p, "rawCount": c,
                          "split": {"featureIndex": f, "leftCategoriesOrThreshold": [th]}}
                         for i, a, b, f, th, p, c in nodes]).set_index("id")


def _expected(tree, x, known, node=0):
    row = tree.loc[node]
    if row["leftChild"] < 0:
        return row["prediction"]
    f, th = row["split"]["featureIndex"], row["split"]["leftCategoriesOrThreshold"][0]
    left, right = row["leftChild"], row["rightChild"]
    if f in known:
        return _expected(tree, x, known, left if x[f] <= th else right)
    return sum(tree.loc[c]["rawCount"] / row["rawCount"] * _expected(tree, x, known, c) for c in (left, right))


def test_matches_brute_force_shapley():
    tree = _tree()
    leaves = [ex.as_tree(tree)]
    assert leaves[0].mean() == pytest.approx(_expected(tree, [0, 0, 0], set()))
    for x in itertools.product((0.2, 0.6, 0.9), (0.1, 0.9), (0.2, 0.7)):
        phi = ex.shapley_matrix(leaves, np.array([x]))[0]
        for j in range(3):
            others = [i for i in range(3) if i != j]
            want = sum(math.factorial(n) * math.factorial(2 - n) / 6
                       * (_expected(tree, x, {*s, j}) - _expected(tree, x, set(s)))
                       for n in range(3) for s in itertools.combinations(others, n))
            assert phi[j] == pytest.approx(want)


def _random_tree(rng, depth, features):
    """A full tree whose paths use features again and again."""
    nodes, cover = [], {0: 2.0 ** depth * 50}
    for i in range(2 ** (depth + 1) - 1):
        inner = i < 2 ** depth - 1 and cover[i] > 2
        left, right = (2 * i + 1, 2 * i + 2) if inner else (-1, -1)
        if inner:
            share = rng.uniform(0.2, 0.8)
            cover[left], cover[right] = cover[i] * share, cover[i] * (1 - share)
        if i in cover:
            nodes.append({"id": i, "leftChild": left, "rightChild": right, "prediction": rng.normal(), "rawCount": cover[i],
                          "split": {"featureIndex": int(rng.integers(features)),
                                    "leftCategoriesOrThreshold": [float(rng.uniform())]}})
        else:
            cover[left], cover[right] = 0, 0
    return pd.DataFrame(nodes).set_index("id")


@pytest.mark.parametrize("depth, features", [(1, 2), (4, 3), (5, 6), (10, 5)])
def test_deep_trees_match_brute_force_shapley(depth, features):
    rng = np.random.default_rng(depth)
    nodes = _random_tree(rng, depth, features)
    tree = ex.as_tree(nodes)
    rows = rng.uniform(size=(3, features))
    phi = ex.shapley_matrix([tree], rows, rows=2)
    for x, got in zip(rows, phi):
        value = {s: _expected(nodes, x, set(s)) for n in range(features + 1)
                 for s in itertools.combinations(range(features), n)}
        for j in range(features):
            want = sum(math.factorial(len(s)) * math.factorial(features - 1 - len(s)) / math.factorial(features)
                       * (value[tuple(sorted({*s, j}))] - value[s]) for s in value if j not in s)
            assert got[j] == pytest.approx(want, abs=1e-9)
        assert got.sum() + tree.mean() == pytest.approx(tree.leaf_values(x[None])[0])


def _average_precision(labels, scores):
    total, hits, seen = 0.0, 0, 0
    for score in sorted(set(scores), reverse=True):
        here = [y for y, s in zip(labels, scores) if s == score]
        hits, seen = hits + sum(here), seen + len(here)
        total += sum(here) / sum(labels) * hits / seen
    return total


def test_stopping_keeps_the_prefix_that_ranks_best(spark, tiny):
    df = train.with_vector(t.system(spark, tiny), COLUMNS).select("event_id", "machine_failure", "features")
    valid = df.where("event_id % 3 = 0")
    whole = train.fit_boosted(df.where("event_id % 3 <> 0"), "machine_failure", QUICK)
    got = {r["trees"]: r["average_precision"] for r in train.prefix_precision(
        train.staged_margins(whole, valid, ["machine_failure"]), "machine_failure").collect()}
    want = {}
    for k in range(1, whole.getNumTrees + 1):  # prefix by prefix
        cut = train.cut_to(whole, k)
        assert cut.getNumTrees == k
        rows = train.score(cut, valid).select("machine_failure", "score").collect()
        want[k] = _average_precision([r[0] for r in rows], [round(r[1], 12) for r in rows])
    assert got == pytest.approx(want)
    best = train.fit_boosted(df.where("event_id % 3 <> 0"), "machine_failure", QUICK, valid)
    assert best.getNumTrees == min(k for k in want if want[k] == max(want.values()))
    none = valid.where("machine_failure = 0")
    assert train.best_prefix(whole, none, "machine_failure").getNumTrees == whole.getNumTrees


def test_contributions_add_up_to_the_margin(spark, tiny):
    system = t.system(spark, tiny)
    df = train.with_vector(system, COLUMNS)
    model = train.fit_boosted(df, "machine_failure", QUICK)
    scores = {r["event_id"]: r["score"] for r in train.score(model, df).select("event_id", "score").collect()}
    rows = ex.contributions(model, system, COLUMNS, keep=["event_id"]).collect()
    assert len(rows) == 1000
    for r in rows:
        assert [c["feature"] for c in r["contributions"]] == COLUMNS
        margin = r["base_value"] + sum(c["contribution"] for c in r["contributions"])
        assert 1 / (1 + math.exp(-2 * margin)) == pytest.approx(scores[r["event_id"]], abs=1e-9)


def test_cross_validation_scores_every_row_once(spark, tiny):
    df = t.system(spark, tiny)
    scored, trees = train.cross_validate(df, "machine_failure", "event_id", COLUMNS, QUICK)
    ids = [r["event_id"] for r in scored.select("event_id").collect()]
    assert len(ids) == len(set(ids)) == 1000 and len(trees) == 2 and all(1 <= n <= 6 for n in trees)
    summary = train.cv_summary(scored, "machine_failure", trees).collect()
    assert len(summary) == 2 and all(0 <= r["average_precision"] <= 1 for r in summary)
    assert {r["fold"]: r["trees"] for r in summary} == dict(enumerate(trees))
    model = train.refit(df, "machine_failure", "event_id", COLUMNS, trees, QUICK)
    assert model.getNumTrees == int(np.median(trees))


def test_folds_dealt_before_are_used_and_only_the_input_stays_written(spark, tiny):
    """Wide rows are neither ordered nor copied per fold: the table of vectors is all that cross-validation leaves."""
    folder = scratch.shared_folder(spark)
    names = lambda: {p.parent.name for p in pathlib.Path(folder).glob("*/*/_SUCCESS")}
    df = train.stratified_folds(t.system(spark, tiny), "machine_failure", "event_id", QUICK.folds, QUICK.seed)
    dealt = {r["event_id"]: r["fold"] for r in df.select("event_id", "fold").collect()}
    before = names()
    scored, _ = train.cross_validate(df, "machine_failure", "event_id", COLUMNS, QUICK, "fold")
    left = names() - before
    assert len(left) == 1 and left.pop().startswith("folds-")
    assert {r["event_id"]: r["fold"] for r in scored.collect()} == dealt


def test_folds_are_balanced(spark, tiny):
    folds = train.stratified_folds(t.system(spark, tiny), "machine_failure", "event_id", 5)
    counts = folds.groupBy("machine_failure", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r["machine_failure"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_sampled_importance_uses_whole_rows(spark, tiny):
    long = t.contributions_long(spark, tiny)
    assert ex.global_importance(long, "row_id", sample=10).count() == 4


def test_the_longest_bar_is_whole_when_means_are_summed_anew(spark):
    """Every evaluation of the table gives other last digits, as sums in another order do."""
    drawn = F.udf(lambda i: 1.0 + i + random.random() * 1e-9, "double").asNondeterministic()
    importance = spark.range(6, numPartitions=3).select(F.concat(F.lit("f"), "id").alias("feature"), drawn("id").alias("importance"))
    for _ in range(4):
        rows = ex.top_features(importance, n=4).collect()
        assert [r["feature"] for r in rows] == ["f5", "f4", "f3", "f2"] and rows[0]["bar"] == 30
