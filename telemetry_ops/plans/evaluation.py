"""Threshold evaluation queries."""

from __future__ import annotations

from telemetry_ops.operators import evaluate as e, train
from telemetry_ops.plans.common import r, rounded, sql
from telemetry_ops.plans.learning import FOLDS_SQL
from telemetry_ops.sources import telemetry as t


def _curve(spark, d):
    return e.pr_curve(t.scores(spark, d), "score", "y")


def _pr_curve(spark, d):
    return rounded(_curve(spark, d).drop("positives"))


def _average_precision(spark, d):
    return rounded(e.average_precision(_curve(spark, d)))


def _thresholds(spark, d):
    # at this score/label relation 90 % precision is out of reach, so a reachable limit is asked for beside it
    return rounded(e.thresholds(_curve(spark, d)))


def _thresholds_reached(spark, d):
    return rounded(e.thresholds(_curve(spark, d), min_precision=0.2, min_recall=0.5))


def _cost_sweep(spark, d):
    return rounded(e.cost_sweep(_curve(spark, d)))


def _best_points(spark, d):
    return rounded(e.best_operating_points(e.cost_sweep(_curve(spark, d))))


def _optimum(spark, d):
    return rounded(e.cost_optimum(e.cost_sweep(_curve(spark, d), points=None)))


def _confusion(spark, d):
    return rounded(e.confusion(t.scores(spark, d), "score", "y", 0.5))


def _benchmark(spark, d):
    return rounded(e.compare_benchmark(e.confusion(t.scores(spark, d), "score", "y", 0.5)))


def _folds(spark, d):
    return train.stratified_folds(t.scores(spark, d), "y", "event_id")


def _per_fold(spark, d):
    return rounded(e.per_fold(_folds(spark, d), "fold", "score", "y"))


def _fold_metrics(spark, d):
    return rounded(e.fold_metrics(_folds(spark, d), "fold", "score", "y"))


def _summary(spark, d):
    return rounded(e.evaluation_summary(t.scores(spark, d), "score", "y"))


_C = {
    "g": "SELECT score, sum(y) AS tp1, sum(1 - y) AS fp1 FROM fx_scores GROUP BY score",
    "c0": "SELECT score AS threshold, sum(tp1) OVER w AS tp, sum(fp1) OVER w AS fp, sum(tp1) OVER () AS p, "
          "sum(fp1) OVER () AS n, row_number() OVER (ORDER BY score) - 1 AS rank, tp1, count(*) OVER () AS k FROM g "
          "WINDOW w AS (ORDER BY score DESC)",
    "c": "SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, (p - tp)::BIGINT AS fn, (n - fp)::BIGINT AS tn, "
         "tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / p AS recall, rank, tp1::DOUBLE / p AS gain, k, "
         "2 * (tp::DOUBLE / (tp + fp)) * (tp::DOUBLE / p) / (tp::DOUBLE / (tp + fp) + tp::DOUBLE / p + 1e-8) AS f1 "
         "FROM c0",
}
_COSTS = "SELECT *, fp * 500 + fn * 5000 AS cost, (tp + fn) * 5000 - (fp * 500 + fn * 5000) AS savings FROM c"
_SWEEP = _COSTS + " WHERE rank % greatest(k // 50, 1) = 0"


def _modes(precision, recall):
    best = "ORDER BY f1 DESC, rank LIMIT 1"
    return (
        "SELECT 'ultra_safe' AS mode, * FROM (SELECT * FROM c ORDER BY CASE WHEN precision >= {p} THEN 0 ELSE 1 END, "
        "CASE WHEN precision >= {p} THEN 0 ELSE -precision END, rank LIMIT 1) UNION ALL "
        "SELECT 'sensitive' AS mode, * FROM (SELECT * FROM c ORDER BY CASE WHEN recall >= {q} THEN 0 ELSE 1 END, "
        "CASE WHEN recall >= {q} THEN -rank ELSE rank END LIMIT 1) UNION ALL "
        "SELECT 'balanced' AS mode, * FROM (SELECT * FROM c {b})").format(p=precision, q=recall, b=best)


def _points(precision, recall):
    return sql(f"SELECT mode, {r('threshold', 'precision', 'recall', 'f1')} FROM m", "fx_scores", **_C,
               m=_modes(precision, recall))


_MATRIX = ("SELECT count(*) FILTER (score >= 0.5 AND y = 1) AS tp, count(*) FILTER (score >= 0.5 AND y = 0) AS fp, "
           "count(*) FILTER (score < 0.5 AND y = 1) AS fn, count(*) FILTER (score < 0.5 AND y = 0) AS tn FROM fx_scores")
_FOLD = ("SELECT fold, tp::DOUBLE / greatest(predicted, 1) AS precision, tp::DOUBLE / greatest(actual, 1) AS recall, "
         "coalesce(2.0::DOUBLE * tp / nullif(predicted + actual, 0), 0.0) AS f1 FROM (SELECT fold, "
         "count(*) FILTER (score >= 0.5 AND y = 1) AS tp, count(*) FILTER (score >= 0.5) AS predicted, "
         "count(*) FILTER (y = 1) AS actual FROM folds GROUP BY fold)")
_POINT = "tp, fp, fn, tn, cost::BIGINT AS cost, savings::BIGINT AS savings"

QUERIES = {
    "pr_curve": (_pr_curve, sql(f"SELECT {r('threshold', 'precision', 'recall')}, tp, fp, fn, tn, rank FROM c",
                                "fx_scores", **_C)),
    "average_precision": (_average_precision, sql(
        "SELECT round(sum(gain * precision), 6) AS average_precision FROM c", "fx_scores", **_C)),
    "operating_thresholds": (_thresholds, _points(0.9, 0.95)),
    "operating_thresholds_reached": (_thresholds_reached, _points(0.2, 0.5)),
    "cost_sweep": (_cost_sweep, sql(
        f"SELECT rank, {_POINT}, {r('threshold', 'precision', 'recall')} FROM s", "fx_scores", **_C, s=_SWEEP)),
    "best_operating_points": (_best_points, sql(
        f"SELECT rank, {_POINT}, {r('threshold', 'precision', 'recall')} FROM s ORDER BY savings DESC, rank LIMIT 5",
        "fx_scores", **_C, s=_SWEEP)),
    "cost_optimum": (_optimum, sql(
        f"SELECT {_POINT}, {r('threshold')} FROM s ORDER BY savings DESC, rank LIMIT 1", "fx_scores", **_C, s=_COSTS)),
    "confusion_matrix": (_confusion, sql(
        "SELECT tp, fp, fn, tn, round(fp * 100.0::DOUBLE / (fp + tn), 6) AS fp_rate_pct, "
        "round(tp * 100.0::DOUBLE / (tp + fn), 6) AS recall_pct, "
        "round(tp * 100.0::DOUBLE / (tp + fp), 6) AS precision_pct, "
        "round(2 * tp * 100.0::DOUBLE / (2 * tp + fp + fn), 6) AS f1_pct FROM m", "fx_scores", m=_MATRIX)),
    "benchmark_comparison": (_benchmark, sql(
        "SELECT round(x, 6) AS fp_rate_pct, 54.0::DOUBLE AS industry_fp_rate, round(54 - x, 6) AS points_below, "
        "round((1 - x / 54) * 100, 6) AS reduction_pct FROM (SELECT fp * 100.0::DOUBLE / (fp + tn) AS x FROM m)",
        "fx_scores", m=_MATRIX)),
    "per_fold_metrics": (_per_fold, sql(f"SELECT fold, {r('precision', 'recall', 'f1')} FROM f", "fx_scores",
                                        folds=FOLDS_SQL, f=_FOLD)),
    "fold_metrics": (_fold_metrics, sql(
        " UNION ALL ".join(f"SELECT '{m}' AS metric, {r(f'avg({m}) AS mean', f'stddev_pop({m}) AS std')} FROM f"
                           for m in ("precision", "recall", "f1")), "fx_scores", folds=FOLDS_SQL, f=_FOLD)),
    "evaluation_summary": (_summary, sql(
        "SELECT (SELECT round(sum(gain * precision), 6) FROM c) AS pr_auc, " + ", ".join(
            f"(SELECT round({x}, 6) FROM m WHERE mode = '{m}') AS {m}_{x}"
            for m in ("ultra_safe", "balanced", "sensitive") for x in ("threshold", "precision", "recall", "f1"))
        + ", round(o.threshold, 6) AS cost_threshold, o.tp AS cost_tp, o.fp AS cost_fp, o.fn AS cost_fn, o.tn AS cost_tn, "
        "o.savings::BIGINT AS net_savings, "
        "(SELECT round(fp * 100.0::DOUBLE / (fp + tn), 6) FROM m WHERE mode = 'balanced') AS fp_rate_pct, "
        "round(o.savings * 365::DOUBLE / 35, 6) AS annual_savings FROM "
        "(SELECT * FROM s ORDER BY savings DESC, rank LIMIT 1) o", "fx_scores", **_C, m=_modes(0.9, 0.95), s=_COSTS)),
}
