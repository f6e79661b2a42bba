"""Registered queries: evaluation on a score column (no model needed)."""

from __future__ import annotations

from pyspark.sql import functions as F

from truant.fixtures import SCORED_SQL, scored, with_ctes
from truant.operators import evaluate
from truant.plans.catalog import query

D = 9

_CURVE = dict(
    scored=SCORED_SQL,
    g="SELECT SCORE AS threshold, CAST(SUM(label) AS BIGINT) AS pos, CAST(SUM(1 - label) AS BIGINT) AS neg"
      " FROM scored GROUP BY 1",
    tot="SELECT SUM(pos) AS p_all, SUM(neg) AS n_all FROM g",
    c="SELECT threshold, pos, neg, SUM(pos) OVER (ORDER BY threshold DESC) AS tp,"
      " SUM(neg) OVER (ORDER BY threshold DESC) AS fp FROM g",
    cp="SELECT *, tp - pos AS tp_prev, fp - neg AS fp_prev FROM c, tot",
)


def _pred(spark, sf):
    s = scored(spark, sf)
    return s.withColumn("prediction", evaluate.predict_label("SCORE", 0.5))


@query("roc_pr_auc", with_ctes(f"""
SELECT ROUND(SUM((fp - fp_prev) / n_all * (tp + tp_prev) / p_all / 2), {D}) AS roc_auc,
       ROUND(SUM((tp - tp_prev) / p_all * (tp / (tp + fp) + CASE WHEN tp_prev + fp_prev = 0 THEN 1.0
             ELSE tp_prev / (tp_prev + fp_prev) END) / 2), {D}) AS pr_auc,
       CAST(MAX(p_all) AS BIGINT) AS positives, CAST(MAX(n_all) AS BIGINT) AS negatives
FROM cp""", **_CURVE))
def q_roc_pr_auc(spark, sf):
    a = evaluate.areas(scored(spark, sf), "label", "SCORE")
    return a.select(F.round("roc_auc", D).alias("roc_auc"), F.round("pr_auc", D).alias("pr_auc"),
                    "positives", "negatives")


@query("roc_curve", with_ctes(
    f"SELECT threshold, ROUND(fp / n_all, {D}) AS fpr, ROUND(tp / p_all, {D}) AS tpr FROM cp", **_CURVE))
def q_roc_curve(spark, sf):
    return evaluate.roc_curve(scored(spark, sf), "label", "SCORE")


@query("roc_curve_thinned", with_ctes(
    f"SELECT threshold, ROUND(fp / n_all, {D}) AS fpr, ROUND(tp / p_all, {D}) AS tpr FROM (SELECT *, LEAD(tp) OVER w - tp AS up,"
    " LEAD(fp) OVER w - fp AS across FROM cp WINDOW w AS (ORDER BY threshold DESC))"
    " WHERE up IS NULL OR CAST(tp - tp_prev AS HUGEINT) * across <> CAST(fp - fp_prev AS HUGEINT) * up", **_CURVE))
def q_roc_curve_thinned(spark, sf):
    """The ROC curve without the points that lie on the line between their neighbours."""
    return evaluate.roc_curve(scored(spark, sf), "label", "SCORE", thin=True)


@query("pr_curve", with_ctes(
    f"SELECT threshold, ROUND(tp / (tp + fp), {D}) AS precision, ROUND(tp / p_all, {D}) AS recall FROM cp",
    **_CURVE))
def q_pr_curve(spark, sf):
    return evaluate.pr_curve(scored(spark, sf), "label", "SCORE")


@query("threshold_sweep", with_ctes(
    f"SELECT threshold, ROUND(tp / (tp + fp), {D}) AS precision, ROUND(tp / p_all, {D}) AS recall,"
    f" ROUND(CASE WHEN tp = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + (p_all - tp)) END, {D}) AS f1 FROM cp",
    **_CURVE))
def q_threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(scored(spark, sf), "label", "SCORE")


_CM = dict(scored=SCORED_SQL,
           pr="SELECT label, CAST(SCORE > 0.5 AS INT) AS prediction FROM scored",
           cells="SELECT CAST(l AS INT) AS label, CAST(p AS INT) AS prediction FROM (VALUES (0,0),(0,1),(1,0),(1,1)) v(l,p)")


@query("confusion_matrix", with_ctes(
    "SELECT c.label, c.prediction, CAST(COUNT(pr.label) AS BIGINT) AS count"
    " FROM cells c LEFT JOIN pr ON pr.label = c.label AND pr.prediction = c.prediction GROUP BY 1, 2", **_CM))
def q_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_pred(spark, sf), "label", "prediction")


_REPORT_BODY = f"""
SELECT class, ROUND(precision, {D}) AS precision, ROUND(recall, {D}) AS recall, ROUND(f1, {D}) AS f1,
       CAST(support AS BIGINT) AS support FROM (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m
  UNION ALL SELECT '1', p1, r1, f1_, s1 FROM m
  UNION ALL SELECT 'accuracy', acc, acc, acc, tot FROM m
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1_) / 2, tot FROM m
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / tot, (r0 * s0 + r1 * s1) / tot,
                   (f0 * s0 + f1_ * s1) / tot, tot FROM m)"""
_REPORT_CTES = dict(
    _CM,
    k="SELECT CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS c00,"
      " CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS c01,"
      " CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS c10,"
      " CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS c11 FROM pr",
    q="SELECT *, c00 / (c00 + c10) AS p0, c00 / (c00 + c01) AS r0, c11 / (c11 + c01) AS p1,"
      " c11 / (c11 + c10) AS r1, c00 + c01 AS s0, c10 + c11 AS s1, c00 + c01 + c10 + c11 AS tot,"
      " (c00 + c11) / (c00 + c01 + c10 + c11) AS acc FROM k",
    m="SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1_ FROM q")
_REPORT_SQL = with_ctes(_REPORT_BODY, **_REPORT_CTES)


@query("classification_report", _REPORT_SQL)
def q_classification_report(spark, sf):
    return evaluate.classification_report(_pred(spark, sf), "label", "prediction")


@query("f1_accuracy", with_ctes(
    "SELECT MAX(CASE WHEN class = '1' THEN f1 END) AS f1,"
    " MAX(CASE WHEN class = 'accuracy' THEN f1 END) AS accuracy FROM rep",
    **_REPORT_CTES, rep=_REPORT_BODY))
def q_f1_accuracy(spark, sf):
    return evaluate.f1_accuracy(_pred(spark, sf), "label", "prediction")


@query("roc_auc", with_ctes(
    f"SELECT ROUND(SUM((fp - fp_prev) / n_all * (tp + tp_prev) / p_all / 2), {D}) AS roc_auc FROM cp", **_CURVE))
def q_roc_auc(spark, sf):
    """Exact area under the ROC curve (ties count one half)."""
    return evaluate.areas(scored(spark, sf), "label", "SCORE").select(F.round("roc_auc", D).alias("roc_auc"))


@query("pr_auc", with_ctes(
    f"SELECT ROUND(SUM((tp - tp_prev) / p_all * (tp / (tp + fp) + CASE WHEN tp_prev + fp_prev = 0 THEN 1.0"
    f" ELSE tp_prev / (tp_prev + fp_prev) END) / 2), {D}) AS pr_auc FROM cp", **_CURVE))
def q_pr_auc(spark, sf):
    """Trapezoid area under the precision-recall curve from (recall 0, precision 1)."""
    return evaluate.areas(scored(spark, sf), "label", "SCORE").select(F.round("pr_auc", D).alias("pr_auc"))


_NULL_SCORES = dict(_CURVE, scored=f"SELECT * FROM ({SCORED_SQL}) t WHERE APPOINTMENTID % 7 <> 0")


@query("curve_null_scores", with_ctes(
    f"SELECT threshold, ROUND(fp / n_all, {D}) AS fpr, ROUND(tp / p_all, {D}) AS tpr FROM cp", **_NULL_SCORES))
def q_curve_null_scores(spark, sf):
    """A seventh of the scores is null: such rows are in no point and in no total."""
    s = scored(spark, sf).withColumn("SCORE", F.when(F.col("APPOINTMENTID") % 7 != 0, F.col("SCORE")))
    return evaluate.roc_curve(s, "label", "SCORE")


_AREAS_BODY = f"""
SELECT ROUND(SUM((fp - fp_prev) / n_all * (tp + tp_prev) / p_all / 2), {D}) AS roc_auc,
       ROUND(SUM((tp - tp_prev) / p_all * (tp / (tp + fp) + CASE WHEN tp_prev + fp_prev = 0 THEN 1.0
             ELSE tp_prev / (tp_prev + fp_prev) END) / 2), {D}) AS pr_auc FROM cp"""


@query("evaluate_model", with_ctes("""
SELECT 'roc_auc' AS metric, roc_auc AS value FROM areas UNION ALL SELECT 'pr_auc', pr_auc FROM areas
UNION ALL SELECT 'precision_' || class, precision FROM rep WHERE class IN ('0', '1')
UNION ALL SELECT 'recall_' || class, recall FROM rep WHERE class IN ('0', '1')
UNION ALL SELECT 'f1_' || class, f1 FROM rep WHERE class IN ('0', '1')
UNION ALL SELECT 'support_' || class, CAST(support AS DOUBLE) FROM rep WHERE class IN ('0', '1')
UNION ALL SELECT 'accuracy', f1 FROM rep WHERE class = 'accuracy'
UNION ALL SELECT 'c00', c00 FROM k UNION ALL SELECT 'c01', c01 FROM k UNION ALL SELECT 'c10', c10 FROM k
UNION ALL SELECT 'c11', c11 FROM k""", **_CURVE, **{k: v for k, v in _REPORT_CTES.items() if k != "scored"},
                                   rep=_REPORT_BODY, areas=_AREAS_BODY))
def q_evaluate_model(spark, sf):
    """The whole evaluation of a score column in one frame."""
    return evaluate.evaluate(scored(spark, sf), "label", "SCORE", digits=D)
