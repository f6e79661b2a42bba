"""Classifier evaluation on a (label, score[, prediction]) frame.

Rows without a score (null or NaN) or without a label are not ranked: they are
left out of the curves, the areas and their totals alike.

Curves and areas are exact: scores are first aggregated to one row per
distinct score (map-side partial aggregation), then running sums over the
descending score order come from :mod:`truant.plans.prefix` (ranges of
scores, no single-task window).  Areas are trapezoids over consecutive curve points;
each point's predecessor is its own running sum minus its own counts, so no
lag over a global order is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truant.plans.prefix import ROWS_PER_RANGE, running_totals


def predict_label(score="SCORE", threshold: float = 0.5):
    """Class 1 when the probability is above the threshold."""
    s = F.col(score) if isinstance(score, str) else score
    return (s > F.lit(threshold)).cast("int")


def score_groups(df: DataFrame, label: str = "label", score: str = "SCORE") -> DataFrame:
    ranked = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
    return (ranked.groupBy(F.col(score).alias("threshold"))
              .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                   F.sum((1 - F.col(label)).cast("long")).alias("neg")))


def _totals(groups: DataFrame) -> tuple[int, int, int]:
    r = groups.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return int(r["p"] or 0), int(r["n"] or 0), int(r["k"] or 0)


def curve_points(df: DataFrame, label: str = "label", score: str = "SCORE",
                 rows_per_range: int = ROWS_PER_RANGE, corners: bool = False) -> tuple[DataFrame, int, int]:
    """Per distinct score (descending): tp, fp at that threshold and before it.

    ``corners``: only the points at which the curve turns, and its last one.  A
    point lies on the line between its neighbours if the step to it and the one
    after it have the same direction, in whole numbers; all such points go, so
    that the line through the rest is the same."""
    g = score_groups(df, label, score)
    p, n, k = _totals(g)
    c = running_totals(g, "threshold", ["pos", "neg"], k, descending=True, rows_per_range=rows_per_range, following=corners)
    if corners:
        step, after = (F.col(x).cast("decimal(19,0)") for x in ("pos", "neg")), (F.col(f"next_{x}").cast("decimal(19,0)") for x in ("pos", "neg"))
        (up, right), (next_up, next_right) = step, after
        c = c.where(F.col("next_pos").isNull() | (up * next_right != right * next_up))
    c = c.select("threshold", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                 (F.col("cum_pos") - F.col("pos")).alias("tp_prev"),
                 (F.col("cum_neg") - F.col("neg")).alias("fp_prev"))
    return c, p, n


def roc_curve(df: DataFrame, label: str = "label", score: str = "SCORE", digits: int = 9, thin: bool = False,
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The (threshold, fpr, tpr) points, one per distinct score; with ``thin``
    only those at which the curve turns and the last one."""
    c, p, n = curve_points(df, label, score, rows_per_range, thin)
    return c.select("threshold",
                    F.round(F.col("fp") / F.lit(float(n or 1)), digits).alias("fpr"),
                    F.round(F.col("tp") / F.lit(float(p or 1)), digits).alias("tpr"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "SCORE", digits: int = 9) -> DataFrame:
    """(threshold, precision, recall) per distinct score; the end point
    (recall 0, precision 1) is implied, as in the usual convention."""
    c, p, n = curve_points(df, label, score)
    return c.select("threshold",
                    F.round(F.col("tp") / (F.col("tp") + F.col("fp")), digits).alias("precision"),
                    F.round(F.col("tp") / F.lit(float(p or 1)), digits).alias("recall"))


def areas(df: DataFrame, label: str = "label", score: str = "SCORE") -> DataFrame:
    """One row: exact ROC AUC (ties count one half) and PR area (trapezoid
    from the point (recall 0, precision 1)), plus the class totals."""
    c, p, n = curve_points(df, label, score)
    P, N = F.lit(float(p or 1)), F.lit(float(n or 1))
    roc = (F.col("fp") - F.col("fp_prev")) / N * (F.col("tp") + F.col("tp_prev")) / P / 2
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prec_prev = F.when(F.col("tp_prev") + F.col("fp_prev") == 0, F.lit(1.0)) \
                 .otherwise(F.col("tp_prev") / (F.col("tp_prev") + F.col("fp_prev")))
    pr = (F.col("tp") - F.col("tp_prev")) / P * (prec + prec_prev) / 2
    return c.agg(F.sum(roc).alias("roc_auc"), F.sum(pr).alias("pr_auc")) \
            .withColumn("positives", F.lit(p).cast("long")).withColumn("negatives", F.lit(n).cast("long"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "SCORE") -> float:
    return float(areas(df, label, score).first()["roc_auc"])


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row with the four cells (zero cells included), one pass."""
    L, Pr = F.col(label), F.col(pred)
    cell = lambda a, b: F.sum(((L == a) & (Pr == b)).cast("long")).alias(f"c{a}{b}")
    return df.agg(cell(0, 0), cell(0, 1), cell(1, 0), cell(1, 1))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Long form: (label, prediction, count) for all four cells."""
    w = confusion_counts(df, label, pred)
    cells = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"c{a}{b}").alias("count"))
             for a in (0, 1) for b in (0, 1)]
    return w.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def report_from_counts(w: DataFrame, digits: int = 9) -> DataFrame:
    """Per class precision/recall/F1/support, accuracy, macro and weighted
    means from the one-row confusion counts; 0/0 counts as 0."""
    c00, c01, c10, c11 = (F.col(x).cast("double") for x in ("c00", "c01", "c10", "c11"))
    tot = c00 + c01 + c10 + c11
    p0, r0 = _safe_div(c00, c00 + c10), _safe_div(c00, c00 + c01)
    p1, r1 = _safe_div(c11, c11 + c01), _safe_div(c11, c11 + c10)
    f0, f1 = _safe_div(2 * p0 * r0, p0 + r0), _safe_div(2 * p1 * r1, p1 + r1)
    s0, s1 = c00 + c01, c10 + c11
    acc = _safe_div(c00 + c11, tot)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), F.round(p, digits).alias("precision"),
                        F.round(r, digits).alias("recall"), F.round(f, digits).alias("f1"),
                        s.cast("long").alias("support"))
    rows = [row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
            row("accuracy", acc, acc, acc, tot),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot),
            row("weighted avg", _safe_div(p0 * s0 + p1 * s1, tot), _safe_div(r0 * s0 + r1 * s1, tot),
                _safe_div(f0 * s0 + f1 * s1, tot), tot)]
    return w.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return report_from_counts(confusion_counts(df, label, pred))


def f1_accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    rep = classification_report(df, label, pred)
    return rep.where(F.col("class").isin("1", "accuracy")).groupBy().pivot("class", ["1", "accuracy"]) \
              .agg(F.first("f1")).toDF("f1", "accuracy")


def evaluate(df: DataFrame, label: str = "label", score: str = "SCORE", pred: str | None = None,
             threshold: float = 0.5, digits: int = 9) -> DataFrame:
    """(metric, value) of a scored frame, the whole evaluation at once: areas,
    report per class, accuracy and the confusion cells.  Without a column
    ``pred`` class 1 is a score above ``threshold``."""
    rows = df if pred else df.withColumn("__pred", predict_label(score, threshold))
    cells = confusion_counts(rows, label, pred or "__pred")
    names = ["c00", "c01", "c10", "c11"]
    cell_rows = cells.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])).alias("r"))
    report = report_from_counts(cells, digits)
    per_class = report.where(F.col("class").isin("0", "1")).select(F.explode(F.array(*[
        F.struct(F.concat(F.lit(f"{m}_"), F.col("class")).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1", "support")])).alias("r"))
    accuracy = report.where(F.col("class") == "accuracy").select(F.struct(F.lit("accuracy").alias("metric"), F.col("f1").alias("value")).alias("r"))
    area = areas(df, label, score).select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.round(m, digits).alias("value")) for m in ("roc_auc", "pr_auc")])).alias("r"))
    return area.union(per_class).union(accuracy).union(cell_rows).select("r.*")


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "SCORE", digits: int = 9) -> DataFrame:
    """Precision, recall and F1 of class 1 at every distinct score threshold
    (predict 1 when score >= threshold)."""
    c, p, n = curve_points(df, label, score)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.col("tp") / F.lit(float(p or 1))
    f1 = _safe_div(2 * prec * rec, prec + rec)
    return c.select("threshold", F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
                    F.round(f1, digits).alias("f1"))
