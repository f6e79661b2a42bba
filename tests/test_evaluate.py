"""Curves, areas and the report from counts."""

import pytest
from pyspark.sql import functions as F

from truant.operators import evaluate


def _scored(spark, scores, labels):
    return spark.createDataFrame(list(zip(labels, scores)), "label int, SCORE double")


def test_auc_and_pr_area(spark):
    a = evaluate.areas(_scored(spark, [.1, .4, .35, .8], [0, 0, 1, 1])).first()
    assert a.roc_auc == pytest.approx(0.75) and a.pr_auc == pytest.approx(0.7916667, abs=1e-7)


def test_tied_top_scores(spark):
    a = evaluate.areas(_scored(spark, [.9, .9, .5, .1], [1, 0, 1, 0])).first()
    assert a.roc_auc == pytest.approx(0.625) and a.pr_auc == pytest.approx(0.6666667, abs=1e-7)


def test_auc_symmetry_many_buckets(spark):
    df = spark.range(4000).selectExpr("CAST(id % 3 = 0 AS INT) AS label",
                                      "CAST((id * 7919) % 613 AS DOUBLE) / 613 + CAST(id % 3 = 0 AS INT) * 0.1 AS SCORE")
    a = evaluate.areas(df).first().roc_auc
    b = evaluate.areas(df.withColumn("SCORE", -F.col("SCORE"))).first().roc_auc
    assert a + b == pytest.approx(1.0)
    # brute force on the same data
    rows = df.collect()
    pos = [r.SCORE for r in rows if r.label == 1]
    neg = [r.SCORE for r in rows if r.label == 0]
    import bisect
    neg.sort()
    tot = sum(bisect.bisect_left(neg, p) + 0.5 * (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p))
              for p in pos)
    assert a == pytest.approx(tot / (len(pos) * len(neg)))


def test_report_from_counts(spark):
    w = spark.createDataFrame([(10711, 6931, 1162, 3301)], "c00 long, c01 long, c10 long, c11 long")
    rep = {r["class"]: r for r in evaluate.report_from_counts(w).collect()}
    assert rep["accuracy"]["f1"] == pytest.approx(0.6339, abs=5e-5)
    assert rep["0"]["f1"] == pytest.approx(0.7258, abs=5e-5)
    assert rep["1"]["f1"] == pytest.approx(0.4493, abs=5e-5)
    assert rep["1"]["support"] == 4463


def test_confusion_includes_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    got = {(r.label, r.prediction): r["count"] for r in evaluate.confusion_matrix(df).collect()}
    assert got == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_rows_without_a_score_are_left_out(spark):
    df = _scored(spark, [.9, .4, None, .1, float("nan")], [1, 1, 0, 0, 0])
    a = evaluate.areas(df).first()
    assert (a.roc_auc, a.positives, a.negatives) == (1.0, 2, 1)
    assert evaluate.roc_curve(df).where("threshold IS NULL").count() == 0


def test_curve_over_several_ranges(spark):
    df = spark.range(500).selectExpr("CAST(id % 3 = 0 AS INT) AS label", "CAST(id * 7919 % 211 AS DOUBLE) / 211 AS SCORE")
    one, p, n = evaluate.curve_points(df)
    many, _, _ = evaluate.curve_points(df, rows_per_range=20)
    assert sorted(one.collect()) == sorted(many.collect()) and (p, n) == (167, 333)


def test_whole_evaluation(spark):
    got = {r.metric: r.value for r in evaluate.evaluate(_scored(spark, [.9, .6, .4, .1], [1, 0, 1, 0])).collect()}
    assert got["roc_auc"] == 0.75 and got["accuracy"] == 0.5 and (got["c00"], got["c11"], got["c01"], got["c10"]) == (1, 1, 1, 1)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 7])
def test_thinned_curve_is_the_same_line(spark, rows_per_range):
    """Points on the line between their neighbours go, also at the border of two ranges; the area stays, to the last digit."""
    import random

    from truant.operators.evaluate import curve_points, roc_curve
    pick = random.Random(4)
    rows = [(pick.randint(0, 1), s / 10) for s in range(60) for _ in range(pick.choice([1, 1, 2, 4]))] + [(1, -1.0), (0, -1.0), (1, -2.0), (1, -3.0), (1, -4.0), (1, None)]
    df = spark.createDataFrame(rows, "label int, SCORE double")
    whole = sorted(((-r.threshold, r.fp, r.tp) for r in curve_points(df, rows_per_range=rows_per_range)[0].collect()))
    want, last = [], (0, 0)
    for i, (t, fp, tp) in enumerate(whole):
        after = whole[i + 1][1:] if i + 1 < len(whole) else None
        step = (fp - last[0], tp - last[1])
        if after is None or step[0] * (after[1] - tp) != step[1] * (after[0] - fp):
            want.append((-t, fp, tp))
        last = (fp, tp)
    thin = roc_curve(df, thin=True, rows_per_range=rows_per_range)
    assert sorted(r.threshold for r in thin.collect()) == sorted(t for t, _, _ in want)
    assert len(want) < len(whole)

    def area(points):
        line = [(0, 0), *points]
        return sum((b[0] - a[0]) * (a[1] + b[1]) for a, b in zip(line, line[1:], strict=False))

    assert area([p[1:] for p in whole]) == area([p[1:] for p in want])


def test_thinned_curve_of_few_points(spark):
    from truant.operators.evaluate import roc_curve
    one = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, SCORE double")
    assert roc_curve(one, thin=True).count() == 1
    assert roc_curve(one.where("false"), thin=True).count() == 0
