"""Encoders and scaling with closed-form answers."""

import pytest

from truant.operators import encode


def test_target_encoding_sigmoid_and_m(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), ("a", 0), ("b", 0), ("b", 0), ("b", 0), ("b", 0)]
    df = spark.createDataFrame(rows, "NEIGHBOURHOOD string, NO_SHOW int")
    te = encode.fit_target_encoding(df, "NEIGHBOURHOOD")
    assert te.prior == pytest.approx(0.375)
    vals = {r[0]: r[1] for r in te.table.select("NEIGHBOURHOOD", "value").collect()}
    assert vals["a"] == pytest.approx(0.4379931, abs=1e-7)
    assert vals["b"] == pytest.approx(0.3120069, abs=1e-7)
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "NEIGHBOURHOOD string")
    out = [r[0] for r in te.transform(new).collect()]
    assert out[0] == pytest.approx(0.4379931, abs=1e-7)
    assert out[1] == pytest.approx(0.375) and out[2] == pytest.approx(0.375)
    m = encode.fit_target_encoding_m(df, "NEIGHBOURHOOD", m=10.0)
    mv = {r[0]: r[1] for r in m.table.select("NEIGHBOURHOOD", "value").collect()}
    assert mv["a"] == pytest.approx(0.4821429, abs=1e-7)
    assert mv["b"] == pytest.approx(0.2678571, abs=1e-7)


def test_encoded_value_between_mean_and_prior(spark):
    rows = [(f"c{i % 7}", (i * 37) % 5 == 0) for i in range(300)]
    df = spark.createDataFrame([(c, int(y)) for c, y in rows], "NEIGHBOURHOOD string, NO_SHOW int")
    te = encode.fit_target_encoding(df, "NEIGHBOURHOOD")
    for r in te.table.collect():
        lo, hi = sorted([r["mean"], te.prior])
        assert lo - 1e-12 <= r["value"] <= hi + 1e-12


def test_scaling_population_sigma(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "x int, c int")
    sc = encode.fit_scaling(df, ["x", "c"])
    got = sc.transform(df).collect()
    assert [round(r.x, 7) for r in got] == [-1.2247449, 0.0, 1.2247449]
    assert [r.c for r in got] == [0.0, 0.0, 0.0]


def test_one_hot_frozen_categories(spark):
    cats = [f"{g}_{b}" for g in "FM" for b in ("0-12", "13-17", "18-30", "31-50", "50+")]
    df = spark.createDataFrame([("F_0-12",), ("M_50+",), ("X_1",), (None,)], "GENDER_AGE string")
    out = encode.one_hot(df, "GENDER_AGE", cats)
    assert len(out.columns) == 9 and "GENDER_AGE_F_0-12" not in out.columns
    rows = [list(r) for r in out.collect()]
    assert sum(rows[0]) == 0 and sum(rows[2]) == 0 and sum(rows[3]) == 0
    assert rows[1][out.columns.index("GENDER_AGE_M_50+")] == 1 and sum(rows[1]) == 1


def test_fit_categories_refuses_high_cardinality(spark):
    df = spark.range(50).selectExpr("CAST(id AS STRING) AS c")
    with pytest.raises(ValueError):
        encode.fit_categories(df, "c", max_categories=10)


def test_one_hot_long_is_the_wide_form(spark):
    from truant.operators import encode
    rows = [(i, v) for i, v in enumerate(["b", "a", None, "c", "b", "zz"])]
    df = spark.createDataFrame(rows, "k long, v string")
    index = encode.category_index(df.where("v <> 'zz' or v is null"), "v")  # zz is unknown to the frozen index
    for drop in (True, False):
        cats = ["a", "b", "c"]
        wide = encode.one_hot(df, "v", cats, drop).collect()
        want = {(r.k, i) for r in wide for i, c in enumerate(cats[drop:]) if r[f"v_{c}"] == 1}
        assert {tuple(r) for r in encode.one_hot_long(df, "k", "v", index, drop).collect()} == want
    many = spark.range(12_000).selectExpr("id as k", "cast(id as string) as v")
    assert encode.one_hot_long(many, "k", "v", encode.category_index(many, "v")).select("index").distinct().count() == 11_999


def test_align_report(spark):
    from truant.operators import clean
    a = spark.createDataFrame([(1, 2.5, "x")], "i int, d double, only_a string")
    b = spark.createDataFrame([("1", "1e3", True), ("one", None, None), ("3000000000", "z", None)], "i string, d string, only_b boolean")
    got = {r["column"]: (r.left_type, r.right_type, r.left_place, r.right_place, r.right_rows, r.not_castable) for r in clean.align_report(a, b).collect()}
    assert got == {"i": ("int", "string", 1, 1, 3, 2), "d": ("double", "string", 2, 2, 3, 1),
                   "only_a": ("string", None, 3, None, 3, None), "only_b": (None, "boolean", None, 3, 3, None)}


def test_tree_learns_from_a_bounded_number_of_rows(spark):
    from truant.operators import models
    df = spark.range(3000).selectExpr("double(id % 7) as a", "int(id % 7 > 3) as NO_SHOW")
    mf = models.model_frame(df, ["a"])
    assert models.fit_tree(mf, weighted=False, max_rows=300).numNodes == 3
