"""Exact sampling: the 10-row demonstration table and quota properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from truant.operators import sampling

TEN = [(1, 25, 1, 5, 0), (2, 30, 0, 10, 0), (3, 45, 1, 2, 0), (4, 50, 0, 20, 0), (5, 35, 1, 7, 0),
       (6, 40, 0, 3, 0), (7, 28, 1, 15, 0), (8, 60, 0, 1, 0), (9, 22, 1, 30, 1), (10, 33, 0, 25, 1)]
SCHEMA = "RowID long, Age int, SMS int, DaysTillAppt int, NO_SHOW int"


def test_upsample_minority_to_majority(spark):
    df = spark.createDataFrame(TEN, SCHEMA)
    up = sampling.upsample(df, "NO_SHOW", "RowID", seed=123, minority=1)
    counts = {r[0]: r[1] for r in up.groupBy("NO_SHOW").count().collect()}
    assert counts == {0: 8, 1: 8}
    assert {r[0] for r in up.where("NO_SHOW = 1").select("RowID").collect()} <= {9, 10}


def test_downsample_majority_to_minority(spark):
    df = spark.createDataFrame(TEN, SCHEMA)
    down = sampling.downsample(df, "NO_SHOW", "RowID", seed=123, majority=0)
    counts = {r[0]: r[1] for r in down.groupBy("NO_SHOW").count().collect()}
    assert counts == {0: 2, 1: 2}


def test_without_replacement_guard(spark):
    df = spark.createDataFrame(TEN, SCHEMA)
    with pytest.raises(ValueError):
        sampling.downsample(df, "NO_SHOW", "RowID", majority=1, n=8)


def test_allocate_matches_rounded_total():
    q = sampling.allocate({"0": 88416, "1": 22105}, 0.2)
    assert sum(q.values()) == 22105  # ceil(0.2 * 110521)


@settings(max_examples=6, deadline=None)
@given(n0=st.integers(1, 300), n1=st.integers(1, 120), seed=st.integers(0, 10_000))
def test_split_quotas_exact_and_disjoint(spark, n0, n1, seed):
    rows = [(i, 0) for i in range(n0)] + [(n0 + i, 1) for i in range(n1)]
    df = spark.createDataFrame(rows, "APPOINTMENTID long, NO_SHOW int")
    s = sampling.stratified_split(df, "NO_SHOW", 0.2, seed)
    q = sampling.allocate({"0": n0, "1": n1}, 0.2)
    got = {(r[0], r[1]): r[2] for r in s.groupBy("NO_SHOW", "split").count().collect()}
    assert got.get((0, "test"), 0) == q["0"] and got.get((1, "test"), 0) == q["1"]
    assert s.count() == n0 + n1 and s.select("APPOINTMENTID").distinct().count() == n0 + n1


def test_kfold_balanced(spark):
    df = spark.range(1003).selectExpr("id AS APPOINTMENTID", "CAST(id % 4 = 0 AS INT) AS NO_SHOW")
    f = sampling.stratified_kfold(df, 5)
    sizes = f.groupBy("NO_SHOW", "fold").count().collect()
    by_class = {}
    for r in sizes:
        by_class.setdefault(r[0], []).append(r[2])
    for v in by_class.values():
        assert len(v) == 5 and max(v) - min(v) <= 1


def test_class_rank_is_a_permutation_with_hot_class(spark):
    # one class holds almost all rows; ranks are still 1..n_c without gaps
    df = spark.range(5000).selectExpr("id AS APPOINTMENTID", "CAST(id % 50 = 0 AS INT) AS NO_SHOW")
    r = sampling.class_rank(df, "NO_SHOW", "APPOINTMENTID", 7, "rk")
    agg = r.groupBy("NO_SHOW").agg(F.count("*").alias("n"), F.min("rk").alias("lo"), F.max("rk").alias("hi"),
                                   F.countDistinct("rk").alias("d")).collect()
    for a in agg:
        assert a.lo == 1 and a.hi == a.n == a.d


def test_finer_ranges_do_not_change_ranks(spark):
    df = spark.range(3000).selectExpr("id AS APPOINTMENTID", "CAST(id % 3 = 0 AS INT) AS NO_SHOW")
    _, counts, bits = sampling._counted(df, "NO_SHOW", "APPOINTMENTID", 5, rows_per_range=2)
    assert bits > sampling.MIN_RANGE_BITS and sum(counts.values()) == 3000
    a = {r.APPOINTMENTID: r.rk for r in sampling.class_rank(df, "NO_SHOW", "APPOINTMENTID", 5, "rk", 2).collect()}
    b = {r.APPOINTMENTID: r.rk for r in sampling.class_rank(df, "NO_SHOW", "APPOINTMENTID", 5, "rk").collect()}
    assert a == b


@pytest.mark.parametrize("rows_per_range", [3, 250_000])
def test_null_keys_are_drawn_like_others(spark, rows_per_range):
    df = spark.range(1000).selectExpr("CASE WHEN id % 10 <> 0 THEN id END AS APPOINTMENTID", "CAST(id % 4 = 0 AS INT) AS NO_SHOW", "id AS other")
    s = sampling.select_by_quota(df, {"0": 150, "1": 50}, "NO_SHOW", rows_per_range=rows_per_range)
    got = {(r[0], r[1]): r[2] for r in s.groupBy("NO_SHOW", "__in").count().collect()}
    assert got == {(0, True): 150, (0, False): 600, (1, True): 50, (1, False): 200}
    assert 0 < s.where("APPOINTMENTID IS NULL AND __in").count() < 100
    assert sampling.downsample(df, "NO_SHOW", n=300).where("NO_SHOW = 0").count() == 300
    folds = sampling.stratified_kfold(df, 5).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [200] * 5


def test_repeated_keys_stay_on_one_side(spark):
    df = spark.range(400).selectExpr("id % 40 AS APPOINTMENTID", "0 AS NO_SHOW")
    s = sampling.stratified_split(df, "NO_SHOW", 0.25)
    assert s.count() == 400 and s.groupBy("APPOINTMENTID").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0


def test_many_strata(spark):
    df = spark.range(24_000).selectExpr("id AS APPOINTMENTID", "id % 12000 AS NO_SHOW")
    s = sampling.stratified_split(df, "NO_SHOW", 0.5)
    assert s.where("split = 'test'").count() == 12_000 == s.where("split = 'test'").select("NO_SHOW").distinct().count()


def test_empty_table(spark):
    df = spark.createDataFrame([], "APPOINTMENTID long, NO_SHOW int")
    assert sampling.stratified_split(df).count() == sampling.stratified_kfold(df).count() == 0


def test_draws_reach_rows_beyond_32_bits(spark):
    from truant.functions.hashing import hash60
    m = 10 << 32
    top = spark.range(2000).select(F.max(F.pmod(hash60(1, F.col("id")), F.lit(m)))).first()[0]
    assert m * 0.99 < top < m


def _reads(spark, call, n=400):
    """How often ``call`` reads the rows of its input."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(n).selectExpr("id AS APPOINTMENTID", "CAST(id % 4 = 0 AS INT) AS NO_SHOW").mapInArrow(count, "APPOINTMENTID long, NO_SHOW int")
    call(df).write.format("noop").mode("overwrite").save()
    return seen.value / n


def test_reads_of_the_input(spark):
    """A split or down-sampling counts, finds the border, and is then a projection; folds count and rank."""
    assert _reads(spark, lambda df: sampling.stratified_split(df, "NO_SHOW")) <= 3
    assert _reads(spark, lambda df: sampling.downsample(df, "NO_SHOW")) <= 3
    assert _reads(spark, lambda df: sampling.stratified_kfold(df, 5)) <= 2
    assert _reads(spark, lambda df: sampling.upsample(df, "NO_SHOW")) <= 3


def test_border_in_a_crowded_range(spark, monkeypatch):
    """All hash values in few counted ranges: the border is found among the rows of its range."""
    monkeypatch.setattr(sampling, "HISTOGRAM_BITS", 1)
    monkeypatch.setattr(sampling, "MIN_RANGE_BITS", 1)
    df = spark.range(900).selectExpr("id AS APPOINTMENTID", "CAST(id % 3 = 0 AS INT) AS NO_SHOW")
    few = sampling.stratified_split(df, "NO_SHOW", 0.3, 7).where("split = 'test'").select("APPOINTMENTID")
    monkeypatch.undo()
    many = sampling.stratified_split(df, "NO_SHOW", 0.3, 7).where("split = 'test'").select("APPOINTMENTID")
    assert few.count() == 270 and few.exceptAll(many).count() == 0


def test_whole_and_empty_quotas(spark):
    df = spark.range(50).selectExpr("id AS APPOINTMENTID", "CAST(id % 5 = 0 AS INT) AS NO_SHOW")
    s = sampling.select_by_quota(df, {"0": 40, "1": 0}, "NO_SHOW")
    assert {(r[0], r[1]): r[2] for r in s.groupBy("NO_SHOW", "__in").count().collect()} == {(0, True): 40, (1, False): 10}


@pytest.mark.parametrize("strata", [2, 40])
def test_written_hashes_draw_the_same_rows(spark, strata):
    df = spark.range(4000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("APPOINTMENTID"), (F.col("id") % strata).cast("int").alias("NO_SHOW"), F.col("id").alias("n"))
    hashed = sampling.with_hash(df, seed=7)

    def drawn(frame, **kw):
        return {r["n"] for r in sampling.stratified_split(frame, seed=7, **kw).where("split = 'test'").collect()}
    got = drawn(hashed, hashed=sampling.KEY_HASH)
    assert len(got) == 800 and got == drawn(df)
