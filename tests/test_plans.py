"""Physical-plan properties the scale design relies on."""

from conftest import SF_SMALL
import __spark_entry__ as entry


def _executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _windows(text: str) -> list[list[str]]:
    """Bracket lists of each Window node: [exprs, order] when unpartitioned,
    [exprs, partition, order] otherwise."""
    out = []
    for line in text.split("\n"):
        if "Window [" in line:
            out.append(line.split("Window ", 1)[1].split("], ["))
    return out


def _unpartitioned_windows_only_over_buckets(df):
    ws = _windows(_executed(df))
    assert ws, "expected a window"
    for parts in ws:
        if len(parts) == 2:  # no partition: only allowed over the bounded bucket-totals table
            assert "__rb" in parts[1], parts
    return ws


def test_window_parser_detects_unpartitioned(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(5).withColumn("r", F.row_number().over(Window.orderBy("id")))
    good = spark.range(5).withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert [len(p) for p in _windows(_executed(bad))] == [2]
    assert [len(p) for p in _windows(_executed(good))] == [3]


def test_flagship_prunes_columns_and_broadcasts_dimension(spark):
    text = _formatted(entry.queries()["rate_by_age_group"](spark, SF_SMALL))
    # only the three event columns the question needs are read
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    assert "BroadcastHashJoin" in text
    # partial aggregation before the shuffle
    assert text.count("HashAggregate") >= 2


def test_split_is_a_projection_of_one_scan(spark):
    """The rows of a split are read once and never shuffled: the borders come as a broadcast list."""
    text = _executed(entry.queries()["stratified_split"](spark, SF_SMALL))
    assert text.count("events.parquet") == 1
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text and "Window" not in text


def test_history_shuffles_once(spark):
    for name in ("prior_appointments", "prior_misses"):
        text = _executed(entry.queries()[name](spark, SF_SMALL))
        assert text.count("Exchange hashpartitioning") == 1, name


def test_ranks_are_partitioned(spark):
    for name in ("stratified_kfold", "class_rank"):
        for parts in _unpartitioned_windows_only_over_buckets(entry.queries()[name](spark, SF_SMALL)):
            assert len(parts) == 3, (name, parts)


def test_curves_and_history_avoid_single_task_windows(spark):
    from truant.fixtures import scored
    from truant.operators import evaluate
    points, _, _ = evaluate.curve_points(scored(spark, SF_SMALL), rows_per_range=50)  # as if there were millions of scores
    _unpartitioned_windows_only_over_buckets(points)
    for name in ("prior_appointments", "prior_misses"):
        _unpartitioned_windows_only_over_buckets(entry.queries()[name](spark, SF_SMALL))
