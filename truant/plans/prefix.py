"""Running totals over a global order without a single-partition window.

A window with ``orderBy`` and no ``partitionBy`` (or a hot partition key)
sends every row of a segment to one task.  Here the rows are range-partitioned
on the order (bounds from Spark's own sample), written once with the number of
their range, and only sorted together inside it; the totals per range, a small
table, give each range's starting offset.  Ties of the order column always
share a range.  Up to ``ROWS_PER_RANGE`` rows are one range and skip that step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truant.session import materialize

ROWS_PER_RANGE = 1_000_000


def running_totals(df: DataFrame, order_col: str, values: list[str], n_rows: int, keys: list[str] | None = None,
                   descending: bool = False, tiebreak: list[str] | None = None,
                   rows_per_range: int = ROWS_PER_RANGE, prefix: str = "cum_", following: bool = False) -> DataFrame:
    """Inclusive running sums of ``values`` in ``order_col`` order (within
    ``keys``), as ``cum_<value>`` columns.  With ``following`` also
    ``next_<value>``, the value of the next row, null at the end; a range's last
    row gets it from the first row of the next range.  That needs an
    ``order_col`` without ties.

    ``tiebreak`` orders rows with equal ``order_col``; without it, tied rows
    get the running sum through all of the tie (a RANGE frame).  ``n_rows`` is
    the number of rows, from which the number of ranges follows.
    """
    keys = keys or []
    o = F.desc(order_col) if descending else F.asc(order_col)
    n = max(1, -(-n_rows // rows_per_range))
    if n == 1:
        j = df.withColumn("__rb", F.lit(0))
        offset = {v: F.lit(0) for v in values}
    else:
        b = materialize(df.repartitionByRange(n, *keys, o).withColumn("__rb", F.spark_partition_id()), "ranges")
        totals = b.groupBy(*keys, "__rb").agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
        wb = Window.partitionBy(*keys).orderBy("__rb").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(*keys, "__rb", *[F.coalesce(F.sum(f"__t_{v}").over(wb), F.lit(0))
                                                 .alias(f"__o_{v}") for v in values])
        if following:
            first = (F.max_by if descending else F.min_by)(F.struct(*values), order_col)
            firsts = b.groupBy(*keys, "__rb").agg(first.alias("__first"))
            border = firsts.select(*keys, "__rb", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__rb")).alias("__border"))
            offsets = offsets.join(border, [*keys, "__rb"])  # one row a range
        j = b.join(offsets, [*keys, "__rb"])  # on what the window below is partitioned by
        offset = {v: F.col(f"__o_{v}") for v in values}
    w = Window.partitionBy(*keys, "__rb").orderBy(o, *(tiebreak or []))
    after = [(F.coalesce(F.lead(v).over(w), F.col("__border")[v]) if n > 1 else F.lead(v).over(w)).alias(f"next_{v}") for v in values] if following else []
    w = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if tiebreak
         else w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return j.select(*df.columns, *[(offset[v] + F.sum(v).over(w)).alias(f"{prefix}{v}") for v in values], *after)
