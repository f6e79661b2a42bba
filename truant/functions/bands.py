"""Age bands and the gender-age key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from truant.schema import AGE_BUCKET_EDGES, AGE_BUCKET_LABELS, SQL_AGE_BANDS, SQL_AGE_ELSE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_band(age="AGE") -> Column:
    """The warehouse ``CASE WHEN age BETWEEN ...`` band.

    Negative and null ages fall through to the ELSE branch, exactly as in SQL.
    """
    a = _col(age)
    expr = None
    for label, lo, hi in SQL_AGE_BANDS:
        expr = F.when(a.between(lo, hi), label) if expr is None else expr.when(a.between(lo, hi), label)
    return expr.otherwise(SQL_AGE_ELSE)


def age_bucket(age="AGE") -> Column:
    """Half-open feature buckets; below the first edge or null -> null.

    Written as a ``when`` chain: ``Bucketizer`` fails the job on a value below
    its first split even with ``handleInvalid='keep'``.
    """
    a = _col(age)
    edges = AGE_BUCKET_EDGES + [None]
    expr = None
    for i, label in enumerate(AGE_BUCKET_LABELS):
        lo, hi = edges[i], edges[i + 1]
        cond = (a >= lo) if hi is None else ((a >= lo) & (a < hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def gender_age(gender="GENDER", age="AGE") -> Column:
    """``GENDER + '_' + bucket``; null when either side is null."""
    return F.concat(_col(gender), F.lit("_"), age_bucket(age))
