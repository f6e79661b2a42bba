"""Portable pseudo-random keys.

Sampling must give the same rows on any cluster layout and in the DuckDB
oracle, so randomness is a hash of (seed, row key) rather than ``rand()``.
The integer is the first 15 hex digits (60 bits) of ``md5(seed || '|' || key)``:
wide enough to address any table's rows by a modulus.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_text(seed: int, key) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), _col(key).cast("string")))


def hash60(seed: int, key) -> Column:
    """Uniform integer in [0, 2^60) from (seed, key)."""
    return F.conv(F.substring(hash_text(seed, key), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_unit(seed: int, key) -> Column:
    """Uniform double in [0, 1)."""
    return hash60(seed, key) / F.lit(float(1 << HASH_BITS))


# DuckDB text of the same functions, used by the oracle SQL.
def sql_hash60(seed: int, key_sql: str) -> str:
    return (f"CAST(concat('0x', substr(md5(concat('{seed}|', CAST({key_sql} AS VARCHAR))), 1, {HASH_BITS // 4}))"
            f" AS BIGINT)")


def sql_hash_unit(seed: int, key_sql: str) -> str:
    return f"({sql_hash60(seed, key_sql)} / {float(1 << HASH_BITS)})"
