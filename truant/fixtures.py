"""Test inputs derived from the driver tables (same rows in Spark and DuckDB).

``appointments`` follows FIXTURES.md section 1: one row per ``events`` row,
the neighbourhood from ``nation``.  The SQL texts below are the DuckDB side
of the same derivation; every oracle query starts with them as CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _flag(cond) -> "F.Column":
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14-column appointment table of the warehouse DDL."""
    e = table(spark, sf_dir, "events")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: the planner broadcasts it from its
    # file size, the events side is never shuffled.
    j = e.join(n, (e.user_id % 25) == n.n_nationkey)
    uid, eid = F.col("user_id"), F.col("event_id")
    day = F.date_add(F.col("ts").cast("timestamp").cast("date"), (eid % 41 - 1).cast("int"))
    missed = ((F.col("event_type") == "error") & (eid % 41 >= 10)) | \
             ((F.col("event_type") == "click") & (eid % 41 >= 30))
    return j.select(
        uid.cast("double").alias("PATIENTID"),
        eid.alias("APPOINTMENTID"),
        F.when(uid % 3 == 0, "M").otherwise("F").alias("GENDER"),
        F.col("ts").cast("timestamp").alias("SCHEDULEDDAY"),
        day.cast("timestamp").alias("APPOINTMENTDAY"),
        ((uid * 13 + eid * 7) % 117 - 1).cast("int").alias("AGE"),
        F.col("n_name").alias("NEIGHBOURHOOD"),
        _flag(F.col("value") < 5).alias("SCHOLARSHIP"),
        _flag(uid % 5 == 0).alias("HYPERTENSION"),
        _flag(uid % 14 == 0).alias("DIABETES"),
        _flag(uid % 33 == 0).alias("ALCOHOLISM"),
        _flag(uid % 50 == 0).alias("HANDICAP"),
        _flag(eid % 3 == 0).alias("SMS_RECEIVED"),
        F.when(missed, "Yes").otherwise("No").alias("NO_SHOW"),
    )


def score_expr(event_id: "F.Column") -> "F.Column":
    return ((event_id % 41) * 20 + (event_id * 7919) % 200).cast("double") / 1020


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``APPOINTMENTID, label, SCORE``: a score column with signal, no model."""
    a = appointments(spark, sf_dir)
    return a.select(
        "APPOINTMENTID",
        F.when(F.col("NO_SHOW") == "Yes", 1).otherwise(0).alias("label"),
        score_expr(F.col("APPOINTMENTID")).alias("SCORE"),
    )


# ---------------------------------------------------------------- DuckDB side
APPOINTMENTS_SQL = """
SELECT CAST(e.user_id AS DOUBLE) AS PATIENTID,
       e.event_id AS APPOINTMENTID,
       CASE WHEN e.user_id % 3 = 0 THEN 'M' ELSE 'F' END AS GENDER,
       CAST(e.ts AS TIMESTAMP) AS SCHEDULEDDAY,
       CAST(CAST(e.ts AS DATE) + CAST(e.event_id % 41 - 1 AS INT) AS TIMESTAMP) AS APPOINTMENTDAY,
       CAST((e.user_id * 13 + e.event_id * 7) % 117 - 1 AS INT) AS AGE,
       n.n_name AS NEIGHBOURHOOD,
       CASE WHEN e.value < 5 THEN 1 ELSE 0 END AS SCHOLARSHIP,
       CASE WHEN e.user_id % 5 = 0 THEN 1 ELSE 0 END AS HYPERTENSION,
       CASE WHEN e.user_id % 14 = 0 THEN 1 ELSE 0 END AS DIABETES,
       CASE WHEN e.user_id % 33 = 0 THEN 1 ELSE 0 END AS ALCOHOLISM,
       CASE WHEN e.user_id % 50 = 0 THEN 1 ELSE 0 END AS HANDICAP,
       CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE 0 END AS SMS_RECEIVED,
       CASE WHEN (e.event_type = 'error' AND e.event_id % 41 >= 10)
              OR (e.event_type = 'click' AND e.event_id % 41 >= 30)
            THEN 'Yes' ELSE 'No' END AS NO_SHOW
FROM events e JOIN nation n ON e.user_id % 25 = n.n_nationkey
"""

SCORED_SQL = """
SELECT APPOINTMENTID,
       CASE WHEN NO_SHOW = 'Yes' THEN 1 ELSE 0 END AS label,
       CAST((APPOINTMENTID % 41) * 20 + (APPOINTMENTID * 7919) % 200 AS DOUBLE) / 1020 AS SCORE
FROM appointments
"""


def with_ctes(body: str, **extra: str) -> str:
    """Prefix an oracle query with the ``appointments`` CTE (and more CTEs)."""
    parts = [f"appointments AS ({APPOINTMENTS_SQL})"]
    for name, sql in extra.items():
        parts.append(f"{name} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n" + body
