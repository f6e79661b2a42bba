"""The appointment table: declared schema, names and the alias table."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "APPOINTMENTID"
PATIENT = "PATIENTID"
TARGET = "NO_SHOW"
SCHEDULED = "SCHEDULEDDAY"
APPOINTMENT = "APPOINTMENTDAY"

FLAG_COLUMNS = ["SCHOLARSHIP", "HYPERTENSION", "DIABETES", "ALCOHOLISM",
                "HANDICAP", "SMS_RECEIVED"]

APPOINTMENT_SCHEMA = T.StructType([
    T.StructField(PATIENT, T.DoubleType(), True),
    T.StructField(KEY, T.LongType(), True),
    T.StructField("GENDER", T.StringType(), True),
    T.StructField(SCHEDULED, T.TimestampType(), True),
    T.StructField(APPOINTMENT, T.TimestampType(), True),
    T.StructField("AGE", T.IntegerType(), True),
    T.StructField("NEIGHBOURHOOD", T.StringType(), True),
    *[T.StructField(c, T.IntegerType(), True) for c in FLAG_COLUMNS],
    T.StructField(TARGET, T.StringType(), True),
])

COLUMNS = [f.name for f in APPOINTMENT_SCHEMA.fields]

# Source column spellings renamed before loading (the public
# dataset's headers) -> the names used everywhere else.
COLUMN_ALIASES = {
    "HIPERTENSION": "HYPERTENSION",
    "HANDCAP": "HANDICAP",
    "NO-SHOW": "NO_SHOW",
}

# Target text -> label, gender text -> code.
TARGET_MAP = {"No": 0, "Yes": 1}
GENDER_MAP = {"M": 1, "F": 0}

# Age bands of the warehouse question (inclusive bounds) and
# the feature buckets [0,13) [13,18) [18,31) [31,51) [51,inf).
SQL_AGE_BANDS = [("0-12", 0, 12), ("13-17", 13, 17), ("18-30", 18, 30), ("31-50", 31, 50)]
SQL_AGE_ELSE = "50+"
AGE_BUCKET_EDGES = [0, 13, 18, 31, 51]
AGE_BUCKET_LABELS = ["0-12", "13-17", "18-30", "31-50", "50+"]
