"""Registered queries: scans, projections, filters and profiling aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from truant.fixtures import appointments, table, with_ctes
from truant.functions.bands import case_band
from truant.functions.dates import date_part_columns, days_between_calendar
from truant.operators import clean, profile
from truant.plans.catalog import query
from truant.plans.oracle_sql import DAYS_TILL_SQL, PREPROCESSED_SQL
from truant.schema import COLUMNS

# ------------------------------------------------------------ shared SQL text
MISSED = "CASE WHEN NO_SHOW = 'Yes' THEN 1 ELSE 0 END"
# The age bands of the warehouse question, as SQL.
CASE_BAND_SQL = ("CASE WHEN AGE BETWEEN 0 AND 12 THEN '0-12' WHEN AGE BETWEEN 13 AND 17 THEN '13-17'"
                 " WHEN AGE BETWEEN 18 AND 30 THEN '18-30' WHEN AGE BETWEEN 31 AND 50 THEN '31-50'"
                 " ELSE '50+' END")
CALENDAR_DAYS_SQL = "CAST(datediff('day', SCHEDULEDDAY, APPOINTMENTDAY) AS INT)"


def _rate_sql(key_sql: str, key_name: str, source: str = "appointments") -> str:
    return with_ctes(f"""
SELECT {key_sql} AS {key_name},
       CAST(COUNT(*) AS BIGINT) AS Total_Appointments,
       CAST(SUM({MISSED}) AS BIGINT) AS Missed_Appointments,
       ROUND(SUM({MISSED}) / COUNT(*) * 100, 1) AS Percentage_Missed
FROM {source} GROUP BY 1""")


# ------------------------------------------------------------------- scans
@query("scan_table", with_ctes("SELECT * FROM appointments"))
def q_scan_table(spark, sf):
    return appointments(spark, sf)


# The spellings of the public dataset's header row.
SOURCE_HEADER = ["PatientId", "AppointmentID", "Gender", "ScheduledDay", "AppointmentDay", "Age",
                 "Neighbourhood", "Scholarship", "Hipertension", "Diabetes", "Alcoholism",
                 "Handcap", "SMS_received", "No-show"]


@query("normalize_columns", with_ctes("SELECT * FROM appointments"))
def q_normalize_columns(spark, sf):
    raw = appointments(spark, sf).toDF(*SOURCE_HEADER)
    return clean.normalize_columns(raw)


@query("project_cols", with_ctes("SELECT APPOINTMENTID, AGE, NO_SHOW FROM appointments"))
def q_project_cols(spark, sf):
    return clean.project_cols(appointments(spark, sf), ["APPOINTMENTID", "AGE", "NO_SHOW"])


@query("drop_cols", with_ctes("SELECT * EXCLUDE (PATIENTID) FROM appointments"))
def q_drop_cols(spark, sf):
    return clean.drop_cols(appointments(spark, sf), ["PATIENTID"])


@query("set_key", with_ctes("SELECT * FROM appointments"))
def q_set_key(spark, sf):
    return clean.set_key(appointments(spark, sf), check=True)


@query("duplicate_keys", with_ctes(
    "SELECT PATIENTID, CAST(COUNT(*) AS BIGINT) AS n FROM appointments GROUP BY 1 HAVING COUNT(*) > 1"))
def q_duplicate_keys(spark, sf):
    return clean.duplicate_keys(appointments(spark, sf), "PATIENTID")


@query("reorder_target_last", with_ctes("SELECT * FROM appointments"))
def q_reorder_target_last(spark, sf):
    a = appointments(spark, sf)
    return clean.reorder_target_last(a.select("NO_SHOW", *[c for c in a.columns if c != "NO_SHOW"]))


@query("map_values", with_ctes(
    "SELECT APPOINTMENTID, CAST(CASE NO_SHOW WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS INT) AS NO_SHOW"
    " FROM appointments"))
def q_map_values(spark, sf):
    return clean.encode_target(appointments(spark, sf)).select("APPOINTMENTID", "NO_SHOW")


@query("encode_gender", with_ctes(
    "SELECT APPOINTMENTID, CAST(CASE GENDER WHEN 'M' THEN 1 WHEN 'F' THEN 0 END AS INT) AS GENDER"
    " FROM appointments"))
def q_encode_gender(spark, sf):
    return clean.encode_gender(appointments(spark, sf)).select("APPOINTMENTID", "GENDER")


@query("filter_valid_dates", with_ctes(f"SELECT * FROM appointments WHERE {DAYS_TILL_SQL} >= 0"))
def q_filter_valid_dates(spark, sf):
    return clean.filter_valid_dates(appointments(spark, sf))


@query("list_invalid_dates", with_ctes(
    f"SELECT *, {DAYS_TILL_SQL} AS DAYS_TILL_APPOINTMENT FROM appointments WHERE {DAYS_TILL_SQL} < 0"))
def q_list_invalid_dates(spark, sf):
    return clean.list_invalid_dates(appointments(spark, sf))


@query("count_invalid_dates", with_ctes(
    f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows FROM appointments WHERE {DAYS_TILL_SQL} < 0"))
def q_count_invalid_dates(spark, sf):
    return profile.row_count(clean.list_invalid_dates(appointments(spark, sf)))


@query("filter_valid_age", with_ctes("SELECT * FROM appointments WHERE AGE >= 0"))
def q_filter_valid_age(spark, sf):
    return clean.filter_valid_age(appointments(spark, sf))


@query("list_invalid_age", with_ctes("SELECT * FROM appointments WHERE AGE < 0"))
def q_list_invalid_age(spark, sf):
    return clean.list_invalid_age(appointments(spark, sf))


@query("preprocess", with_ctes(PREPROCESSED_SQL))
def q_preprocess(spark, sf):
    return clean.preprocess(appointments(spark, sf))


@query("filter_class", with_ctes("SELECT * FROM appointments WHERE NO_SHOW = 'Yes'"))
def q_filter_class(spark, sf):
    return clean.filter_class(appointments(spark, sf), "Yes")


@query("blank_target", with_ctes("SELECT * REPLACE (CAST(NULL AS VARCHAR) AS NO_SHOW) FROM appointments"))
def q_blank_target(spark, sf):
    return clean.blank_target(appointments(spark, sf))


@query("case_band", with_ctes(f"SELECT APPOINTMENTID, AGE, {CASE_BAND_SQL} AS AgeGroup FROM appointments"))
def q_case_band(spark, sf):
    return appointments(spark, sf).select("APPOINTMENTID", "AGE", case_band("AGE").alias("AgeGroup"))


# --------------------------------------------------------------- aggregates
@query("row_count", with_ctes("SELECT CAST(COUNT(*) AS BIGINT) AS n_rows FROM appointments"))
def q_row_count(spark, sf):
    return profile.row_count(appointments(spark, sf))


@query("shape", with_ctes(
    "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(14 AS BIGINT) AS n_cols FROM appointments"))
def q_shape(spark, sf):
    return profile.shape(appointments(spark, sf))


@query("noshow_overview", with_ctes(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS Total_Appointments,
       CAST(SUM({MISSED}) AS BIGINT) AS No_Show_Appointments,
       ROUND(SUM({MISSED}) / COUNT(*) * 100, 1) AS No_Show_Percentage,
       CAST(SUM(CASE WHEN NO_SHOW = 'No' THEN 1 ELSE 0 END) AS BIGINT) AS Show_Appointments,
       ROUND(SUM(CASE WHEN NO_SHOW = 'No' THEN 1 ELSE 0 END) / COUNT(*) * 100, 1) AS Show_Percentage
FROM appointments"""))
def q_noshow_overview(spark, sf):
    return profile.noshow_overview(appointments(spark, sf))


@query("null_profile", with_ctes(
    "SELECT " + ", ".join(f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS Missing_{c}"
                          for c in COLUMNS) + " FROM appointments"))
def q_null_profile(spark, sf):
    return profile.null_profile(appointments(spark, sf), COLUMNS)


@query("drop_sparse_columns", with_ctes(
    "SELECT a.*, COALESCE(l.toxic, 0) AS toxic"
    " FROM appointments a LEFT JOIN labels l ON a.APPOINTMENTID = l.doc_id"))
def q_drop_sparse_columns(spark, sf):
    a = appointments(spark, sf)
    lab = table(spark, sf, "labels")
    # quality is null on most rows (> 80 %) and is dropped; toxic is filled
    j = a.join(lab, a.APPOINTMENTID == lab.doc_id, "left")
    j = j.select(*a.columns, "quality", F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return profile.drop_sparse_columns(j, 0.8)


@query("rate_by_gender", _rate_sql("GENDER", "GENDER"))
def q_rate_by_gender(spark, sf):
    return profile.rate_by_gender(appointments(spark, sf))


@query("rate_by_days", _rate_sql(CALENDAR_DAYS_SQL, "DaysDifference"))
def q_rate_by_days(spark, sf):
    return profile.rate_by_days(appointments(spark, sf))


@query("rate_by_age_group", _rate_sql(CASE_BAND_SQL, "AgeGroup"))
def q_rate_by_age_group(spark, sf):
    return profile.rate_by_age_group(appointments(spark, sf))


@query("days_between_calendar", with_ctes(
    f"SELECT APPOINTMENTID, {CALENDAR_DAYS_SQL} AS DaysDifference, NO_SHOW FROM appointments"))
def q_days_between_calendar(spark, sf):
    return appointments(spark, sf).select(
        "APPOINTMENTID", days_between_calendar().alias("DaysDifference"), "NO_SHOW")


@query("limit_n", with_ctes(f"""
SELECT APPOINTMENTID, {CALENDAR_DAYS_SQL} AS DaysDifference, NO_SHOW,
       CAST(row_number() OVER (ORDER BY {CALENDAR_DAYS_SQL} DESC, APPOINTMENTID) AS INT) AS rank
FROM appointments ORDER BY rank LIMIT 20"""))
def q_limit_n(spark, sf):
    """Top 20 by waiting days: top-k per partition, then a 20-row merge."""
    a = appointments(spark, sf).select(
        "APPOINTMENTID", days_between_calendar().alias("DaysDifference"), "NO_SHOW")
    order = [F.desc("DaysDifference"), F.asc("APPOINTMENTID")]
    top = a.orderBy(*order).limit(20)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


@query("order_by", "SELECT *, CAST(row_number() OVER (ORDER BY Percentage_Missed DESC, AgeGroup) AS INT) AS rank"
                   f" FROM ({_rate_sql(CASE_BAND_SQL, 'AgeGroup')}) t")
def q_order_by(spark, sf):
    """Age groups by falling miss rate; the rank makes the order part of the result (five rows)."""
    order = [F.desc("Percentage_Missed"), F.asc("AgeGroup")]
    rates = profile.rate_by_age_group(appointments(spark, sf))
    return rates.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy("rank")


@query("value_counts", with_ctes(
    "SELECT NEIGHBOURHOOD, CAST(COUNT(*) AS BIGINT) AS count FROM appointments GROUP BY 1"))
def q_value_counts(spark, sf):
    return profile.value_counts(appointments(spark, sf), "NEIGHBOURHOOD")


@query("value_shares", with_ctes(
    "SELECT GENDER, ROUND(COUNT(*) / SUM(COUNT(*)) OVER () * 100, 1) AS percentage"
    " FROM appointments GROUP BY 1"))
def q_value_shares(spark, sf):
    return profile.value_shares(appointments(spark, sf), "GENDER")


_CLASS_DIST_SQL = with_ctes(
    "SELECT NO_SHOW, CAST(COUNT(*) AS BIGINT) AS count,"
    " ROUND(COUNT(*) / SUM(COUNT(*)) OVER () * 100, 2) AS percentage FROM appointments GROUP BY 1")


@query("class_distribution", _CLASS_DIST_SQL)
def q_class_distribution(spark, sf):
    return profile.class_distribution(appointments(spark, sf))


@query("join_distribution", _CLASS_DIST_SQL)
def q_join_distribution(spark, sf):
    return profile.join_distribution(appointments(spark, sf))


@query("distinct_count", with_ctes(
    "SELECT " + ", ".join(f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct_{c}" for c in COLUMNS)
    + " FROM appointments"))
def q_distinct_count(spark, sf):
    return profile.distinct_count(appointments(spark, sf), COLUMNS)


@query("distinct_values", with_ctes("SELECT DISTINCT NEIGHBOURHOOD FROM appointments"))
def q_distinct_values(spark, sf):
    return profile.distinct_values(appointments(spark, sf), "NEIGHBOURHOOD")


@query("min_max", with_ctes("SELECT MIN(AGE) AS min_AGE, MAX(AGE) AS max_AGE FROM appointments"))
def q_min_max(spark, sf):
    return profile.min_max(appointments(spark, sf), "AGE")


@query("min_max_clean", with_ctes("SELECT MIN(AGE) AS min_AGE, MAX(AGE) AS max_AGE FROM p",
                                  p=PREPROCESSED_SQL))
def q_min_max_clean(spark, sf):
    return profile.min_max(clean.preprocess(appointments(spark, sf)), "AGE")


_DATE_PARTS = ["SCHEDULEDDAY_YEAR", "SCHEDULEDDAY_MONTH", "SCHEDULEDDAY_DAY",
               "APPOINTMENTDAY_YEAR", "APPOINTMENTDAY_MONTH", "APPOINTMENTDAY_DAY"]


def _const_sql(source: str) -> str:
    parts = {"SCHEDULEDDAY_YEAR": "year(SCHEDULEDDAY)", "SCHEDULEDDAY_MONTH": "month(SCHEDULEDDAY)",
             "SCHEDULEDDAY_DAY": "day(SCHEDULEDDAY)", "APPOINTMENTDAY_YEAR": "year(APPOINTMENTDAY)",
             "APPOINTMENTDAY_MONTH": "month(APPOINTMENTDAY)", "APPOINTMENTDAY_DAY": "day(APPOINTMENTDAY)"}
    sel = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(COUNT(DISTINCT {e}) = 1 AS INT) AS is_constant FROM {source}"
        for c, e in parts.items())
    return sel


@query("constant_columns", with_ctes(_const_sql("appointments")))
def q_constant_columns(spark, sf):
    a = appointments(spark, sf).withColumns(date_part_columns())
    return profile.constant_columns(a, _DATE_PARTS)


@query("constant_columns_clean", with_ctes(_const_sql("p"), p=PREPROCESSED_SQL))
def q_constant_columns_clean(spark, sf):
    a = clean.preprocess(appointments(spark, sf)).withColumns(date_part_columns())
    return profile.constant_columns(a, _DATE_PARTS)


@query("crosstab", with_ctes(
    "SELECT GENDER, NO_SHOW, CAST(COUNT(*) AS BIGINT) AS count FROM appointments GROUP BY 1, 2"))
def q_crosstab(spark, sf):
    return profile.crosstab(appointments(spark, sf), "GENDER", "NO_SHOW")


_MOMENT_COLS = ["AGE", "SCHOLARSHIP", "HYPERTENSION", "SMS_RECEIVED"]


@query("moments", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(AVG(CAST({c} AS DOUBLE)), 9) + 0.0 AS mean,"
    f" ROUND(STDDEV_POP(CAST({c} AS DOUBLE)), 9) + 0.0 AS std_pop,"
    f" ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 9) + 0.0 AS std_samp FROM appointments"
    for c in _MOMENT_COLS)))
def q_moments(spark, sf):
    return profile.moments(appointments(spark, sf), _MOMENT_COLS)


_APPROX_COLS = ["PATIENTID", "APPOINTMENTID", "GENDER", "AGE", "NEIGHBOURHOOD"]


@query("distinct_count_approx", "SELECT " + ", ".join(f"1 AS within_{c}" for c in _APPROX_COLS))
def q_distinct_count_approx(spark, sf):
    """Whether the approximate counts lie within 15 % (three times the stated error) of the exact ones."""
    a = appointments(spark, sf)
    exact = profile.distinct_count(a, _APPROX_COLS)
    near = profile.distinct_count(a, _APPROX_COLS, exact=False).toDF(*[f"near_{c}" for c in _APPROX_COLS])
    return near.select(*[(F.abs(F.col(f"near_{c}") / exact.select(f"n_distinct_{c}").scalar() - 1) <= 0.15).cast("int").alias(f"within_{c}")
                         for c in _APPROX_COLS])
