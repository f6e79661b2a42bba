"""DuckDB text fragments shared by the oracle queries (CTE builders)."""

from __future__ import annotations

from truant.functions.hashing import sql_hash60

DAYS_TILL_SQL = ("CAST(floor((epoch_us(APPOINTMENTDAY) - epoch_us(SCHEDULEDDAY)) / 86400000000) + 1"
                 " AS BIGINT)")
PREPROCESSED_SQL = f"""
SELECT APPOINTMENTID, GENDER, SCHEDULEDDAY, APPOINTMENTDAY, AGE, NEIGHBOURHOOD,
       SCHOLARSHIP, HYPERTENSION, DIABETES, ALCOHOLISM, HANDICAP, SMS_RECEIVED,
       CAST(CASE NO_SHOW WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS INT) AS NO_SHOW
FROM appointments
WHERE {DAYS_TILL_SQL} >= 0 AND AGE >= 0
"""
AGE_BUCKET_SQL = ("CASE WHEN AGE >= 0 AND AGE < 13 THEN '0-12' WHEN AGE >= 13 AND AGE < 18 THEN '13-17'"
                  " WHEN AGE >= 18 AND AGE < 31 THEN '18-30' WHEN AGE >= 31 AND AGE < 51 THEN '31-50'"
                  " WHEN AGE >= 51 THEN '50+' END")
GENDER_AGE_SQL = f"(GENDER || '_' || ({AGE_BUCKET_SQL}))"
GENDER_AGE_CATEGORIES = [f"{g}_{b}" for g in ("F", "M") for b in ("0-12", "13-17", "18-30", "31-50", "50+")]
FLAGS = ["SCHOLARSHIP", "HYPERTENSION", "DIABETES", "ALCOHOLISM", "HANDICAP", "SMS_RECEIVED"]


def rank_cte(src: str, target: str, seed: int, key: str = "APPOINTMENTID") -> str:
    h = sql_hash60(seed, key)
    return (f"SELECT x.*, row_number() OVER (PARTITION BY CAST(x.{target} AS VARCHAR)"
            f" ORDER BY {h}, x.{key}) AS __r FROM {src} x")


def split_ctes(src: str, name: str, target: str = "NO_SHOW", seed: int = 42,
               test_size: str = "0.2") -> dict[str, str]:
    """CTEs ending in ``name`` = src columns + ``split`` ('train'/'test')."""
    return {
        f"{name}_cls": f"SELECT CAST({target} AS VARCHAR) AS s, COUNT(*) AS n FROM {src} GROUP BY 1",
        f"{name}_tot": (f"SELECT SUM(n) AS n_all, CAST(ceil({test_size} * SUM(n)) AS BIGINT) AS t_all"
                        f" FROM {name}_cls"),
        f"{name}_alloc": (f"SELECT s, CAST(floor(t_all * n / n_all) AS BIGINT) AS base,"
                          f" t_all * n / n_all - floor(t_all * n / n_all) AS frac FROM {name}_cls, {name}_tot"),
        f"{name}_quota": (f"SELECT s, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, s)"
                          f" <= (SELECT t_all FROM {name}_tot) - (SELECT SUM(base) FROM {name}_alloc)"
                          f" THEN 1 ELSE 0 END AS q FROM {name}_alloc"),
        f"{name}_ranked": rank_cte(src, target, seed),
        name: (f"SELECT r.* EXCLUDE (__r), CASE WHEN __r <= q THEN 'test' ELSE 'train' END AS split"
               f" FROM {name}_ranked r JOIN {name}_quota qq ON CAST(r.{target} AS VARCHAR) = qq.s"),
    }


def target_encoding_ctes(train: str, name: str, col: str = "NEIGHBOURHOOD", target: str = "NO_SHOW",
                         k: float = 20.0, f: float = 10.0) -> dict[str, str]:
    """``name`` = (col, n, mean, value); ``{name}_prior`` = (prior)."""
    return {
        f"{name}_prior": f"SELECT AVG(CAST({target} AS DOUBLE)) AS prior FROM {train}",
        f"{name}_stats": (f"SELECT {col}, COUNT(*) AS n, AVG(CAST({target} AS DOUBLE)) AS mean"
                          f" FROM {train} GROUP BY 1"),
        name: (f"SELECT {col}, n, mean, CASE WHEN n = 1 THEN prior ELSE"
               f" (1.0 / (1.0 + exp(-(n - {k}) / {f}))) * mean"
               f" + (1.0 - 1.0 / (1.0 + exp(-(n - {k}) / {f}))) * prior END AS value"
               f" FROM {name}_stats, {name}_prior"),
    }


def features_select(src: str, te: str, categories=GENDER_AGE_CATEGORIES, digits: int = 9) -> str:
    """Model table of ``src`` (preprocessed rows) with the encoding ``te``;
    both year columns dropped (constant on the fixture)."""
    dummies = ", ".join(f"CASE WHEN {GENDER_AGE_SQL} = '{c}' THEN 1 ELSE 0 END AS \"GENDER_AGE_{c}\""
                        for c in categories[1:])
    return f"""
SELECT s.APPOINTMENTID,
       CAST(CASE s.GENDER WHEN 'M' THEN 1 WHEN 'F' THEN 0 END AS INT) AS GENDER,
       s.AGE,
       ROUND(COALESCE(t.value, (SELECT prior FROM {te}_prior)), {digits}) AS NEIGHBOURHOOD,
       {", ".join("s." + c for c in FLAGS)},
       {DAYS_TILL_SQL} AS DAYS_TILL_APPOINTMENT,
       CAST(month(SCHEDULEDDAY) AS INT) AS SCHEDULEDDAY_MONTH, CAST(day(SCHEDULEDDAY) AS INT) AS SCHEDULEDDAY_DAY,
       CAST(month(APPOINTMENTDAY) AS INT) AS APPOINTMENTDAY_MONTH,
       CAST(day(APPOINTMENTDAY) AS INT) AS APPOINTMENTDAY_DAY,
       {dummies},
       s.NO_SHOW
FROM {src} s LEFT JOIN {te} t ON s.NEIGHBOURHOOD = t.NEIGHBOURHOOD"""
