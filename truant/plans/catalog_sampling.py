"""Registered queries: exact stratified sampling and class balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from truant.fixtures import appointments, table, with_ctes
from truant.functions.dates import days_till_appointment
from truant.functions.hashing import hash60, sql_hash60
from truant.operators import clean, encode, sampling
from truant.operators.knn_graph import knn_graph
from truant.operators.smote import knn_distinct, smote
from truant.plans.catalog import query
from truant.plans.oracle_sql import DAYS_TILL_SQL, PREPROCESSED_SQL, rank_cte, split_ctes
from truant.session import materialize


def _pre(spark, sf):
    return clean.preprocess(appointments(spark, sf))


@query("stratified_split", with_ctes("SELECT APPOINTMENTID, NO_SHOW, split FROM sp",
                                     p=PREPROCESSED_SQL, **split_ctes("p", "sp")))
def q_stratified_split(spark, sf):
    return sampling.stratified_split(_pre(spark, sf)).select("APPOINTMENTID", "NO_SHOW", "split")


@query("split_check", with_ctes(
    "SELECT split, NO_SHOW, CAST(COUNT(*) AS BIGINT) AS count,"
    " ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY split) * 100, 2) AS percentage"
    " FROM sp GROUP BY 1, 2", p=PREPROCESSED_SQL, **split_ctes("p", "sp")))
def q_split_check(spark, sf):
    return sampling.split_check(sampling.stratified_split(_pre(spark, sf)))


@query("simulated_set", with_ctes(
    "SELECT * EXCLUDE (split) REPLACE (CAST(NULL AS VARCHAR) AS NO_SHOW) FROM sp WHERE split = 'test'",
    **split_ctes("appointments", "sp")))
def q_simulated_set(spark, sf):
    """The unlabelled scoring set: a stratified 20 % of the raw table, target blanked."""
    s = sampling.stratified_split(appointments(spark, sf))
    return clean.blank_target(s.where(F.col("split") == "test").drop("split"))


_NULL_KEYS = dict(
    src=PREPROCESSED_SQL,
    nk="SELECT CASE WHEN APPOINTMENTID % 10 = 3 THEN NULL ELSE APPOINTMENTID END AS APPOINTMENTID, NO_SHOW FROM src")


@query("split_null_keys", with_ctes(
    "SELECT NO_SHOW, split, CAST(COUNT(*) AS BIGINT) AS n, (SELECT CAST(COUNT(*) AS BIGINT) FROM nk) AS rows_in"
    " FROM sp GROUP BY 1, 2", **_NULL_KEYS, **split_ctes("nk", "sp")))
def q_split_null_keys(spark, sf):
    """A tenth of the keys is null: quotas stay exact, and all rows come out."""
    a = _pre(spark, sf)
    key = F.when(F.col("APPOINTMENTID") % 10 != 3, F.col("APPOINTMENTID")).alias("APPOINTMENTID")
    nk = a.select(key, *[c for c in a.columns if c != "APPOINTMENTID"])
    out = sampling.stratified_split(nk).groupBy("NO_SHOW", "split").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("rows_in", nk.agg(F.count(F.lit(1))).scalar())


@query("kfold_null_keys", with_ctes(
    "SELECT NO_SHOW, CAST((r - 1) % 5 AS INT) AS fold, CAST(COUNT(*) AS BIGINT) AS n FROM"
    " (SELECT NO_SHOW, row_number() OVER (PARTITION BY NO_SHOW) AS r FROM nk) GROUP BY 1, 2", **_NULL_KEYS))
def q_kfold_null_keys(spark, sf):
    """A tenth of the keys is null: every row has a fold, sizes differ by one at most."""
    a = _pre(spark, sf)
    key = F.when(F.col("APPOINTMENTID") % 10 != 3, F.col("APPOINTMENTID")).alias("APPOINTMENTID")
    nk = a.select(key, *[c for c in a.columns if c != "APPOINTMENTID"])
    return sampling.stratified_kfold(nk, 5).groupBy("NO_SHOW", "fold").agg(F.count(F.lit(1)).alias("n"))


_WIDE = 10 << 32


@query("upsample_wide_index",
       f"SELECT event_id, {sql_hash60(123, 'event_id')} % {_WIDE} AS idx FROM events")
def q_upsample_wide_index(spark, sf):
    """The draw arithmetic of up-sampling for a class of 10 * 2^32 rows: every row can be drawn."""
    return table(spark, sf, "events").select("event_id", F.pmod(hash60(123, "event_id"), F.lit(_WIDE)).alias("idx"))


@query("stratified_kfold", with_ctes(
    "SELECT APPOINTMENTID, NO_SHOW, CAST((__r - 1) % 5 AS INT) AS fold FROM r",
    p=PREPROCESSED_SQL, r=rank_cte("p", "NO_SHOW", 42)))
def q_stratified_kfold(spark, sf):
    return sampling.stratified_kfold(_pre(spark, sf), 5).select("APPOINTMENTID", "NO_SHOW", "fold")


@query("class_rank", with_ctes(
    "SELECT APPOINTMENTID, NO_SHOW, __r AS class_rank FROM r",
    p=PREPROCESSED_SQL, r=rank_cte("p", "NO_SHOW", 42)))
def q_class_rank(spark, sf):
    return sampling.class_rank(_pre(spark, sf)).select("APPOINTMENTID", "NO_SHOW", "class_rank")


@query("downsample", with_ctes(
    "SELECT APPOINTMENTID, NO_SHOW FROM r WHERE NO_SHOW <> 0"
    " OR __r <= (SELECT COUNT(*) FROM p WHERE NO_SHOW <> 0)",
    p=PREPROCESSED_SQL, r=rank_cte("p", "NO_SHOW", 123)))
def q_downsample(spark, sf):
    return sampling.downsample(_pre(spark, sf), seed=123, majority=0).select("APPOINTMENTID", "NO_SHOW")


_H123_KEY = sql_hash60(123, "x.APPOINTMENTID")
_H123_J = sql_hash60(123, "j")


@query("upsample", with_ctes(
    "SELECT APPOINTMENTID, NO_SHOW FROM p WHERE NO_SHOW <> 1"
    " UNION ALL SELECT mino.APPOINTMENTID, mino.NO_SHOW FROM draws JOIN mino USING (idx)",
    p=PREPROCESSED_SQL,
    mino=f"SELECT x.*, row_number() OVER (ORDER BY {_H123_KEY}, x.APPOINTMENTID) - 1 AS idx"
         " FROM p x WHERE NO_SHOW = 1",
    cnt="SELECT COUNT(*) FILTER (WHERE NO_SHOW = 1) AS m, COUNT(*) FILTER (WHERE NO_SHOW <> 1) AS big FROM p",
    draws=f"SELECT {_H123_J} % (SELECT m FROM cnt) AS idx FROM range((SELECT big FROM cnt)) t(j)"))
def q_upsample(spark, sf):
    return sampling.upsample(_pre(spark, sf), seed=123, minority=1).select("APPOINTMENTID", "NO_SHOW")


@query("upsample_counts", with_ctes(
    "SELECT NO_SHOW, CAST(COUNT(*) AS BIGINT) AS count FROM u GROUP BY 1",
    p=PREPROCESSED_SQL,
    u="SELECT NO_SHOW FROM p WHERE NO_SHOW <> 1 UNION ALL"
      " SELECT 1 FROM range((SELECT COUNT(*) FROM p WHERE NO_SHOW <> 1)) t(j)"))
def q_upsample_counts(spark, sf):
    u = sampling.upsample(_pre(spark, sf), seed=123, minority=1)
    return u.groupBy("NO_SHOW").agg(F.count(F.lit(1)).alias("count"))


@query("concat_frames", with_ctes("SELECT * FROM p", p=PREPROCESSED_SQL))
def q_concat_frames(spark, sf):
    p = _pre(spark, sf)
    return clean.filter_class(p, 0, "NO_SHOW").unionByName(clean.filter_class(p, 1, "NO_SHOW"))


@query("balanced_weights", with_ctes(
    "SELECT NO_SHOW, CAST(COUNT(*) AS BIGINT) AS n,"
    " ROUND(SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)), 9) AS class_weight"
    " FROM p GROUP BY 1", p=PREPROCESSED_SQL))
def q_balanced_weights(spark, sf):
    return encode.class_weight_table(_pre(spark, sf), "NO_SHOW")


@query("resample_guard", with_ctes(
    "SELECT NO_SHOW, CAST(n AS BIGINT) AS available, CAST(total - n AS BIGINT) AS wanted,"
    " CAST(n >= total - n AS INT) AS without_replacement_ok FROM (SELECT NO_SHOW, COUNT(*) AS n,"
    " SUM(COUNT(*)) OVER () AS total FROM p GROUP BY 1)", p=PREPROCESSED_SQL))
def q_resample_guard(spark, sf):
    """Per class: rows available, rows wanted to match the other class, and
    whether that draw is possible without replacement (the guard's test)."""
    counts = sampling.stratum_counts(_pre(spark, sf), "NO_SHOW")
    total = sum(counts.values())
    rows = []
    for s_, n in counts.items():
        wanted = total - n
        try:
            sampling.resample_guard(n, wanted, False)
            ok = 1
        except ValueError:
            ok = 0
        rows.append((int(s_), n, wanted, ok))
    return spark.createDataFrame(rows, "NO_SHOW int, available long, wanted long, without_replacement_ok int")


# ------------------------------------------------------------------ SMOTE, exact oracle
# Raw features of the train split: integer-valued, so the vector id
# md5(to_json(v)) has the same text in Spark and DuckDB ('[23.0,1.0,...]').
_RAW = ["AGE", "DAYS_TILL_APPOINTMENT", "SCHOLARSHIP", "HYPERTENSION", "DIABETES", "ALCOHOLISM", "HANDICAP",
        "SMS_RECEIVED"]


def _smote_raw_sql(k: int = 5, seed: int = 42) -> str:
    """Brute-force DuckDB text of ``smote`` (all minority pairs; fine at test scale)."""
    from truant.functions.hashing import sql_hash_unit
    raw = [f"CAST({DAYS_TILL_SQL if c == 'DAYS_TILL_APPOINTMENT' else c} AS DOUBLE) AS {c}" for c in _RAW]
    vid = "md5('[' || concat_ws(',', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in _RAW) + ") || ']')"
    dist = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _RAW) + ")"
    ctes = dict(
        p=PREPROCESSED_SQL, **split_ctes("p", "sp"),
        train="SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'",
        r=f"SELECT APPOINTMENTID, {', '.join(raw)}, NO_SHOW FROM train",
        mr=f"SELECT *, {vid} AS vid FROM r WHERE NO_SHOW = 1",
        dv="SELECT vid, " + ", ".join(f"any_value({c}) AS {c}" for c in _RAW) + ", COUNT(*) AS c FROM mr GROUP BY vid",
        pairs=(f"SELECT a.vid AS q, b.vid AS nb, {dist} AS dist, b.c AS w FROM dv a JOIN dv b ON a.vid <> b.vid"
               " UNION ALL SELECT vid, vid, 0.0, c - 1 FROM dv WHERE c > 1"),
        rk=("SELECT *, CAST(SUM(w) OVER (PARTITION BY q ORDER BY dist, nb ROWS BETWEEN UNBOUNDED PRECEDING"
            " AND CURRENT ROW) AS BIGINT) AS cw FROM pairs"),
        slots=f"SELECT q, nb, UNNEST(range(cw - w, LEAST(cw, {k}))) AS slot FROM rk WHERE cw - w < {k}",
        cls="SELECT NO_SHOW AS s, COUNT(*) AS n FROM r GROUP BY 1",
        cnt=("SELECT (SELECT n FROM cls WHERE s = 1) AS m,"
             " (SELECT MAX(n) FROM cls) - (SELECT n FROM cls WHERE s = 1) AS n"),
        dr=(f"SELECT {sql_hash60(seed, 'j')} % m + 1 AS idx, {sql_hash60(seed + 1, 'j')} % {k} AS slot,"
            f" {sql_hash_unit(seed + 2, 'j')} AS gap FROM (SELECT m, UNNEST(range(0, n)) AS j FROM cnt)"),
        rnk=f"SELECT vid, {', '.join(_RAW)}, row_number() OVER (ORDER BY {sql_hash60(seed, 'APPOINTMENTID')},"
            " APPOINTMENTID) AS idx FROM mr",
    )
    syn = ("SELECT CAST(NULL AS BIGINT) AS APPOINTMENTID, "
           + ", ".join(f"ROUND(x.{c} + d.gap * (v.{c} - x.{c}), 9) AS {c}" for c in _RAW)
           + ", 1 AS NO_SHOW, 1 AS synthetic FROM dr d JOIN rnk x ON d.idx = x.idx"
           " JOIN slots s ON s.q = x.vid AND s.slot = d.slot JOIN dv v ON v.vid = s.nb")
    base = f"SELECT APPOINTMENTID, {', '.join(f'ROUND({c}, 9) AS {c}' for c in _RAW)}, NO_SHOW, 0 AS synthetic FROM r"
    return with_ctes(f"{base} UNION ALL {syn}", **ctes)


def _raw_train(spark, sf):
    s = sampling.stratified_split(_pre(spark, sf))
    return s.where(F.col("split") == "train").select(
        "APPOINTMENTID", *[days_till_appointment().alias(c) if c == "DAYS_TILL_APPOINTMENT" else F.col(c) for c in _RAW], "NO_SHOW")


@query("smote_raw", _smote_raw_sql())
def q_smote_raw(spark, sf):
    """SMOTE (exact 5-NN, seed 42) on the raw integer features of the train split."""
    out = smote(_raw_train(spark, sf), _RAW, "NO_SHOW", "APPOINTMENTID", 1, 5, 42)
    return out.select("APPOINTMENTID", *[F.round(c, 9).alias(c) for c in _RAW], "NO_SHOW", "synthetic")


_TRAIN_CTES = dict(p=PREPROCESSED_SQL, **split_ctes("p", "sp"), cls="SELECT NO_SHOW, COUNT(*) AS n FROM sp WHERE split = 'train' GROUP BY 1")


@query("smote_graph", with_ctes(
    "SELECT NO_SHOW, 0 AS synthetic, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) AS inside FROM cls"
    " UNION ALL SELECT 1, 1, (SELECT MAX(n) FROM cls) - n, (SELECT MAX(n) FROM cls) - n FROM cls WHERE NO_SHOW = 1", **_TRAIN_CTES))
def q_smote_graph(spark, sf):
    """SMOTE on the neighbour graph: classes are equal, and every row lies inside the box of its class."""
    train = _raw_train(spark, sf)
    out = smote(train, _RAW, "NO_SHOW", "APPOINTMENTID", 1, 5, 42, method="graph")
    box = train.groupBy("NO_SHOW").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in _RAW for f in (F.min, F.max)])
    within = F.lit(True)
    for c in _RAW:
        within &= F.col(c).between(F.col(f"min_{c}") - 1e-9, F.col(f"max_{c}") + 1e-9)
    return out.join(F.broadcast(box), "NO_SHOW").groupBy("NO_SHOW", "synthetic").agg(  # two classes
        F.count(F.lit(1)).alias("n_rows"), F.count_if(within).alias("inside"))


@query("knn_graph_recall", with_ctes(
    "SELECT COUNT(DISTINCT (" + ", ".join(f"{'x.days' if c == 'DAYS_TILL_APPOINTMENT' else 'x.' + c}" for c in _RAW) + ")) * 5 AS slots, 1 AS recall_ok"
    f" FROM (SELECT *, {DAYS_TILL_SQL} AS days FROM sp WHERE split = 'train' AND NO_SHOW = 1) x", **_TRAIN_CTES))
def q_knn_graph_recall(spark, sf):
    """Five neighbours of every distinct minority vector by the graph, held against the exact search: those no
    farther than the exact fifth one are at least nine of ten."""
    rows = _raw_train(spark, sf).where("NO_SHOW = 1").select(F.array(*[F.col(c).cast("double") for c in _RAW]).alias("v"))
    vectors = materialize(rows.groupBy(F.md5(F.to_json("v")).alias("vid")).agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("c")), "minority-vectors")
    fifth = knn_distinct(vectors, 5).groupBy("q").agg(F.max("dist").alias("fifth"))
    found = knn_graph(vectors, 5).join(fifth, "q").where(F.col("dist") <= F.col("fifth") + 1e-9).agg(F.coalesce(F.sum("w"), F.lit(0)).alias("hits"))
    return fifth.agg((F.count(F.lit(1)) * 5).alias("slots")).select("slots", (found.scalar() >= 0.9 * F.col("slots")).cast("int").alias("recall_ok"))
