"""One frozen feature state shared by training, batch scoring and streams.

Everything data-dependent in the original pipeline (dummy columns, dropped
constant year columns, the neighbourhood encoding, scaling moments, the
selected feature list) is decided once on the training frame, saved, and
applied unchanged to any later frame -- including a stream, where such
decisions (e.g. a distinct count) are not even allowed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truant.operators import clean, encode, features
from truant.schema import TARGET
from truant.session import materialize


@dataclass
class FeatureState:
    categories: list[str]
    drop_years: list[str]
    te: encode.TargetEncoding
    selected: list[str] | None = None
    scaling: encode.Scaling | None = None
    extra: dict = field(default_factory=dict)

    # ----------------------------------------------------------- persistence
    def save(self, path: str) -> None:
        """Small metadata as JSON, the encoding table as Parquet."""
        spark = self.te.table.sparkSession
        self.te.table.write.mode("overwrite").parquet(f"{path}/target_encoding")
        meta = {
            "categories": self.categories, "drop_years": self.drop_years,
            "te": {"column": self.te.column, "prior": self.te.prior,
                   "n_categories": self.te.n_categories, "params": self.te.params},
            "selected": self.selected,
            "scaling": None if self.scaling is None else
            {"mean": self.scaling.mean, "std": self.scaling.std},
            "extra": self.extra,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
             .write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureState":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        table = spark.read.parquet(f"{path}/target_encoding")
        te = encode.TargetEncoding(meta["te"]["column"], meta["te"]["prior"], table,
                                   meta["te"]["n_categories"], meta["te"]["params"])
        sc = meta.get("scaling")
        return FeatureState(meta["categories"], meta["drop_years"], te, meta.get("selected"),
                            encode.Scaling(sc["mean"], sc["std"]) if sc else None,
                            meta.get("extra") or {})


def base_features(df: DataFrame) -> DataFrame:
    """Steps that need no fitted state: gender-age key and waiting days."""
    return features.add_days_till(features.add_gender_age(df))


def fit_feature_state(train: DataFrame, target: str = TARGET, min_samples_leaf: float = 20.0,
                      smoothing: float = 10.0, max_categories: int = encode.MAX_CATEGORIES) -> FeatureState:
    """``train`` is the preprocessed training frame (target encoded 0/1).

    All data-dependent decisions come from ONE scan: a grouping-sets
    aggregate with the sets (GENDER_AGE), (NEIGHBOURHOOD) and () gives the
    dummy categories, the per-neighbourhood target statistics and the
    global year ranges and prior at once.
    """
    b = base_features(train)
    years = {c: e for c, e in features.date_part_columns().items() if c in features.YEAR_PARTS}
    b = b.withColumns(years).select("GENDER_AGE", "NEIGHBOURHOOD", target, *years)
    y = F.col(target).cast("double")
    g = materialize(b.groupingSets([["GENDER_AGE"], ["NEIGHBOURHOOD"], []], "GENDER_AGE", "NEIGHBOURHOOD")
          .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("rows"),
               F.count(y).alias("n"), F.sum(y).alias("s"),
               *[F.min(c).alias(f"mn_{c}") for c in years], *[F.max(c).alias(f"mx_{c}") for c in years]), "feature-sets")
    # gid bits: GENDER_AGE (2), NEIGHBOURHOOD (1); set 1 = (GENDER_AGE), 2 = (NEIGHBOURHOOD), 3 = ()
    tot = g.where(F.col("gid") == 3).first()
    drop_years = [c for c in years if tot[f"mn_{c}"] is not None and tot[f"mn_{c}"] == tot[f"mx_{c}"]]
    cats = (g.where((F.col("gid") == 1) & F.col("GENDER_AGE").isNotNull()).select("GENDER_AGE")
             .limit(max_categories + 1).collect())
    if len(cats) > max_categories:
        raise ValueError(f"GENDER_AGE has more than {max_categories} categories")
    categories = sorted(str(r[0]) for r in cats)
    prior = (tot["s"] / tot["n"]) if tot["n"] else 0.0
    stats = (g.where((F.col("gid") == 2) & F.col("NEIGHBOURHOOD").isNotNull() & (F.col("n") > 0))
              .select("NEIGHBOURHOOD", "n", "s"))
    te = encode.target_encoding_from_stats(stats, "NEIGHBOURHOOD", prior, min_samples_leaf, smoothing)
    return FeatureState(categories, drop_years, te)


def apply_features(df: DataFrame, state: FeatureState, target: str = TARGET) -> DataFrame:
    """Preprocessed frame -> model table (the column order of the original)."""
    out = base_features(df)
    out = features.add_date_parts(out, state.drop_years)
    out = clean.encode_gender(out)
    out = encode.one_hot(out, "GENDER_AGE", state.categories)
    out = clean.reorder_target_last(out, target)
    out = state.te.transform(out)
    if state.scaling is not None:
        out = state.scaling.transform(out)
    return out


def feature_columns(df: DataFrame, key: str = "APPOINTMENTID", target: str = TARGET) -> list[str]:
    return [c for c in df.columns if c not in (key, target, "split", "fold", "weight")]
