"""Command-line jobs (``python -m truant.jobs <job> ...``, or ``spark-submit
--py-files truant.zip truant/jobs.py <job> ...``): the training, tuning,
comparison, evaluation, scoring and profiling runs of the original scripts, as
Spark jobs.

    train    --input PATH [--format parquet|csv|table] --model-dir DIR [--params JSON] [--tuned DIR] [--no-select]
    tune     --input PATH --output DIR [--evals N] [--folds K]
    compare  --input PATH --output DIR [--params JSON]
    evaluate --input PATH --model-dir DIR --output DIR
    sample   --input PATH --output DIR --rest DIR
    score    --input PATH --model-dir DIR --output DIR
    stream   --input-dir DIR --model-dir DIR --output DIR --checkpoint DIR [--requests] [--continuous]
    eda      --input PATH --output DIR
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from truant.operators import clean, models, profile
from truant.plans import scoring, training
from truant.session import get_session, plan_bytes, ship_package, sized_conf
from truant.sources import tables
from truant.streaming import score as stream


def read_input(spark: SparkSession, path: str, fmt: str, errors: str | None = None) -> DataFrame:
    """The input rows; unreadable CSV lines are written to ``errors`` if given.

    Scan and shuffle sizes are set from the bytes that the input holds.
    """
    if fmt == "csv":
        if errors:
            tables.csv_errors(spark, path).write.mode("overwrite").parquet(errors)
        df = tables.scan_csv(spark, path)
    elif fmt == "table":
        df = tables.scan_table(spark, path)
    else:
        df = clean.normalize_columns(spark.read.parquet(path))
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for k, v in sized_conf(plan_bytes(df), min_partitions=at_least).items():
        spark.conf.set(k, v)
    return df


def _params(spark, a) -> dict | None:
    params = training.load_params(spark, a.tuned) if getattr(a, "tuned", None) else {}
    return {**params, **(json.loads(a.params) if a.params else {})} or None


def cmd_train(spark, a) -> None:
    raw = read_input(spark, a.input, a.format, f"{a.model_dir}/input_errors")
    t = training.train(raw, _params(spark, a), select=not a.no_select, out_dir=a.model_dir)
    print(json.dumps({k: (float(v) if v is not None else None) for k, v in t.metrics.items()}))


def cmd_tune(spark, a) -> None:
    """All draws, and the best parameters in the form ``train --tuned`` reads."""
    p = training.prepare(read_input(spark, a.input, a.format))
    t = models.tune(p.train, p.features, max_evals=a.evals, k=a.folds)
    t.draws.write.mode("overwrite").parquet(f"{a.output}/draws")
    training.save_params(spark, t.best, f"{a.output}/best")


def cmd_compare(spark, a) -> None:
    p = training.prepare(read_input(spark, a.input, a.format))
    models.compare_learners(p.train, p.features, gbt_params=_params(spark, a)).write.mode("overwrite").parquet(f"{a.output}/learners")
    models.compare_resamplings(p.train, p.test, p.features, gbt_params=_params(spark, a)).write.mode("overwrite").parquet(f"{a.output}/resamplings")


def cmd_evaluate(spark, a) -> None:
    scoring.evaluate_saved(spark, read_input(spark, a.input, a.format), a.model_dir).write.mode("overwrite").parquet(a.output)


def cmd_sample(spark, a) -> None:
    rest = scoring.write_unlabelled(read_input(spark, a.input, a.format), a.output)
    rest.write.mode("overwrite").parquet(a.rest)


def cmd_score(spark, a) -> None:
    raw = read_input(spark, a.input, a.format, f"{a.output}_errors")
    scoring.score_batch(spark, raw, a.model_dir, a.output)


def cmd_stream(spark, a) -> None:
    state, model = scoring.load(spark, a.model_dir)
    run = stream.score_requests_stream if a.requests else stream.score_stream
    run(spark, a.input_dir, state, model, a.output, a.checkpoint, available_now=not a.continuous)
    if a.continuous:
        spark.streams.awaitAnyTermination()


def cmd_eda(spark, a) -> None:
    df = read_input(spark, a.input, a.format)
    outs = {"overview": profile.noshow_overview(df), "nulls": profile.null_profile(df),
            "by_gender": profile.rate_by_gender(df), "by_days": profile.rate_by_days(df),
            "by_age_group": profile.rate_by_age_group(df)}
    for name, out in outs.items():
        out.write.mode("overwrite").parquet(f"{a.output}/{name}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="truant.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("train", "tune", "compare", "evaluate", "sample", "score", "eda"):
        s = sub.add_parser(name)
        s.add_argument("--input", required=True)
        s.add_argument("--format", default="parquet", choices=["parquet", "csv", "table"])
        if name in ("train", "score", "evaluate"):
            s.add_argument("--model-dir", required=True)
        if name != "train":
            s.add_argument("--output", required=True)
        if name in ("train", "compare"):
            s.add_argument("--params", default=None)
        if name == "train":
            s.add_argument("--tuned", default=None)
            s.add_argument("--no-select", action="store_true")
        if name == "tune":
            s.add_argument("--evals", type=int, default=models.MAX_EVALS)
            s.add_argument("--folds", type=int, default=models.FOLDS)
        if name == "sample":
            s.add_argument("--rest", required=True)
    s = sub.add_parser("stream")
    for arg in ("--input-dir", "--model-dir", "--output", "--checkpoint"):
        s.add_argument(arg, required=True)
    s.add_argument("--requests", action="store_true")
    s.add_argument("--continuous", action="store_true")
    a = p.parse_args(argv)
    spark = get_session()
    ship_package(spark)
    globals()[f"cmd_{a.job}"](spark, a)


if __name__ == "__main__":
    main()
