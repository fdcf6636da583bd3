"""Benchmark the headline pipeline at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Stages run in order on one session, each timed on its own (upstream stages
are already materialized when a later stage starts):

  clean      raw listings view → cleaned rows + funnel report (dedup, medians,
             exact quantile trim, one-pass counters)
  encode     listing features → hash split → encoding fit (train ∧ buy) →
             applied to every row → model table (materialized)
  profile    missing values, feature summary, correlations, histograms,
             price–area trend, category shares, top property types
  train      linear regression, decision tree, random forest (shipped
             parameters) fitted on train, evaluated on all splits; each
             model's seconds are reported in "model_fit_and_evaluate"
  score      every raw listing scored with the saved bundle values

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from aqarlens.catalog import queries as q  # noqa: E402
from aqarlens.session import session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(app_name="aqarlens-bench")
    # Session start-up (class loading, first job) is not query time.
    spark.range(1000).selectExpr("sum(id)").collect()
    timings: dict[str, float] = {}

    def timed(name, fn):
        start = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - start, 3)

    def clean():
        frame, report, _ = q.cleaning(spark, sf_dir)
        report.check()
        frame.count()

    def encode():
        q.model_table(spark, sf_dir).count()
        q.encoded(spark, sf_dir).agg(F.count(F.lit(1))).collect()

    profile_times: dict[str, float] = {}
    trained: dict[str, object] = {}

    def profile():
        for name in (
            "missing_values", "feature_summary", "feature_correlations", "correlation_matrix",
            "price_histogram", "target_histogram", "price_area_trend", "category_shares",
            "top_property_types", "city_price_summary",
        ):
            start = time.perf_counter()
            q.QUERIES[name](spark, sf_dir).collect()
            profile_times[name] = round(time.perf_counter() - start, 3)

    model_times: dict[str, float] = {}

    def train():
        results, best = q.train_models(
            q.model_table(spark, sf_dir), q.DEFAULT_MODEL_PARAMS, materialize_mode="none", timings=model_times
        )
        results.collect()
        trained["best"] = best

    def score():
        best = trained["best"]
        _, _, cleaning_model = q.cleaning(spark, sf_dir)
        bundle = q.ModelBundle(
            model=best["model"], model_name=best["model_name"],
            encoding=q.encoding(spark, sf_dir), cleaning=cleaning_model,
        )
        scored = q.predict_price_per_sqm(bundle, q.raw(spark, sf_dir), keep=("listing_id",))
        scored.agg(F.count("prediction")).collect()

    train_rows: dict[str, int] = {}
    for name, fn in (("clean", clean), ("encode", encode), ("profile", profile), ("train", train), ("score", score)):
        timed(name, fn)
    train_rows["train"] = q.model_table(spark, sf_dir).where(F.col("split") == "train").count()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "listing_pipeline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "profile_queries": profile_times,
                "model_fit_and_evaluate": model_times,
                "train_rows": train_rows.get("train"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
