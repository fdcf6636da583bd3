"""Report tables and their writers (CSV / JSON through Spark).

The original job rendered these as Markdown and pictures on the driver; here
each report is a small DataFrame, written in parallel by Spark (one file
when ``single_file`` — fine for a handful of rows).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqarlens.operators.profiling import feature_summary, missing_values
from aqarlens.plans.cleaning import CleaningReport
from aqarlens.sources.files import write_table


def holdout_table(results: DataFrame) -> DataFrame:
    """Model, test R2, RMSE/MAE in log space, RMSE in units."""
    return results.select("Model", "R2", "RMSE_log", "MAE_log", "RMSE_EGP")


def split_table(results: DataFrame) -> DataFrame:
    """Model, train / validation / test R2 and test RMSE in units."""
    return results.select("Model", "Train_R2", "Validation_R2", "R2", "RMSE_EGP")


def model_comparison_chart(results: DataFrame) -> DataFrame:
    """Model, R2, RMSE in units, ordered by R2 descending."""
    return results.select("Model", "R2", "RMSE_EGP").orderBy(F.desc("R2"))


def write_missing_values(df: DataFrame, path: str) -> None:
    write_table(missing_values(df), path, fmt="csv", single_file=True)


def write_feature_summary(df: DataFrame, path: str, features=None) -> None:
    write_table(feature_summary(df, features), path, fmt="csv", single_file=True)


def write_data_validation_report(report: CleaningReport, spark, path: str) -> None:
    write_table(report.to_frame(spark), path, fmt="csv", single_file=True)


def write_model_reports(results: DataFrame, best: dict, path: str) -> None:
    """Comparison table, best-model metrics, holdout and per-split tables."""
    write_table(results, f"{path}/model_comparison", fmt="csv", single_file=True)
    write_table(holdout_table(results), f"{path}/holdout", fmt="csv", single_file=True)
    write_table(split_table(results), f"{path}/splits", fmt="csv", single_file=True)
    spark = results.sparkSession
    payload = json.dumps({"best_model": best["model_name"], **best["metrics"]})
    spark.createDataFrame([(payload,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/holdout_metrics")
