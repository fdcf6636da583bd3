from __future__ import annotations

from aqarlens.catalog import queries as q
from aqarlens.plans import reports
from aqarlens.plans.config import FEATURES
from aqarlens.plans.training import RESULT_SCHEMA


def test_report_writers_roundtrip(spark, sf_dir, tmp_path):
    cleaned, report, _ = q.cleaning(spark, sf_dir)
    reports.write_missing_values(cleaned, str(tmp_path / "missing"))
    reports.write_feature_summary(q.encoded(spark, sf_dir), str(tmp_path / "summary"), FEATURES)
    reports.write_data_validation_report(report, spark, str(tmp_path / "validation"))
    missing = spark.read.option("header", True).csv(str(tmp_path / "missing"))
    assert missing.count() == len(cleaned.columns)
    assert spark.read.option("header", True).csv(str(tmp_path / "summary")).count() == len(FEATURES)
    validation = {r.metric: float(r.value) for r in spark.read.option("header", True).csv(str(tmp_path / "validation")).collect()}
    assert validation["final_rows"] == report.final_rows

    results = spark.createDataFrame(
        [("A", 0.5, 0.1, 0.1, 10.0, None, 0.4, 0.1, 0.1, 10.0, 0.3, 0.1, 0.1, 10.0, "{}")], RESULT_SCHEMA
    )
    best = {"model_name": "A", "metrics": {"R2": 0.3, "RMSE_log": 0.1, "MAE_log": 0.1, "RMSE_EGP": 10.0}}
    reports.write_model_reports(results, best, str(tmp_path / "models"))
    assert spark.read.option("header", True).csv(str(tmp_path / "models/holdout")).columns == [
        "Model", "R2", "RMSE_log", "MAE_log", "RMSE_EGP"
    ]
    assert "best_model" in spark.read.text(str(tmp_path / "models/holdout_metrics")).first()[0]
