from __future__ import annotations

import math

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from aqarlens.catalog import queries as q
from aqarlens.plans.config import DEFAULT_MODEL_PARAMS, FEATURES
from aqarlens.plans.scoring import ModelBundle, predict_price_per_sqm
from aqarlens.plans.evaluation import feature_importance, metrics_by_split
from aqarlens.plans.training import fit_model, model_specs, prepare_model_data, train_models, tuning_table
from aqarlens.plans.trees import node_table, predict_by_nodes


def test_label_is_log_of_target(spark):
    cols = ", ".join(f"1.0 AS {name}" for name in FEATURES)
    df = spark.sql(f"SELECT 'buy' AS category, {cols}, 8100.0 AS price_per_sqm")
    rows = prepare_model_data(df).collect()
    assert [round(r["label"], 9) for r in rows] == [round(math.log(8101.0), 9)]


def test_prepare_raises_when_nothing_remains(spark):
    cols = ", ".join(f"1.0 AS {name}" for name in FEATURES)
    df = spark.sql(f"SELECT 'rent' AS category, {cols}, 15000.0 AS price_per_sqm")
    with pytest.raises(ValueError):
        prepare_model_data(df)


def test_model_specs_follow_config():
    assert [name for name, _, _ in model_specs(DEFAULT_MODEL_PARAMS)] == [
        "Spark Linear Regression", "Spark Decision Tree", "Spark Random Forest",
    ]
    everything = model_specs({})
    assert len(everything) == 4
    assert all(grid == [{}] for _, _, grid in everything)


def test_train_models_and_bundle_roundtrip(spark, sf_dir, tmp_path):
    table = q.model_table(spark, sf_dir)
    params = {
        "linear_regression": {"enabled": True, "estimator": {"maxIter": 20}, "param_grid": {"regParam": [0.1]}},
        "decision_tree": {"enabled": True, "param_grid": {"maxDepth": [4]}},
        "random_forest": {"enabled": False},
        "gbt": {"enabled": False},
    }
    results, best = train_models(table, params, select_on="test")
    rows = results.collect()
    assert [r.Model for r in rows] == sorted([r.Model for r in rows], key=lambda m: -[x for x in rows if x.Model == m][0].R2)
    assert all(r.Train_R2 > 0 and r.R2 > 0 for r in rows)

    bundle = ModelBundle(best["model"], best["model_name"], encoding=q.encoding(spark, sf_dir),
                         cleaning=q.cleaning(spark, sf_dir)[2], metrics=best["metrics"])
    folder = bundle.save(str(tmp_path / "bundle"))
    assert bundle.save(str(tmp_path / "bundle")) != folder  # an earlier bundle is never overwritten
    loaded = ModelBundle.load(spark, folder)
    test = table.where(F.col("split") == "test")
    before = [r.prediction for r in bundle.model.transform(test).orderBy("listing_id").collect()]
    after = [r.prediction for r in loaded.model.transform(test).orderBy("listing_id").collect()]
    assert before == after

    raw = q.raw(spark, sf_dir).withColumn(
        "lat", F.when(F.col("listing_id") % 2 == 0, F.lit(None)).otherwise(F.col("lat"))
    )
    scored = predict_price_per_sqm(loaded, raw, keep=("listing_id", "lat"))
    assert scored.count() == raw.count()
    missing_lat = scored.where(F.col("lat").isNull())
    assert missing_lat.count() > 0
    assert missing_lat.where(F.col("prediction").isNotNull()).count() == 0
    assert scored.where(F.col("lat").isNotNull() & F.col("prediction").isNull()).count() == 0


def test_default_parameters_enable_three_models():
    assert {"linear_regression", "decision_tree", "random_forest", "gbt"} <= set(DEFAULT_MODEL_PARAMS)
    assert DEFAULT_MODEL_PARAMS["tuning"]["method"] == "train_validation_split"
    assert DEFAULT_MODEL_PARAMS["gbt"]["enabled"] is False


@pytest.mark.parametrize("flag", ["is_premium", "is_verified", "is_new_construction", "is_direct_from_dev"])
def test_scoring_input_without_a_flag(spark, sf_dir, flag):
    bundle, raw = q.bundle(spark, sf_dir), q.raw(spark, sf_dir)
    without = predict_price_per_sqm(bundle, raw.drop(flag), keep=("listing_id",))
    as_unset = predict_price_per_sqm(bundle, raw.withColumn(flag, F.lit("no")), keep=("listing_id",))
    assert without.count() == raw.count()
    assert without.exceptAll(as_unset).count() == 0


def test_scoring_without_encoding_gives_null(spark, sf_dir):
    bundle = q.bundle(spark, sf_dir)
    bundle.encoding = None
    scored = predict_price_per_sqm(bundle, q.raw(spark, sf_dir), keep=("listing_id",))
    assert scored.count() == q.raw(spark, sf_dir).count()
    assert scored.where("prediction IS NOT NULL").count() == 0


def test_target_name_is_carried(spark, sf_dir):
    table = q.model_table(spark, sf_dir)
    off = {k: {"enabled": False} for k in ("decision_tree", "random_forest", "gbt")}
    _, best = train_models(table, {"linear_regression": {"estimator": {"maxIter": 5}}, **off}, target="other")
    assert best["target"] == "other"


def test_validation_column_ignores_partitions(spark):
    """The same scores whatever the partitions; null flags train; the best set is fitted on all rows."""
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder

    rows = spark.range(400).selectExpr("cast(id % 23 as double) as x", "2.0 * (id % 23) + id % 5 as label", "if(id % 4 = 0, true, if(id % 4 = 1, null, false)) as held")
    estimator = LinearRegression(featuresCol="features", labelCol="label")
    grid = ParamGridBuilder().addGrid(estimator.regParam, [5.0, 0.0]).build()
    tuning = {"method": "train_validation_split", "validation_col": "held", "materialize": "none"}
    found = []
    for n in (1, 7):
        model, tuned = fit_model(estimator, grid, rows.repartition(n), ["x"], tuning)
        found.append([(chosen["regParam"], round(score, 9)) for chosen, score in tuning_table(tuned)])
        whole, _ = fit_model(estimator, [{estimator.regParam: 0.0}], rows, ["x"])
        assert model.stages[-1].intercept == pytest.approx(whole.stages[-1].intercept)
    assert found[0] == found[1] and [p for p, _ in found[0]] == [0.0, 5.0]


def test_shipped_forest_and_boosting_fit(spark, sf_dir):
    """All 33 features: better than the mean on every split; node tables predict alike."""
    table = q.model_table(spark, sf_dir)
    for key in ("random_forest", "gbt"):
        model = q.fitted_model(spark, sf_dir, key)
        assert all(r.r2 > 0 for r in metrics_by_split(model.transform(table)).collect())
        own = predict_by_nodes(table, node_table(spark, model), FEATURES, "listing_id").withColumnRenamed("prediction", "own")
        apart = model.transform(table).join(own, "listing_id").agg(F.max(F.abs(F.col("prediction") - F.col("own"))), F.count("*")).first()
        assert apart[0] < 1e-9 and apart[1] == table.count()


def test_importance_names_come_from_the_model(spark, sf_dir):
    ranked = feature_importance(spark, q.fitted_model(spark, sf_dir, "random_forest"), 20).collect()
    scores = [r.score for r in ranked]
    assert len(scores) == 20 and scores == sorted(scores, reverse=True) and scores[0] > 0 and {r.feature for r in ranked} <= set(FEATURES)
    line = q.fitted_on(spark, sf_dir, "linear_regression", q.LINE_FEATURES)
    weights = dict(zip(q.LINE_FEATURES, line.stages[-1].coefficients.toArray(), strict=True))
    assert {r.feature: r.score for r in feature_importance(spark, line).collect()} == {k: abs(v) for k, v in weights.items()}


def test_tuners_stage_only_what_fits_read(spark, monkeypatch):
    """Each fold's copy used to hold every column of the model table."""
    from aqarlens.plans import training

    staged = []
    monkeypatch.setattr(training, "materialize", lambda df, mode="auto": staged.append(df.columns) or df)
    rows = [(float(k % 17), float(k % 5), 1.0 + k % 2, k, k % 3, k % 17 + 0.1 * (k % 7)) for k in range(120)]
    train = spark.createDataFrame(rows, "x double, other double, w double, listing_id long, fold int, label double")
    estimator = LinearRegression(featuresCol="features", labelCol="label", weightCol="w", solver="normal")
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.0, 1.0]).build()
    _, tuned = fit_model(estimator, grid, train, ["x"], {"method": "cross_validator", "fold_col": "fold", "parallelism": 1})
    assert staged == [["x", "w", "fold", "label"]]
    assert [chosen["regParam"] for chosen, _ in tuning_table(tuned)] == [0.0, 1.0]
