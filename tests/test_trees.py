"""Split tables, node tables and normal equations against Spark ML and plain versions."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from aqarlens.operators.moments import covariances, ridge
from aqarlens.operators.split_gains import best_split, boosted_stumps, split_gains
from aqarlens.plans.training import fit_model
from aqarlens.plans.trees import gain_importance, node_table, predict_by_nodes

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(9)
    made = []
    for k in range(1500):
        a, b, c = rng.randrange(6), rng.randrange(9), rng.randrange(3)
        made.append((k, float(a), float(b), float(c), 0.7 * a + (2.0 if b > 4 else 0.0) * (c + 1) + rng.gauss(0, 0.3)))
    return spark.createDataFrame(made, "id long, a double, b double, c double, label double").repartition(4).persist()


def _fit(kind, rows, **options):
    return fit_model(kind(featuresCol="features", labelCol="label", **options), [], rows, FEATURES)[0]


def test_split_gains_match_plain_version(rows):
    data = [(r.a, r.b, r.c, r.label) for r in rows.collect()]

    def variance(y):
        mean = sum(y) / len(y)
        return sum((v - mean) ** 2 for v in y) / len(y)

    want = {}
    for f in range(3):
        values = sorted({d[f] for d in data})
        for low, high in zip(values, values[1:], strict=False):
            left, right = [d[3] for d in data if d[f] <= low], [d[3] for d in data if d[f] > low]
            if min(len(left), len(right)) >= 200:
                within = (len(left) * variance(left) + len(right) * variance(right)) / len(data)
                want[f, (low + high) / 2] = (variance([d[3] for d in data]) - within, len(left))
    got = {(r.feature, r.threshold): (r.gain, r.n_left) for r in split_gains(rows, FEATURES, F.col("label"), 200).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)


def test_running_sums_over_many_values(spark):
    """Every row its own value, over several ranges; nulls do not count."""
    rows = spark.range(2000).selectExpr("cast(id as double) as x", "if(id < 700, 1.0D, 5.0D) as label")
    rows = rows.union(spark.sql("select null, 9.0D union all select 3.5D, null")).repartition(6)
    best = best_split(split_gains(rows, ["x"], F.col("label")))
    assert (best.threshold, best.n_left, best.n, best.left_mean, best.right_mean) == (699.5, 700, 2000, 1.0, 5.0)
    assert best_split(split_gains(rows.where("x < 0"), ["x"], F.col("label"))) is None
    assert best_split(split_gains(rows.withColumn("label", F.lit(1.0)), ["x"], F.col("label"))) is None


def test_first_split_is_the_trees(spark, rows):
    best = best_split(split_gains(rows, FEATURES, F.col("label"), 20))
    root = {r.node: r for r in node_table(spark, _fit(DecisionTreeRegressor, rows, maxDepth=1, minInstancesPerNode=20)).collect()}
    assert (root[1].feature, root[1].threshold) == (best.feature, best.threshold)
    assert root[1].gain == pytest.approx(best.gain) and root[2].prediction == pytest.approx(best.left_mean)
    assert root[3].prediction == pytest.approx(best.right_mean)


@pytest.mark.parametrize(
    ("kind", "options"),
    [
        (DecisionTreeRegressor, {"maxDepth": 4}),
        (RandomForestRegressor, {"numTrees": 5, "maxDepth": 3, "seed": 3}),
        (GBTRegressor, {"maxIter": 3, "maxDepth": 2, "stepSize": 0.1}),
        (DecisionTreeRegressor, {"maxDepth": 0}),
    ],
)
def test_node_tables_predict_alike(spark, rows, kind, options):
    model = _fit(kind, rows, **options)
    own = {r.id: r.prediction for r in predict_by_nodes(rows, node_table(spark, model), FEATURES, "id").collect()}
    theirs = {r.id: r.prediction for r in model.transform(rows).collect()}
    assert own.keys() == theirs.keys()
    assert all(abs(own[k] - theirs[k]) < 1e-9 for k in own)


def test_forest_without_chance_is_the_tree(spark, rows):
    tree = node_table(spark, _fit(DecisionTreeRegressor, rows, maxDepth=3)).drop("tree", "weight").collect()
    options = {"numTrees": 3, "maxDepth": 3, "bootstrap": False, "featureSubsetStrategy": "all"}
    forest = node_table(spark, _fit(RandomForestRegressor, rows, **options))
    for k in range(3):
        assert sorted(forest.where(f"tree = {k}").drop("tree", "weight").collect()) == sorted(tree)


def test_boosted_stumps_are_the_libraries(rows):
    prediction, splits = boosted_stumps(rows, FEATURES, "label", rounds=3, step=0.1)
    model = _fit(GBTRegressor, rows, maxIter=3, maxDepth=1, stepSize=0.1)
    apart = model.transform(rows).select(F.max(F.abs(F.col("prediction") - prediction))).first()[0]
    assert len(splits) == 3 and apart < 1e-9


def test_importance_is_the_libraries(spark, rows):
    model = _fit(DecisionTreeRegressor, rows, maxDepth=3)
    own = {r.feature: r.score for r in gain_importance(rows, node_table(spark, model), FEATURES).collect()}
    theirs = model.stages[-1].featureImportances.toArray()
    assert [own.get(name, 0.0) for name in FEATURES] == pytest.approx(theirs.tolist())


@pytest.mark.parametrize("penalty", [0.0, 0.1, 2.0])
def test_ridge_is_the_libraries(rows, penalty):
    weights, intercept = ridge(rows, FEATURES, "label", penalty)
    model = _fit(LinearRegression, rows, regParam=penalty, elasticNetParam=0.0).stages[-1]
    assert weights == pytest.approx(model.coefficients.toArray().tolist()) and intercept == pytest.approx(model.intercept)


def test_covariances_skip_incomplete_rows(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (3.0, 8.0), (None, 1.0), (5.0, None)], "x double, y double")
    n, means, matrix = covariances(frame, ["x", "y"])
    assert (n, means.tolist(), matrix.tolist()) == (2, [2.0, 5.0], [[1.0, 3.0], [3.0, 9.0]])
    with pytest.raises(ValueError, match="no row"):
        ridge(frame.where("x > 9"), ["x"], "y")
