import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tripmart.plans import models
from tripmart.storage import file_bytes


@pytest.fixture(scope="module")
def vectors(warehouse):
    return models.assemble(models.trip_features(warehouse), models.FEATURES)


def test_zones_belong_to_the_nearest_centre(warehouse):
    zones = models.cluster_zones(warehouse.dim_pickup_location(), "pickup").collect()
    assert {zone["cluster"] for zone in zones} == set(range(models.CLUSTERS))
    points = {}
    for axis in ("pickup_x", "pickup_y"):
        values = [zone[axis] for zone in zones]
        mean = sum(values) / len(values)
        deviation = (sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5
        for zone in zones:
            points.setdefault(zone["PULocationID"], []).append((zone[axis] - mean) / deviation)
    members = {}
    for zone in zones:
        members.setdefault(zone["cluster"], []).append(points[zone["PULocationID"]])
    centres = {c: [sum(axis) / len(axis) for axis in zip(*ps)] for c, ps in members.items()}
    for zone in zones:
        x, y = points[zone["PULocationID"]]
        nearest = min(centres, key=lambda c: (x - centres[c][0]) ** 2 + (y - centres[c][1]) ** 2)
        assert nearest == zone["cluster"]


def test_clusters_do_not_depend_on_partitioning(warehouse, rows):
    zones = warehouse.dim_dropoff_location()
    once = models.cluster_zones(zones, "dropoff")
    again = models.cluster_zones(zones.repartition(7, "zone"), "dropoff")
    assert rows(once) == rows(again)


def test_split_is_stable_and_near_four_fifths(warehouse, rows):
    trips = warehouse.fact_trip().select("trip_id")
    train, test = models.split(trips)
    assert train.count() + test.count() == trips.count()
    assert 0.77 < train.count() / trips.count() < 0.83
    assert rows(train) == rows(models.split(trips.repartition(5))[0])


def test_metrics_equal_the_evaluator(vectors):
    train, test = models.split(vectors)
    predictions = models.fit_tree(train).transform(test)
    found = models.regression_metrics(predictions, "tree").first()
    for metric in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol=models.LABEL, metricName=metric)
        assert found[metric] == pytest.approx(evaluator.evaluate(predictions), rel=1e-9)


def test_linear_model_fits_the_sum_best(vectors):
    scores = {name: models.score_model(vectors, name).first() for name in models.MODELS}
    assert scores["Linear Regression"]["r2"] > 0.9999
    assert scores["Linear Regression"]["r2"] >= scores["Decision Tree"]["r2"] > 0.9
    assert scores["Random Forest"]["r2"] > 0.9


def test_linear_model_equals_the_closed_form(vectors):
    """Least squares with a penalty on coefficients of standardised features and label."""
    model = models.fit_linear(vectors)
    table = np.array(vectors.select(*models.FEATURES, models.LABEL).collect(), dtype=float)
    x, y = table[:, :-1], table[:, -1]
    centred, target = x - x.mean(axis=0), y - y.mean()
    penalty = models.REG_PARAM / y.std() * np.diag(x.var(axis=0))
    expected = np.linalg.solve(centred.T @ centred / len(y) + penalty, centred.T @ target / len(y))
    assert np.allclose(model.coefficients.toArray(), expected, rtol=1e-5, atol=1e-7)
    assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ expected, abs=1e-4)


def test_forest_is_repeatable(vectors):
    first, second = (models.score_model(vectors, "Random Forest").first() for _ in range(2))
    assert first["rmse"] == pytest.approx(second["rmse"], rel=1e-9)


def test_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(spark):
    made = spark.range(3000).selectExpr(
        "id as trip_id",
        f"cast((id * 37) % 101 + (id * 53) % 7 * 20 as double) as {models.LABEL}",
        *(f"cast((id * {7 + 2 * n}) % {11 + n} as double) as {name}" for n, name in enumerate(models.FEATURES)),
    )
    train = models.assemble(made, models.FEATURES)
    kept = models.fit_forest(train)
    assert kept.getCacheNodeIds()
    walked = RandomForestRegressor(
        featuresCol="features", labelCol=models.LABEL, numTrees=models.FOREST_TREES,
        maxDepth=models.FOREST_DEPTH, seed=models.SEED,
    ).fit(train)

    def trees(model):
        return [tree.toDebugString.split("\n", 1)[1] for tree in model.trees]

    assert trees(kept) == trees(walked)


def test_forest_keeps_no_nodes_that_do_not_fit_in_memory(spark, vectors, monkeypatch):
    train, _ = models.split(vectors)
    kept = models.fit_forest(train)
    assert kept.getCacheNodeIds()
    monkeypatch.setattr(models, "cache_bytes", lambda _: 100_000)
    walked = models.fit_forest(train)
    assert not walked.getCacheNodeIds()
    trees = [[tree.toDebugString.split("\n", 1)[1] for tree in model.trees] for model in (kept, walked)]
    assert trees[0] == trees[1]


def test_rows_that_fit_are_told_by_their_files_or_their_count(spark, tmp_path, monkeypatch):
    each = models.FOREST_ROW_BYTES + models.FOREST_NODE_BYTES
    made = spark.range(1000)
    made.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    for rows in (made, stored):
        monkeypatch.setattr(models, "cache_bytes", lambda _: 1000 * each)
        assert models.nodes_fit(rows)
        monkeypatch.setattr(models, "cache_bytes", lambda _: 999 * each)
        assert models.nodes_fit(rows) == (file_bytes(spark, rows.inputFiles()) // 8 <= 999 and rows is stored)
    monkeypatch.setattr(models, "cache_bytes", lambda _: 10 * each)
    assert not models.nodes_fit(stored)
    monkeypatch.setattr(models, "cache_bytes", lambda _: file_bytes(spark, stored.inputFiles()) // 8 * each)
    monkeypatch.setattr(type(stored), "count", None)
    assert models.nodes_fit(stored)


def test_correlations_agree(warehouse):
    facts = models.trip_features(warehouse)
    matrix = {(r["feature"], r["other"]): r["corr"] for r in models.correlation_matrix(facts).collect()}
    assert len(matrix) == (len(models.FEATURES) + 1) ** 2
    for row in models.label_correlations(facts).collect():
        assert matrix[models.LABEL, row["feature"]] == pytest.approx(row["corr"], abs=1e-9)
        assert matrix[row["feature"], models.LABEL] == pytest.approx(row["corr"], abs=1e-9)


def test_standardised_features(warehouse):
    from pyspark.ml.functions import vector_to_array

    scaled = models.standardise(models.assemble(warehouse.dim_pickup_location(), ["X", "Y"]))
    value = vector_to_array("scaledFeatures")[0]
    mean, deviation = scaled.agg(F.avg(value), F.stddev_samp(value)).first()
    assert mean == pytest.approx(0, abs=1e-12)
    assert deviation == pytest.approx(1)
