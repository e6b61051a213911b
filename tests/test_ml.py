import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from callsieve.functions.arrays import one_hot
from callsieve.ml import features, metrics, network, split
from callsieve.ml.mlp import DistributedMLP, DistributedMLPModel
from callsieve.ml.optimizers import Adadelta, Adam, Plain
from callsieve.plans.image_classifier import builtin_mlp, end_to_end, train_and_score
from callsieve.sources.derived import labelled_vectors
from callsieve.sources.tables import read_table
from conftest import TESTDATA


@pytest.fixture(scope="module")
def vectors(spark):
    return labelled_vectors(read_table(spark, str(TESTDATA / "sf0.1"), "embeddings")).cache()


def accuracy(scored):
    return metrics.micro_precision(scored).first()["precision"]


# --- splits and features


def test_split_is_even_whatever_the_ids(spark):
    for step in (1, 2, 10, 100, 1024):
        ids = spark.range(0, 20000 * step, step)
        share = split.with_part(ids, "id", 0.1).filter("part = 'test'").count() / 20000
        assert 0.09 < share < 0.11, step


def test_second_split_is_disjoint(spark):
    ids = spark.range(5000)
    test = split.with_part(ids, "id", 0.1).filter("part = 'test'").drop("part")
    held = split.with_part(ids, "id", 0.1, "validation", "fit", start=0.1).filter("part = 'validation'").drop("part")
    assert test.count() > 400 and held.count() > 400 and test.intersect(held).count() == 0


def test_negative_and_large_ids(spark):
    ids = spark.createDataFrame([(-1,), (2**63 - 1,), (-(2**63),), (0,)], "id bigint")
    points = [r[0] for r in ids.select(split.split_point(F.col("id"))).collect()]
    assert all(0 <= p < 1 for p in points)


def test_labelled_from_one_hot(spark):
    frame = spark.createDataFrame([(1, [0, 255], 1), (2, [51, 0], 0)], "id int, pixels array<int>, y int")
    rows = features.labelled(
        features.scaled_images(frame, "pixels"), F.col("pixels"), one_hot(F.col("y"), 3), True, "id"
    )
    found = rows.select("id", vector_to_array("features").alias("f"), "label").collect()
    assert [(r["id"], r["f"], r["label"]) for r in found] == [
        (1, [0.0, 1.0], 1.0), (2, [pytest.approx(0.2), 0.0], 0.0)
    ]


# --- metrics


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 4, 300)
    guess = np.where(rng.random(300) < 0.6, label, rng.integers(0, 3, 300))
    p = rng.dirichlet(np.ones(4), 300)
    rows = [(float(a), float(b), list(map(float, c))) for a, b, c in zip(label, guess, p)]
    return spark.createDataFrame(rows, "label double, prediction double, probability array<double>").cache()


def test_metrics_agree_with_spark_ml(scored):
    def reference(name, **options):
        frame = scored.withColumn("probability", array_to_vector("probability"))
        return MulticlassClassificationEvaluator(metricName=name, **options).evaluate(frame)

    assert metrics.micro_precision(scored).first()["precision"] == pytest.approx(reference("accuracy"))
    assert metrics.micro_recall(scored).first()["recall"] == pytest.approx(reference("accuracy"))
    classes = metrics.per_class(scored)
    found = {r["class"]: r for r in classes.collect()}
    assert sum(r["support"] for r in found.values()) == 300
    for c in range(3):
        assert found[c]["precision"] == pytest.approx(reference("precisionByLabel", metricLabel=float(c)))
        assert found[c]["recall"] == pytest.approx(reference("recallByLabel", metricLabel=float(c)))
    overall = metrics.weighted(classes).first()
    assert overall["precision"] == pytest.approx(reference("weightedPrecision"))
    assert overall["recall"] == pytest.approx(reference("weightedRecall"))
    assert metrics.log_loss(scored).first()["log_loss"] == pytest.approx(reference("logLoss"))


def test_class_never_predicted_or_never_seen(spark):
    frame = spark.createDataFrame([(0.0, 1.0), (0.0, 1.0), (2.0, 2.0)], "label double, prediction double")
    found = {r["class"]: (r["support"], r["precision"], r["recall"]) for r in metrics.per_class(frame).collect()}
    assert found == {0.0: (2, None, 0.0), 1.0: (0, 0.0, None), 2.0: (1, 1.0, 1.0)}


def test_label_and_prediction_are_not_exchanged(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (0.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    found = {r["class"]: (r["precision"], r["recall"]) for r in metrics.per_class(frame).collect()}
    assert found == {0.0: (1.0, pytest.approx(1 / 3)), 1.0: (pytest.approx(1 / 3), 1.0)}


def test_log_loss_of_certain_answers(spark):
    frame = spark.createDataFrame([(0.0, [1.0, 0.0]), (1.0, [1.0, 0.0])], "label double, probability array<double>")
    expected = -(math.log(1 - 1e-15) + math.log(1e-15)) / 2
    assert metrics.log_loss(frame).first()["log_loss"] == pytest.approx(expected)


# --- what a task computes


def test_gradient_against_differences():
    layers, rng = [5, 7, 6, 3], np.random.default_rng(0)
    flat = network.initial_weights(layers, 1).astype(np.float64)
    flat += 0.01 * rng.standard_normal(network.weight_count(layers))
    x, y = rng.standard_normal((9, 5)), rng.integers(0, 3, 9)

    def loss(w, dropout=0.0):
        return network.loss_and_gradient(w, layers, x.copy(), y, dropout, np.random.default_rng(5))

    for dropout in (0.0, 0.3):  # the same generator drops the same units each time
        gradient = loss(flat, dropout)[1]
        for i in rng.choice(len(flat), 25, replace=False):
            step = np.zeros_like(flat)
            step[i] = 1e-6
            slope = (loss(flat + step, dropout)[0] - loss(flat - step, dropout)[0]) / 2e-6
            assert gradient[i] == pytest.approx(slope, abs=1e-6)


def test_probabilities_sum_to_one_for_huge_scores():
    layers = [2, 3]
    p = network.probabilities(np.full(network.weight_count(layers), 500.0), layers, np.array([[1e3, -1e2]]))
    assert np.allclose(p.sum(axis=1), 1) and np.isfinite(p).all()


def test_update_rules_by_hand():
    w, g = np.array([1.0, 2.0]), np.array([0.5, -0.25])
    assert Plain().step(w, g) == pytest.approx([0.5, 2.25])
    assert Adam(rate=0.1).step(w, g) == pytest.approx([0.9, 2.1], abs=1e-6)  # first step: rate times sign
    expected = w - np.sqrt(1e-6) / np.sqrt(0.05 * g**2 + 1e-6) * g
    assert Adadelta().step(w, g) == pytest.approx(expected)
    for rule, target in ((Adam(rate=0.05), 1e-2), (Adadelta(), 0.5)):
        v = np.array([1.0, -1.0])
        for _ in range(2000):
            v = rule.step(v, 2 * v)
        assert np.abs(v).max() < target


# --- training


@pytest.mark.parametrize("partitions", [1, 4])
def test_builtin_reaches_the_floor(vectors, partitions):
    rows = features.labelled(vectors, F.col("features"), F.col("label"), False, "vec_id").repartition(partitions)
    assert accuracy(train_and_score(rows, builtin_mlp([64, 32, 4]), "vec_id")) > 0.8


@pytest.mark.parametrize("workers, epochs", [(0, 12), (4, 36)])
def test_distributed_reaches_the_floor(vectors, workers, epochs):
    """Four workers take a quarter of the steps each per round, so they need more rounds."""
    estimator = DistributedMLP(
        layers=[64, 32, 4], epochs=epochs, batchSize=8, optimizer="plain", validationSplit=0.0, numWorkers=workers
    )
    assert accuracy(train_and_score(vectors, estimator, "vec_id")) > 0.8


def test_adadelta_on_the_averaged_change_learns(vectors):
    estimator = DistributedMLP(layers=[64, 32, 4], epochs=30, seed=2)
    model = estimator.fit(vectors)
    losses = [h["loss"] for h in model.history]
    held = [h["validation_loss"] for h in model.history]
    assert len(losses) == 30 and losses[-1] < 0.85 * losses[0] and held[-1] < 0.85 * held[0]
    assert model.history[-1]["validation_accuracy"] > 0.45


def test_same_seed_and_partitions_give_the_same_model(vectors):
    def fit(seed):
        return DistributedMLP(layers=[64, 8, 4], epochs=2, numWorkers=3, optimizer="plain", seed=seed).fit(vectors)

    first, second, other = fit(1), fit(1), fit(2)
    assert np.allclose(first.weights, second.weights, atol=1e-6)
    assert not np.allclose(first.weights, other.weights, atol=1e-3)


def test_one_worker_equals_training_by_hand(vectors):
    """A single task's averaged change, applied as it is, ends at that task's weights."""
    rows = vectors.limit(50).coalesce(1).cache()
    model = DistributedMLP(
        layers=[64, 8, 4], epochs=1, batchSize=1000, dropout=0.0, validationSplit=0.0, optimizer="plain", numWorkers=1
    ).fit(rows)
    data = rows.collect()
    x = np.array([r["features"] for r in data], np.float32)
    y = np.array([int(r["label"]) for r in data])
    start = network.initial_weights([64, 8, 4], 1)
    loss, gradient = network.loss_and_gradient(start, [64, 8, 4], x, y, 0.0, np.random.default_rng(0))
    assert model.history[0]["loss"] == pytest.approx(loss, rel=1e-5)
    assert np.allclose(model.weights, Adam().step(start, gradient), atol=1e-5)


def test_label_forms_agree(vectors):
    hot = vectors.withColumn("hot", one_hot(F.col("label"), 4)).withColumn("hotv", array_to_vector("hot"))
    vec = hot.withColumn("features", array_to_vector(F.col("features").cast("array<double>")))
    options = dict(layers=[64, 8, 4], epochs=1, validationSplit=0.0, optimizer="plain")
    by_index = DistributedMLP(**options).fit(vectors)
    by_array = DistributedMLP(labelCol="hot", categoricalLabels=True, numClasses=4, **options).fit(hot)
    by_vector = DistributedMLP(labelCol="hotv", categoricalLabels=True, **options).fit(vec)
    assert np.allclose(by_index.weights, by_array.weights) and np.allclose(by_index.weights, by_vector.weights)


def test_scoring_keeps_rows_columns_and_nulls(spark, vectors):
    model = Pipeline(stages=[DistributedMLP(layers=[64, 8, 4], epochs=1)]).fit(vectors)
    assert isinstance(model.stages[0], DistributedMLPModel)
    some = vectors.limit(5).withColumn(
        "features",
        F.when(F.col("vec_id") != vectors.limit(5).agg(F.max("vec_id")).first()[0], F.col("features")),
    )
    scored = model.transform(some)
    assert scored.columns == ["vec_id", "features", "label", "probability", "prediction"]
    for r in scored.collect():
        if r["features"] is None:
            assert r["probability"] is None and r["prediction"] is None
        else:
            assert sum(r["probability"]) == pytest.approx(1, abs=1e-5)
            assert r["prediction"] == float(np.argmax(r["probability"]))
    assert scored.filter(F.col("features").isNull()).count() == 1
    assert model.transform(vectors.filter("vec_id < 0")).count() == 0


def test_empty_partitions_do_not_matter(vectors):
    rows = vectors.limit(40).repartition(1).cache()
    wide = rows.unionByName(vectors.filter("vec_id < 0").repartition(5))
    options = dict(layers=[64, 8, 4], epochs=2, validationSplit=0.0, optimizer="plain")
    assert np.allclose(
        DistributedMLP(**options).fit(rows).weights, DistributedMLP(**options).fit(wide).weights, atol=1e-6
    )


def test_parameters_are_checked(vectors):
    for wrong in (
        dict(layers=[64]), dict(layers=[64, 4], numClasses=5), dict(layers=[64, 4], optimizer="x"),
        dict(layers=[64, 4], dropout=1.0), dict(layers=[64, 4], validationSplit=-0.1), dict(layers=[64, 4], epochs=0),
    ):
        with pytest.raises(ValueError):
            DistributedMLP(**wrong).fit(vectors)
    for wrong in (dict(layers=[63, 4]), dict(layers=[64, 3])):
        with pytest.raises(Exception, match="must"):
            DistributedMLP(**wrong).fit(vectors)
    with pytest.raises(ValueError, match="no rows"):
        DistributedMLP(layers=[64, 4]).fit(vectors.filter("vec_id < 0"))


def test_estimator_settings_survive_saving(tmp_path, vectors):
    estimator = DistributedMLP(layers=[64, 8, 4], epochs=3, batchSize=32, numWorkers=2)
    estimator.write().overwrite().save(str(tmp_path / "estimator"))
    loaded = DistributedMLP.load(str(tmp_path / "estimator"))
    assert loaded.getLayers() == [64, 8, 4] and loaded.getOrDefault(loaded.epochs) == 3


def test_end_to_end(vectors):
    estimator = DistributedMLP(layers=[64, 32, 4], epochs=8, batchSize=8, optimizer="plain", validationSplit=0.0)
    found = end_to_end(vectors, estimator, "vec_id").first()
    assert found["n"] > 100 and found["precision"] == found["recall"] > 0.7 and 0 < found["log_loss"] < 0.8


def one_layer(**settings):
    return DistributedMLP(
        layers=[64, 4], initialWeights=[0.0] * 260, batchSize=0, localOptimizer="plain", dropout=0.0,
        validationSplit=0.0, **settings,
    )


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_the_averaged_change_does_not_depend_on_partitions(spark, partitions):
    rows = labelled_vectors(read_table(spark, str(TESTDATA / "sf0.001"), "embeddings"))
    found = one_layer(optimizer="plain").fit(rows.repartition(partitions)).weights
    table = rows.toPandas()
    x = np.c_[np.stack(table["features"]).astype(float), np.ones(len(table))]
    wrong = 0.25 - np.eye(4)[table["label"].astype(int)]
    assert np.allclose(found, -(x.T @ wrong / len(table)).ravel(), atol=1e-5)


def test_settings_of_the_rules(spark):
    rows = labelled_vectors(read_table(spark, str(TESTDATA / "sf0.001"), "embeddings"))
    plain = one_layer(optimizer="plain").fit(rows).weights
    half = one_layer(optimizer="plain", settings={"rate": 0.5}).fit(rows).weights
    assert np.allclose(half, plain / 2, atol=1e-6)
    for wrong in ({"rote": 1.0}, {"eps": 1.0}):
        with pytest.raises(ValueError, match="settings does not fit plain"):
            one_layer(optimizer="plain", settings=wrong).fit(rows)
    with pytest.raises(ValueError, match="initialWeights"):
        DistributedMLP(layers=[64, 4], initialWeights=[0.0]).fit(rows)


def test_bad_features_and_labels_are_refused_in_training(spark):
    for features, label in (([float("nan"), 1.0], 0.0), ([None, 1.0], 0.0), ([1.0, 2.0], 2.7), ([1.0, 2.0], None)):
        frame = spark.createDataFrame([(features, label)], "features array<double>, label double")
        with pytest.raises(Exception, match="finite|whole numbers|need features and a label"):
            DistributedMLP(layers=[2, 2], validationSplit=0.0).fit(frame)


def test_bad_features_score_null_and_models_are_saved(spark, tmp_path):
    frame = spark.createDataFrame(
        [(0, [1.0, 0.0], 0.0), (1, [0.0, 1.0], 1.0)] * 20, "id int, features array<double>, label double"
    )
    model = Pipeline(stages=[DistributedMLP(layers=[2, 2], validationSplit=0.0, epochs=2)]).fit(frame)
    odd = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, [float("inf"), 2.0]), (3, [None, 1.0]), (4, None), (5, [0.5, 0.1])],
        "id int, features array<double>",
    )
    found = model.transform(odd).orderBy("id").collect()
    assert [r["prediction"] is None for r in found] == [False, True, True, True, False]
    model.save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.transform(odd).orderBy("id").collect() == found
    assert again.stages[0].history == model.stages[0].history and again.stages[0].getLayers() == [2, 2]


def test_rows_without_prediction_count_as_wrong(spark):
    rows = [(0.0, 0.0), (0.0, None), (1.0, 1.0), (None, 1.0)]
    scored = spark.createDataFrame(rows, "label double, prediction double")
    assert metrics.micro_recall(scored).first()[0] == pytest.approx(2 / 3)
    weighted = metrics.weighted(metrics.per_class(scored)).first()
    assert weighted["recall"] == pytest.approx(2 / 3) and weighted["precision"] == 1.0
