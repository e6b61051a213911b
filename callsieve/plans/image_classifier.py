"""Prepare, train, score and evaluate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import DataFrame, functions as F

from callsieve.ml.metrics import cross_entropy, share_right
from callsieve.ml.mlp import DistributedMLP
from callsieve.ml.split import with_part


def builtin_mlp(layers: Sequence[int], rounds: int = 100, block_rows: int = 64, seed: int = 1) -> Estimator:
    """Spark's own perceptron (sigmoid hidden layers, full-batch L-BFGS)."""
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=rounds, blockSize=block_rows, seed=seed)


def train_and_score(
    rows: DataFrame, estimator: Estimator, id_column: str, test_fraction: float = 0.1
) -> DataFrame:
    """Fit on the training part and return the test part with its predictions."""
    parts = with_part(rows, id_column, test_fraction)
    model = Pipeline(stages=[estimator]).fit(parts.filter(F.col("part") == "train"))
    return model.transform(parts.filter(F.col("part") == "test"))


def end_to_end(rows: DataFrame, estimator: DistributedMLP, id_column: str, test_fraction: float = 0.1) -> DataFrame:
    """One row: labelled test rows, overall precision and recall, and log loss."""
    scored = train_and_score(rows, estimator, id_column, test_fraction)
    return scored.agg(
        F.count("label").alias("n"),
        share_right().alias("precision"),
        share_right().alias("recall"),
        cross_entropy(probability=estimator.getProbabilityCol()).alias("log_loss"),
    )
