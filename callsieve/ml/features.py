"""Feature tables for training."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from callsieve.functions.arrays import class_index, scale


def labelled(rows: DataFrame, features: Column, label: Column, categorical: bool = False, *keep: str) -> DataFrame:
    """`keep` columns, `features` as an ML vector and `label` as a class index.

    With `categorical`, `label` is a one-hot array.
    """
    index = class_index(label) if categorical else label.cast("double")
    return rows.select(
        *keep, array_to_vector(features.cast("array<double>")).alias("features"), index.alias("label")
    )


def scaled_images(rows: DataFrame, column: str, top: float = 255.0) -> DataFrame:
    """A pixel array column, divided by its largest possible value, as 32-bit floats."""
    return rows.withColumn(column, scale(F.col(column), top))
