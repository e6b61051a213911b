"""Classification metrics from a scored table, as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Row counts per (label, prediction)."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def share_right(label: str = "label", prediction: str = "prediction") -> Column:
    """Accuracy. With one label per row, overall precision and overall recall both equal it.

    A row without a prediction counts as wrong; a row without a label does not count.
    """
    right = F.coalesce((F.col(label) == F.col(prediction)).cast("double"), F.lit(0.0))
    return F.avg(F.when(F.col(label).isNotNull(), right))


def cross_entropy(label: str = "label", probability: str = "probability", floor: float = 1e-15) -> Column:
    """Mean categorical cross-entropy of an array of class probabilities, kept within [floor, 1 - floor].

    Without an array the probability is the floor; a row without a label does not count.
    """
    p = F.coalesce(F.get(F.col(probability), F.col(label).cast("int")), F.lit(floor))
    loss = -F.ln(F.least(F.greatest(p, F.lit(floor)), F.lit(1 - floor)))
    return F.avg(F.when(F.col(label).isNotNull(), loss))


def micro_precision(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.agg(share_right(label, prediction).alias("precision"))


def micro_recall(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.agg(share_right(label, prediction).alias("recall"))


def log_loss(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    return scored.agg(cross_entropy(label, probability).alias("log_loss"))


def per_class(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Support, precision and recall of every class seen as a label or a prediction.

    Precision is NULL for a class that is never predicted, recall for one that never occurs. Rows without a
    label do not count; one without a prediction is missing from its class's recall.
    """
    cells = confusion(scored.filter(F.col(label).isNotNull()), label, prediction)
    n, none = F.col("n"), F.lit(0).cast("bigint")
    right = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)

    def side(of: str, actual: Column, predicted: Column, right: Column) -> Column:
        return F.struct(
            F.col(of).alias("class"), actual.alias("actual"), predicted.alias("predicted"), right.alias("right")
        )

    # Each cell counts once for its label and once for its prediction.
    sides = F.array(side("label", n, none, right), side("prediction", none, n, none))
    return (
        cells.select(F.inline(sides))
        .filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.sum("actual").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("right").alias("right"),
        )
        .select(
            "class",
            "support",
            F.try_divide("right", "predicted").alias("precision"),
            F.try_divide("right", "support").alias("recall"),
        )
    )


def weighted(classes: DataFrame) -> DataFrame:
    """`per_class` averaged by support, a class without precision or recall counting as 0."""
    total = F.sum("support")
    return classes.agg(
        (F.sum(F.coalesce("precision", F.lit(0.0)) * F.col("support")) / total).alias("precision"),
        (F.sum(F.coalesce("recall", F.lit(0.0)) * F.col("support")) / total).alias("recall"),
    )
