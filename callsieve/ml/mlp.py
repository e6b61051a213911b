"""Data-parallel training of a multilayer perceptron as an ML pipeline stage."""

from __future__ import annotations

import json
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.broadcast import Broadcast
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callsieve.functions.arrays import class_index, whole_number
from callsieve.functions.python_udfs import matrix_rows
from callsieve.ml import network
from callsieve.ml.optimizers import OPTIMIZERS, restore, state
from callsieve.ml.split import content_point
from callsieve.operators.checkpoints import is_written
from callsieve.shipping import ship_package

BLOCK = 4096  # weights per row when tasks hand their change back
TRAIN_LOSS, HELD_OUT = -1, -2  # block numbers of the figures that travel with the weights
# Tasks whose changes are averaged together first; the averages of all groups come next.
GROUPS = 64
CHANGE_SCHEMA = "block int, task int, n bigint, change array<double>"


class _NetworkParams(HasFeaturesCol, HasPredictionCol, HasProbabilityCol):
    layers = Param(
        Params._dummy(), "layers", "width of every layer, input and output included", TypeConverters.toListInt
    )

    def getLayers(self) -> list[int]:
        return self.getOrDefault(self.layers)


class DistributedMLP(
    Estimator, _NetworkParams, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """ReLU hidden layers with dropout, softmax output, cross-entropy loss.

    Each round (epoch) sends the weights to all tasks; every task runs mini-batches over its own
    partition with `localOptimizer`; Spark averages the tasks' changes by rows seen and
    `optimizer` applies the average: "plain" takes it as it is, "adadelta" and "adam" treat it
    as a gradient. Only the weights, whose number `layers` fixes, pass through the driver.
    `localSettings` and `settings` hold the two rules' rates, decays and eps by name. Training starts from
    `initialWeights`, if given: all layers' matrices and biases in one list.

    The label is a class index, or a one-hot array or vector if `categoricalLabels` is set.
    `numWorkers` 0 keeps the input's partitions. `batchSize` 0 takes all rows of a task as one mini-batch, whose
    gradient is added up Arrow batch by Arrow batch. `validationSplit` keeps about that share of rows
    out of training, chosen by their content.

    With `roundsFolder`, a folder that the driver and all executors share, the weights, the rule's accumulators and the losses are
    written there after each round, and training starts from the last round found there that was written whole. So a job
    that was stopped goes on where it was, with the result of one that was not, and so does one with more `epochs`.
    """

    epochs = Param(Params._dummy(), "epochs", "passes over the data", TypeConverters.toInt)
    batchSize = Param(Params._dummy(), "batchSize", "rows per mini-batch, 0 for all of a task", TypeConverters.toInt)
    numWorkers = Param(Params._dummy(), "numWorkers", "partitions to train on", TypeConverters.toInt)
    numClasses = Param(Params._dummy(), "numClasses", "classes, equal to the last layer", TypeConverters.toInt)
    dropout = Param(Params._dummy(), "dropout", "share of hidden units dropped", TypeConverters.toFloat)
    validationSplit = Param(Params._dummy(), "validationSplit", "share held out", TypeConverters.toFloat)
    categoricalLabels = Param(Params._dummy(), "categoricalLabels", "one-hot labels", TypeConverters.toBoolean)
    localOptimizer = Param(Params._dummy(), "localOptimizer", "rule within a task", TypeConverters.toString)
    optimizer = Param(Params._dummy(), "optimizer", "rule for the averaged change", TypeConverters.toString)
    localSettings = Param(Params._dummy(), "localSettings", "settings of localOptimizer")
    settings = Param(Params._dummy(), "settings", "settings of optimizer")
    initialWeights = Param(Params._dummy(), "initialWeights", "weights to start from", TypeConverters.toListFloat)
    roundsFolder = Param(Params._dummy(), "roundsFolder", "where rounds are kept", TypeConverters.toString)
    verbosity = Param(Params._dummy(), "verbosity", "1 prints each round's loss", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        layers: list[int] | None = None,
        featuresCol: str = "features",
        labelCol: str = "label",
        predictionCol: str = "prediction",
        probabilityCol: str = "probability",
        epochs: int = 1,
        batchSize: int = 64,
        numWorkers: int = 0,
        numClasses: int | None = None,
        dropout: float = 0.2,
        validationSplit: float = 0.1,
        categoricalLabels: bool = False,
        localOptimizer: str = "adam",
        optimizer: str = "adadelta",
        localSettings: dict[str, float] | None = None,
        settings: dict[str, float] | None = None,
        initialWeights: list[float] | None = None,
        roundsFolder: str | None = None,
        verbosity: int = 0,
        seed: int = 1,
    ):
        super().__init__()
        self._setDefault(
            epochs=1, batchSize=64, numWorkers=0, dropout=0.2, validationSplit=0.1, categoricalLabels=False,
            localOptimizer="adam", optimizer="adadelta", localSettings={}, settings={}, verbosity=0, seed=1,
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _check(self) -> None:
        layers = self.getLayers()
        if len(layers) < 2 or min(layers) < 1:
            raise ValueError("layers needs an input and an output width, all positive")
        if self.isSet(self.numClasses) and self.getOrDefault(self.numClasses) != layers[-1]:
            raise ValueError("numClasses must equal the last layer's width")
        for param in (self.localOptimizer, self.optimizer):
            if self.getOrDefault(param) not in OPTIMIZERS:
                raise ValueError(f"{param.name} must be one of {sorted(OPTIMIZERS)}")
        self._rule(self.localOptimizer, self.localSettings)
        self._rule(self.optimizer, self.settings)
        if self.isSet(self.initialWeights):
            if len(self.getOrDefault(self.initialWeights)) != network.weight_count(layers):
                raise ValueError(f"initialWeights needs {network.weight_count(layers)} values for these layers")
        for param in (self.dropout, self.validationSplit):
            if not 0 <= self.getOrDefault(param) < 1:
                raise ValueError(f"{param.name} must be in [0, 1)")
        if self.getOrDefault(self.epochs) < 1:
            raise ValueError("epochs must be at least 1")
        if self.getOrDefault(self.batchSize) < 0:
            raise ValueError("batchSize must be at least 1, or 0 for all of a task's rows")

    def _rule(self, name: Param, settings: Param):
        """A new update rule; wrong names of settings are an error."""
        try:
            return OPTIMIZERS[self.getOrDefault(name)](**self.getOrDefault(settings))
        except TypeError as e:
            raise ValueError(f"{settings.name} does not fit {self.getOrDefault(name)}: {e}") from None

    def _training_rows(self, df: DataFrame) -> DataFrame:
        label = F.col(self.getLabelCol())
        if self.getOrDefault(self.categoricalLabels):
            label = class_index(_as_array(df, self.getLabelCol(), "float64"))
        rows = df.select(
            _as_array(df, self.getFeaturesCol(), "float32").alias("features"), whole_number(label).alias("label")
        ).withColumn("held_out", content_point("features", "label") < self.getOrDefault(self.validationSplit))
        workers = self.getOrDefault(self.numWorkers)
        rows = rows.repartition(workers) if workers > 0 else rows
        # Sorted input would give batches of one class.
        return rows.sortWithinPartitions(F.xxhash64(F.lit(self.getSeed()), "features", "label"))

    def _fit(self, df: DataFrame) -> DistributedMLPModel:
        self._check()
        ship_package(df.sparkSession)
        layers, seed = self.getLayers(), self.getSeed()
        weights, rule, history = self._start(df.sparkSession)
        sc = df.sparkSession.sparkContext
        rows = self._training_rows(df)
        if self.getOrDefault(self.epochs) > 1 or self.getOrDefault(self.validationSplit) > 0:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for round_no in range(len(history), self.getOrDefault(self.epochs) + 1):
                last = round_no == self.getOrDefault(self.epochs)
                if last and self.getOrDefault(self.validationSplit) == 0:
                    break
                sent = sc.broadcast(weights)
                blocks = self._round(rows, sent, layers, (seed, round_no), train=not last)
                sent.destroy()
                # The held-out rows met the weights as sent, so they judge the round before.
                if history and HELD_OUT in blocks:
                    history[-1]["validation_loss"], history[-1]["validation_accuracy"] = blocks[HELD_OUT]
                if last:
                    break
                if TRAIN_LOSS not in blocks:
                    raise ValueError("no rows to train on")
                change = np.concatenate([blocks[b] for b in range(_block_count(layers))])
                weights = rule.step(weights, change)
                history.append({"round": round_no + 1, "loss": float(blocks[TRAIN_LOSS][0])})
                self._keep_round(df.sparkSession, weights, rule, history)
                if self.getOrDefault(self.verbosity) > 0:
                    print(f"round {round_no + 1}: loss {blocks[TRAIN_LOSS][0]:.4f}")
        finally:
            rows.unpersist()
        model = DistributedMLPModel(weights, history)
        return self._copyValues(model)

    def _start(self, spark: SparkSession) -> tuple[np.ndarray, object, list[dict]]:
        """Weights, rule and losses to go on from: those of the last whole round that was kept, or new ones."""
        layers = self.getLayers()
        weights = network.initial_weights(layers, self.getSeed())
        if self.isSet(self.initialWeights):
            weights = np.array(self.getOrDefault(self.initialWeights), np.float32)
        rule = self._rule(self.optimizer, self.settings)
        if not self.isSet(self.roundsFolder):
            return weights, rule, []
        for round_no in range(self.getOrDefault(self.epochs), 0, -1):
            folder = f"{self.getOrDefault(self.roundsFolder)}/round-{round_no:06d}"
            if not is_written(spark, folder):
                continue
            kept = {r["name"]: r for r in spark.read.parquet(folder).collect()}
            if len(kept["weights"]["values"]) != len(weights):
                raise ValueError(f"the rounds in {self.getOrDefault(self.roundsFolder)} are of other layers")
            known = {k.removeprefix("rule "): np.array(r["values"]) for k, r in kept.items() if k.startswith("rule ")}
            history = json.loads(kept["history"]["text"])
            return np.array(kept["weights"]["values"], np.float32), restore(type(rule), vars(rule), known), history
        return weights, rule, []

    def _keep_round(self, spark: SparkSession, weights: np.ndarray, rule, history: list[dict]) -> None:
        """Write what `_start` reads; a round counts once its whole table is there."""
        if not self.isSet(self.roundsFolder):
            return
        rows = [("weights", [float(w) for w in weights], None), ("history", None, json.dumps(history))]
        rows += [(f"rule {k}", [float(x) for x in v], None) for k, v in state(rule).items()]
        folder = f"{self.getOrDefault(self.roundsFolder)}/round-{len(history):06d}"
        frame = spark.createDataFrame(rows, "name string, values array<double>, text string")
        frame.coalesce(1).write.mode("overwrite").parquet(folder)

    def _round(
        self, rows: DataFrame, sent: Broadcast, layers: list[int], seeds: tuple[int, int], train: bool
    ) -> dict[int, np.ndarray]:
        """One pass over the data: the average change per weight block, and the losses."""
        batch_size, dropout = self.getOrDefault(self.batchSize), self.getOrDefault(self.dropout)
        rule = self._rule(self.localOptimizer, self.localSettings)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([*seeds, TaskContext.get().partitionId()])
            yield from _changes(batches, sent.value, layers, copy(rule), batch_size, dropout, rng, train)

        # Tasks of one group first, then the groups: with very many tasks no reducer gets them all.
        n, block = F.col("n").cast("double"), F.col("block")
        groups = (
            rows.mapInArrow(run, CHANGE_SCHEMA)
            .groupBy("block", F.pmod("task", F.lit(GROUPS)).alias("tasks"))
            .agg(Summarizer.mean(array_to_vector("change"), n).alias("change"), F.sum("n").alias("n"))
        )
        means = groups.groupBy(block).agg(Summarizer.mean(F.col("change"), n).alias("mean"))
        return {r["block"]: r["mean"].toArray() for r in means.collect()}


class DistributedMLPModel(Model, _NetworkParams, MLReadable, MLWritable):
    """The trained network. `history` has each round's losses; `probability` is an array of doubles.

    Rows without features, or with a NULL or non-finite value among them, get NULL.
    """

    def __init__(self, weights: np.ndarray | None = None, history: list[dict] | None = None):
        super().__init__()
        self.weights = weights
        self.history = history or []
        self._sent: tuple[str, Broadcast] | None = None

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()

    def _broadcast(self, sc) -> Broadcast:
        """The weights on the executors, sent once per application and not once per `transform`."""
        if self._sent is None or self._sent[0] != sc.applicationId:
            self._sent = sc.applicationId, sc.broadcast(self.weights)
        return self._sent[1]

    def copy(self, extra=None) -> DistributedMLPModel:
        made = super().copy(extra)
        made._sent = None
        return made

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        sent, layers = self._broadcast(df.sparkSession.sparkContext), self.getLayers()

        def score(features: pa.Array) -> pa.Array:
            present, x = _matrix(features, layers[0])
            finite = np.isfinite(x).all(axis=1)
            present[np.flatnonzero(present)[~finite]] = False
            x = x[finite]
            found = network.probabilities(sent.value, layers, x).astype(np.float64)
            return matrix_rows(found, present)

        probability = F.arrow_udf(score, "array<double>")
        return df.withColumn(
            self.getProbabilityCol(), probability(_as_array(df, self.getFeaturesCol(), "float32"))
        ).withColumn(self.getPredictionCol(), class_index(F.col(self.getProbabilityCol())))


class _ModelWriter(MLWriter):
    """Params as metadata, weights and history as two small tables beside it."""

    def __init__(self, model: DistributedMLPModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        weights = [(i, float(w)) for i, w in enumerate(self.model.weights)]
        self.sparkSession.createDataFrame(weights, "place int, weight float").write.parquet(f"{path}/weights")
        history = [(json.dumps(self.model.history),)]
        self.sparkSession.createDataFrame(history, "history string").write.parquet(f"{path}/history")


class _ModelReader(MLReader):
    def load(self, path: str) -> DistributedMLPModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        weights = self.sparkSession.read.parquet(f"{path}/weights").orderBy("place").toArrow()["weight"]
        history = self.sparkSession.read.parquet(f"{path}/history").first()[0]
        model = DistributedMLPModel(weights.to_numpy().astype(np.float32), json.loads(history))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def _block_count(layers: list[int]) -> int:
    return -(-network.weight_count(layers) // BLOCK)


def _as_array(df: DataFrame, column: str, dtype: str) -> Column:
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(column, dtype)
    return F.col(column).cast("array<float>" if dtype == "float32" else "array<double>")


def _matrix(arrays: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are present, and those as rows of a matrix."""
    if isinstance(arrays, pa.ChunkedArray):
        arrays = arrays.combine_chunks()
    present = np.array(arrays.is_valid())
    values = arrays.flatten().to_numpy(zero_copy_only=False)
    if np.any(np.asarray(arrays.drop_null().value_lengths()) != width):
        raise ValueError(f"features must hold {width} values")
    return present, values.reshape(-1, width)


def _changes(
    batches: Iterator[pa.RecordBatch],
    start: np.ndarray,
    layers: list[int],
    rule,
    batch_size: int,
    dropout: float,
    rng: np.random.Generator,
    train: bool,
) -> Iterator[pa.RecordBatch]:
    """Run one task's mini-batches, holding one Arrow batch at a time, and yield its weight change."""
    weights = start
    seen, loss_sum = 0, 0.0
    held, held_loss, held_right = 0, 0.0, 0
    rest_x, rest_y = np.empty((0, layers[0]), np.float32), np.empty(0, np.int64)

    whole = np.zeros(len(start))  # of a task that is one mini-batch, the summed gradient

    def learn(x: np.ndarray, y: np.ndarray) -> None:
        nonlocal weights, seen, loss_sum, whole
        loss, gradient = network.loss_and_gradient(weights, layers, x, y, dropout, rng)
        if batch_size:
            weights = rule.step(weights, gradient)
        else:
            whole += gradient.astype(np.float64) * len(y)
        seen, loss_sum = seen + len(y), loss_sum + loss * len(y)

    for batch in batches:
        x, y, out = rows_of(batch, layers)
        if out.any():
            p = network.probabilities(start, layers, x[out])
            held_loss -= float(np.log(np.maximum(p[np.arange(len(p)), y[out]], 1e-12)).sum())
            held_right += int((p.argmax(axis=1) == y[out]).sum())
            held += len(p)
        if train and not batch_size:
            if not out.all():
                learn(x[~out], y[~out])
        elif train:
            x, y = np.concatenate([rest_x, x[~out]]), np.concatenate([rest_y, y[~out]])
            order = rng.permutation(len(y))
            full = len(y) - len(y) % batch_size
            for at in range(0, full, batch_size):
                picked = order[at : at + batch_size]
                learn(x[picked], y[picked])
            rest_x, rest_y = x[order[full:]], y[order[full:]]
    if len(rest_y):
        learn(rest_x, rest_y)
    if seen and not batch_size:
        weights = rule.step(weights, (whole / seen).astype(weights.dtype))

    rows: list[tuple[int, int, np.ndarray]] = []
    if seen:
        change = start.astype(np.float64) - weights
        rows = [(i, seen, change[at : at + BLOCK]) for i, at in enumerate(range(0, len(change), BLOCK))]
        rows.append((TRAIN_LOSS, seen, np.array([loss_sum / seen])))
    if held:
        rows.append((HELD_OUT, held, np.array([held_loss / held, held_right / held])))
    if rows:
        numbers, counts, changes = zip(*rows)
        task = [TaskContext.get().partitionId()] * len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(task, pa.int32()), pa.array(counts, pa.int64()), pa.array(changes, pa.list_(pa.float64()))],
            ["block", "task", "n", "change"],
        )


def rows_of(batch: pa.RecordBatch, layers: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    present, x = _matrix(batch.column("features"), layers[0])
    label = batch.column("label")
    if not present.all() or label.null_count:
        raise ValueError("training rows need features and a label")
    if not np.isfinite(x).all():
        raise ValueError("training features must be finite and not NULL")
    y = label.to_numpy().astype(np.int64)
    if len(y) and (y.min() < 0 or y.max() >= layers[-1]):
        raise ValueError(f"labels must be in 0..{layers[-1] - 1}")
    return x, y, batch.column("held_out").to_numpy(zero_copy_only=False)
