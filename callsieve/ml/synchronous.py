"""Training in step: all tasks share every mini-batch's gradient."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.sql import DataFrame, functions as F

from callsieve.ml import network
from callsieve.ml.mlp import HELD_OUT, DistributedMLP, DistributedMLPModel, rows_of
from callsieve.shipping import ship_package

# Rows of one mini-batch that lie in one task: features as float32 and labels as int64, row after row.
PIECES = "batch long, task int, features binary, labels binary"


class SynchronousMLP(DistributedMLP):
    """The network of `DistributedMLP`, trained as one machine would train it on the same mini-batches.

    Rows belong to mini-batches by their content, about `batchSize` rows each (copies of a row share one), and are spread over
    `numWorkers` tasks. They are dealt out once, so that each mini-batch has `numWorkers` partitions of its own, which stay cached.
    Every step is a Spark job over these alone: its tasks add up the gradient of their rows, and `optimizer` makes one step with
    the mean. So the number of tasks changes the weights by rounding only. `localOptimizer` plays no part,
    and there is no dropout.

    `numWorkers` 0 takes the input's partitions, or the cores if they are fewer. Steps follow each other, as each needs the
    weights of the one before, and a job takes some hundredths of a second however small, so a round's time, and
    the number of partitions that the driver keeps track of, go by its number of mini-batches. A lost task is run again by
    itself; a lost executor's partitions are read from the shuffle again.
    """

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
        dropout: float = 0.0,
        validationSplit: float = 0.1,
        categoricalLabels: bool = False,
        localOptimizer: str = "adam",
        optimizer: str = "adam",
        localSettings: dict[str, float] | None = None,
        settings: dict[str, float] | None = None,
        initialWeights: list[float] | None = None,
        roundsFolder: str | None = None,
        verbosity: int = 0,
        seed: int = 1,
    ):
        super().__init__(**self._input_kwargs)
        self._setDefault(dropout=0.0, optimizer="adam")

    def _check(self) -> None:
        super()._check()
        if self.getOrDefault(self.dropout) > 0:
            raise ValueError("synchronous training has no dropout")

    def _batched_rows(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The training rows with the number of their mini-batch, and how many mini-batches there are."""
        rows = super()._training_rows(df)
        batch_size, workers = self.getOrDefault(self.batchSize), self.getOrDefault(self.numWorkers)
        batches = max(1, -(-rows.filter(~F.col("held_out")).count() // batch_size)) if batch_size else 1
        if workers == 0:
            workers = min(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism)
        content = F.xxhash64(F.lit(self.getSeed()), "features", "label")
        rows = rows.withColumn("batch", F.pmod(content, F.lit(batches)))
        return rows.repartition(workers).sortWithinPartitions("batch", content), batches

    def _pieces(self, rows: DataFrame, batches: int) -> tuple[RDD, int]:
        """The training rows of `_batched_rows` as matrices, and the number of tasks.

        Mini-batch b is in partitions b * tasks to (b + 1) * tasks - 1.
        """
        layers, workers = self.getLayers(), rows.rdd.getNumPartitions()

        def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId()
            for batch in given:
                found = list(_cut(batch, layers))
                columns = [
                    pa.array([number for number, _, _ in found], pa.int64()),
                    pa.array([task] * len(found), pa.int32()),
                    pa.array([x.tobytes() for _, x, _ in found], pa.binary()),
                    pa.array([y.tobytes() for _, _, y in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["batch", "task", "features", "labels"])

        made = rows.mapInArrow(run, PIECES).rdd.map(lambda r: (r[0] * workers + r[1], (r[2], r[3])))
        return made.partitionBy(batches * workers, int).values(), workers

    def _fit(self, df: DataFrame) -> DistributedMLPModel:
        self._check()
        ship_package(df.sparkSession)
        layers, sc = self.getLayers(), df.sparkSession.sparkContext
        weights, rule, history = self._start(df.sparkSession)
        rows, batches = self._batched_rows(df)
        pieces, workers = self._pieces(rows, batches)
        pieces = pieces.persist(StorageLevel.MEMORY_AND_DISK)
        held_out = rows.filter("held_out").persist(StorageLevel.MEMORY_AND_DISK)
        judged = self.getOrDefault(self.validationSplit) > 0
        try:
            for round_no in range(len(history), self.getOrDefault(self.epochs)):
                loss, seen = 0.0, 0
                for batch in range(batches):
                    sums = _batch_sums(pieces, range(batch * workers, (batch + 1) * workers), weights, layers)
                    if sums is not None:
                        weights = rule.step(weights, (sums[2:] / sums[0]).astype(np.float32))
                        seen, loss = seen + sums[0], loss + sums[1]
                if not seen:
                    raise ValueError("no rows to train on")
                history.append({"round": round_no + 1, "loss": float(loss / seen)})
                if judged:
                    sent = sc.broadcast(weights)
                    found = self._round(held_out, sent, layers, (self.getSeed(), round_no), train=False)
                    sent.destroy()
                    if HELD_OUT in found:
                        history[-1]["validation_loss"], history[-1]["validation_accuracy"] = map(float, found[HELD_OUT])
                self._keep_round(df.sparkSession, weights, rule, history)
                if self.getOrDefault(self.verbosity) > 0:
                    print(f"round {round_no + 1}: loss {history[-1]['loss']:.4f}")
        finally:
            pieces.unpersist()
            held_out.unpersist()
        return self._copyValues(DistributedMLPModel(weights, history))


def _batch_sums(pieces: RDD, partitions: range, weights: np.ndarray, layers: list[int]) -> np.ndarray | None:
    """Rows, summed loss and summed gradient of one mini-batch, over all its tasks; None if it has no rows.

    A task holds one piece at a time, and gives back one sum. Weights go with the job, which Spark broadcasts if they are many.
    """

    def run(own: Iterator[tuple[bytes, bytes]]) -> Iterator[np.ndarray]:
        sums = None
        for features, labels in own:
            x, y = np.frombuffer(features, np.float32).reshape(-1, layers[0]), np.frombuffer(labels, np.int64)
            loss, gradient = network.loss_and_gradient(weights, layers, x, y, 0.0, np.random.default_rng(0))
            more = np.concatenate([[len(y), loss * len(y)], gradient.astype(np.float64) * len(y)])
            sums = more if sums is None else sums + more
        if sums is not None:
            yield sums

    found = pieces.context.runJob(pieces, run, partitions)
    return np.sum(found, axis=0) if found else None


def _cut(batch: pa.RecordBatch, layers: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The training rows of an Arrow batch, one piece for each mini-batch; rows come sorted by mini-batch."""
    x, y, out = rows_of(batch, layers)
    x, y, number = x[~out], y[~out], batch.column("batch").to_numpy()[~out]
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(number[a]), x[a:b], y[a:b]
