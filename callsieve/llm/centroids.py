"""Clusters around centroids; the nearest one is found by Walsh-Hadamard coefficients, coarse to fine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from callsieve.llm.shared import stored
from callsieve.shipping import ship_package

WIDTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
STEPS = (4, 8, 16, 32)  # coefficients added up when centroids are ruled out; the rest comes last
ROWS = 4096
GROUPS = 64  # tasks whose sums are added up together before the sums of all groups are
# Up to here coefficients fit an int, and squared distances and their multiples by the width fit a long.
LARGEST = 1 << 24


def transformed(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard coefficients of each row of integers, from few sign changes to many.

    Applied twice, up to order, it gives the rows times their width.
    """
    return natural(rows)[:, coarse_to_fine(rows.shape[1])]


def restored(coefficients: np.ndarray) -> np.ndarray:
    """The rows of integers that have these coefficients."""
    width = coefficients.shape[1]
    back = np.empty_like(coefficients)
    back[:, coarse_to_fine(width)] = coefficients
    return natural(back) // width


def natural(rows: np.ndarray) -> np.ndarray:
    n, width = rows.shape
    made, half = rows, 1
    while half < width:
        pairs = made.reshape(n, width // (2 * half), 2, half)
        made = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return made


def coarse_to_fine(width: int) -> np.ndarray:
    signs = natural(np.eye(width, dtype=np.int64))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's nearest centroid, and its squared distance; ties go to the smaller number.

    Both sides are coefficients, whose squared differences add up to width times the squared distance. The
    first few of them give a guess; its whole distance is a bound, and a centroid whose sum so far is over it is
    strictly worse. What is left at the end has been added up to the last coefficient.
    """
    width = rows.shape[1]
    edges = [*(s for s in STEPS if s < width), width]
    start = ((rows[:, None, : edges[0]] - centroids[None, :, : edges[0]]) ** 2).sum(axis=2)
    bound = ((rows - centroids[start.argmin(axis=1)]) ** 2).sum(axis=1)
    row, number = np.nonzero(start <= bound[:, None])
    total = start[row, number]
    for low, high in zip(edges, edges[1:], strict=False):
        total = total + ((rows[row, low:high] - centroids[number, low:high]) ** 2).sum(axis=1)
        left = total <= bound[row]
        row, number, total = row[left], number[left], total[left]
    order = np.lexsort((number, total, row))
    first = order[np.r_[True, row[order][1:] != row[order][:-1]]] if len(order) else order
    return number[first], total[first] // width


def usable(vector: str, width: int) -> Column:
    """Whether a vector has exactly `width` components, none null or not finite."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return (F.size(vector) == width) & F.forall(F.col(vector).cast("array<double>"), finite)


def coefficient_table(vectors: DataFrame, id_column: str, vector: str, width: int, scale: int) -> DataFrame:
    """`vec_id, coefficients` of all usable vectors, stored: each component x as floor(scale * x), transformed."""
    ship_package(vectors.sparkSession)
    id_type = vectors.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                raw = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                scaled = np.floor(scale * raw)
                if scaled.size and np.abs(scaled).max() > LARGEST:
                    raise ValueError(f"components times {scale} must lie within {LARGEST} of zero")
                made = transformed(scaled.astype(np.int64)).astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(0, made.size + 1, width, dtype=np.int32), made.ravel())
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["vec_id", "coefficients"])

    rows = vectors.filter(F.col(id_column).isNotNull() & usable(vector, width))
    rows = rows.select(F.col(id_column).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return stored(rows.mapInArrow(run, f"vec_id {id_type}, coefficients array<int>"))


def coefficients_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("coefficients").flatten().to_numpy().astype(np.int64).reshape(-1, width)


def starting_centroids(table: DataFrame, k: int, seed: int) -> np.ndarray:
    """The coefficients of the `k` vectors whose ids, with the seed, have the smallest SHA-256, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = table.orderBy(digest, "coefficients").limit(k).select("coefficients").collect()
    return np.array([r["coefficients"] for r in first], np.int64)


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floored mean of its vectors; one without vectors stays.

    Each task adds up its own vectors. The sums of coefficients are the coefficients of the sums, so the driver, which
    gets one row per centroid, turns them back exactly.
    """
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = coefficients_of(batch.slice(at, ROWS), width)
                own, _ = nearest(rows, centroids)
                counts += np.bincount(own, minlength=k)
                for c in np.unique(own):
                    sums[c] += rows[own == c].sum(axis=0)
        met = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(np.arange(0, len(met) * width + 1, width, dtype=np.int32), sums[met].ravel())
        task = np.full(len(met), TaskContext.get().partitionId() % GROUPS)
        columns = [pa.array(met, pa.int32()), pa.array(task, pa.int32()), pa.array(counts[met]), lists]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "task", "n", "sums"])

    totals = table.mapInArrow(run, "cluster int, task int, n long, sums array<long>")
    whole = [F.get("sums", F.lit(i)).cast("decimal(38,0)").alias(f"s{i}") for i in range(width)]
    added = [F.sum(c).cast("decimal(38,0)").alias(c) for c in ["n", *(f"s{i}" for i in range(width))]]
    totals = totals.select("cluster", "task", F.col("n").cast("decimal(38,0)").alias("n"), *whole)
    totals = totals.groupBy("cluster", "task").agg(*added).groupBy("cluster").agg(*added)
    made = centroids.copy()
    for row in totals.collect():
        total = np.array([[int(row[f"s{i}"]) for i in range(width)]], object)
        mean = [int(x) // int(row["n"]) for x in restored(total)[0]]
        made[row["cluster"]] = transformed(np.array([mean], np.int64))[0]
    return made


def clustered(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` of all usable vectors.

    `width` is a power of two. Vectors that are null, of another length, or hold null or non-finite components take
    no part, nor do rows without an id. Rows that are repeated count each; with fewer than `k` vectors each
    starts a centroid, and no vectors give no rows. Of rows with one id those with smaller coefficients come first when
    centroids are chosen. Components beyond `LARGEST` after scaling are an error. Other columns play no part.

    Every round is one pass in which tasks add up their own vectors: what is shuffled is one row per task
    and centroid, and the driver sees the `k` centroids only.
    """
    if width & (width - 1) or width < 1:
        raise ValueError("width must be a power of two")
    spark = vectors.sparkSession
    table = coefficient_table(vectors, id_column, vector, width, scale)
    id_type = table.schema["vec_id"].dataType.simpleString()
    centroids = starting_centroids(table, k, seed)
    if not len(centroids):
        centroids = np.zeros((0, width), np.int64)
    else:
        for _ in range(rounds):
            centroids = moved(table, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                own, distance = nearest(coefficients_of(part, width), centroids)
                columns = [part.column(0), pa.array(own, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    found = stored(table.mapInArrow(run, f"vec_id {id_type}, cluster int, distance long"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = {r["cluster"]: int(r["d"]) for r in sums}
    figures = [
        (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
        for c, own in enumerate(restored(centroids).tolist())
        if c in inertia
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.join(F.broadcast(spark.createDataFrame(figures, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
