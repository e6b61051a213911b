"""Calling a user's Python functions from queries, batch by batch over Arrow."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def module_function(spark: SparkSession, path: str, function: str, returns: T.DataType | str) -> Callable:
    """Ship a Python file to the executors and return one of its functions as a column function.

    The function gets pandas Series and returns one of the same length.
    """
    spark.sparkContext.addPyFile(path)
    module = Path(path).stem

    def call(*args: pd.Series) -> pd.Series:
        return getattr(importlib.import_module(module), function)(*args)

    return F.pandas_udf(call, returns)


def batch_function(function: Callable, returns: T.DataType | str) -> Callable:
    """A function on pandas Series as a column function."""

    def call(*args: pd.Series) -> pd.Series:
        return function(*args)

    return F.pandas_udf(call, returns)


def register_function(
    spark: SparkSession, name: str, function: Callable, returns: T.DataType | str
) -> None:
    """Make a function on pandas Series callable by name from SQL text."""
    spark.udf.register(name, batch_function(function, returns))


def matrix_rows(matrix: np.ndarray, present: np.ndarray) -> pa.Array:
    """Matrix rows as list entries, NULL where nothing is present."""
    ends = np.concatenate([[0], np.cumsum(present)]).astype(np.int32) * matrix.shape[1]
    offsets = pa.array(ends, pa.int32(), mask=np.append(~present, False))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))


def map_matrices(
    df: DataFrame,
    column: str,
    shape: tuple[int, int],
    function: Callable[[np.ndarray], np.ndarray],
    output: str,
) -> DataFrame:
    """Hand an array column to `function` as NumPy batches of shape (rows, *shape).

    `function` returns one flat float32 row per input row; the other columns pass through. Rows
    with a NULL or wrong-sized array get NULL.
    """
    width = shape[0] * shape[1]
    schema = T.StructType(
        [f for f in df.schema.fields if f.name != column] + [T.StructField(output, T.ArrayType(T.FloatType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = batch.column(column)
            fits = np.asarray(pa.compute.equal(arrays.value_lengths(), width).fill_null(False))
            stacked = arrays.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
            results = np.asarray(function(stacked.astype(np.float32).reshape(-1, *shape)), np.float32)
            kept = [batch.column(f.name) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays(
                kept + [matrix_rows(results, fits)], [f.name for f in schema.fields]
            )

    return df.mapInArrow(run, schema)
