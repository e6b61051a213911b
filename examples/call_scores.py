"""Example of a user's own Python file: functions on pandas and NumPy data, free of Spark."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa


def add(a: pd.Series, b: pd.Series) -> pd.Series:
    return a + b


def call_summary(calls: pd.DataFrame) -> pd.DataFrame:
    """One row for one phone's calls; rows of several parts combine by sums and a maximum."""
    seconds = calls["callDuration"].astype("int64")
    return pd.DataFrame(
        {
            "phone1": calls["phone1"].iloc[:1],
            "calls": len(calls),
            "seconds": seconds.sum(),
            "longest": seconds.max(),
            "night_calls": (calls["hours"] >= 20).sum(),
        }
    )


def id_summary(events: pd.DataFrame) -> pd.DataFrame:
    """One row for one id's events, also where the id is missing."""
    return pd.DataFrame(
        {"big_id": events["big_id"].iloc[:1].to_numpy(), "n": len(events), "last_event": events["event_id"].max()}
    )


def transposed(matrices: np.ndarray) -> np.ndarray:
    """Each matrix of a batch transposed, as one flat row."""
    return matrices.transpose(0, 2, 1).reshape(len(matrices), -1)


def longest_gap(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """One row for one caller's legs in the order of their start: how long it was silent between two of them, and when.

    The last start is carried from batch to batch; a start that is no number is passed over.
    """
    caller, last, longest, since, legs = None, None, None, None, 0
    for batch in batches:
        caller = batch.column("calling_number")[0].as_py()
        for start in batch.column("start").to_pylist():
            legs += 1
            if start is None:
                continue
            if last is not None and (longest is None or start - last > longest):
                longest, since = start - last, last
            last = start
    made = {"calling_number": [caller], "legs": [legs], "longest_gap": [longest], "since": [since]}
    yield pd.DataFrame(made).astype({"longest_gap": "Int64", "since": "Int64"})
