"""Inner join of a fact table to a key table on either of two fact columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ENDPOINT = "_endpoint"


def either_endpoint_join(
    fact: DataFrame,
    keys: DataFrame,
    endpoints: tuple[str, str],
    key: str,
    payload: Sequence[str] = (),
) -> DataFrame:
    """Fact rows, once for every key row that equals either endpoint, plus the key's `payload` columns.

    Same rows as an inner join on `first = key or second = key`, but as an equi-join: it can be
    shuffled or broadcast, and adaptive execution can split a skewed key. NULLs never match. Fact and
    payload columns must have different names.
    """
    names = [c.lower() for c in [*fact.columns, *payload]]
    if clashing := sorted({c for c in names if names.count(c) > 1 or c == ENDPOINT}):
        raise ValueError(f"rename the columns {clashing}: they clash with others or with a working name")
    first, second = endpoints
    ends = F.when(F.col(first) == F.col(second), F.array(first)).otherwise(F.array(first, second))
    return (
        fact.withColumn(ENDPOINT, F.explode(ends))
        .join(keys.select(F.col(key).alias(ENDPOINT), *payload), ENDPOINT)
        .select(*[F.col(c) for c in fact.columns], *[F.col(c) for c in payload])
    )
