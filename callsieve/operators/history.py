"""Collecting each key's rows, and scoring them in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from callsieve.operators.groups import MAX_ROWS, PART, bounded_parts
from callsieve.shipping import ship_package

# The fields of a call kept in a history, with and without the event.
CALL_FIELDS = (
    "phone1",
    "phone2",
    "call_event",
    "phone1_type",
    "phone2_type",
    "callDuration",
    "hours",
)
CALL_FIELDS_WITHOUT_EVENT = (
    "phone1",
    "phone2",
    "phone1_type",
    "phone2_type",
    "callDuration",
    "hours",
)

STREAM_ROWS = 10_000


def collect_history(
    rows: DataFrame,
    key: str = "phone1",
    fields: Sequence[str] = CALL_FIELDS,
    max_rows: int = MAX_ROWS,
    name: str = "calls",
) -> DataFrame:
    """`key`, `part` and the rows as a sorted array of structs.

    Part p holds the rows p * max_rows to (p + 1) * max_rows - 1 of the key's sorted rows, so no array
    outgrows an executor, and the parts in order are the history. Fields must have an order.
    """
    needed = rows.select(*dict.fromkeys([key, *fields]))
    return (
        bounded_parts(needed, key, fields, max_rows)
        .groupBy(key, F.col(PART).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
    )


def variant_history(histories: DataFrame, name: str = "calls") -> DataFrame:
    """Collected histories with each as one VARIANT value: a typed list of objects that need no schema to be read.

    Fields keep their types. Written to Parquet, the value is shredded if the session writes so
    (`spark.sql.variant.writeShredding.enabled`), and `variant_rows` reads single fields of it by their paths.
    """
    kept = [c for c in histories.columns if c != name]
    return histories.select(*kept, F.to_variant_object(name).alias(name))


def variant_rows(histories: DataFrame, fields: dict[str, str], name: str = "calls") -> DataFrame:
    """The calls of VARIANT histories, one per row: the other columns, `pos`, and the `fields` (name to type) by path.

    A field that a call does not have, or that is null there, is NULL; one of another type is an error.
    """
    kept = [c for c in histories.columns if c != name]
    read = ", ".join(f"variant_get(call.value, '$.{field}', '{kind}') as {field}" for field, kind in fields.items())
    columns = ", ".join(f"`{c}`" for c in kept)
    return histories.sparkSession.sql(
        f"select {columns}, call.pos as pos, {read} from {{histories}}, lateral variant_explode(`{name}`) as call",
        histories=histories,
    )


def score_by_key(
    rows: DataFrame,
    key: str,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    partial_schema: T.StructType | str,
    merge: Sequence[Column],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Give each key's rows to a Python function in parts and merge what it returns.

    `function` gets up to `max_rows` of a key's rows as a DataFrame and returns rows of `partial_schema`, the
    key among them. Parts are slices of the key's sorted rows, on several executors; `merge` says how
    they combine: aggregates over the partial columns. Only partial rows are shuffled for it. A
    function that needs all rows of a key at once belongs in `score_whole_keys`.
    """
    grouped = bounded_parts(rows, key, None, max_rows, spread=True).sortWithinPartitions(key, PART)
    return _scored(grouped, key, function, partial_schema).groupBy(key).agg(*merge)


def score_whole_keys(
    rows: DataFrame,
    key: str,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Give all of each key's rows at once to a Python function that cannot work on parts.

    Raises ValueError before any of it is called if a key has more than `max_rows` rows, as they would have to fit a
    task's memory together. A function that can read them as a stream has no such limit: see `stream_by_key`.
    """
    longest = rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if longest > max_rows:
        raise ValueError(f"a key has {longest} rows, over the limit of {max_rows}; score it in parts or as a stream")
    grouped = bounded_parts(rows, key, None, max_rows, spread=True).sortWithinPartitions(key, PART)
    return _scored(grouped, key, function, schema)


def stream_by_key(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch | pa.Table | pd.DataFrame]],
    schema: T.StructType | str,
    batch_rows: int = STREAM_ROWS,
) -> DataFrame:
    """Give each key's rows, in order, as a stream of Arrow batches to a Python function, whatever their number.

    `function` gets an iterator over a key's rows sorted by `order` (NULLs first), in batches of `batch_rows` at most, and
    yields results of `schema`: what it keeps in local variables is its state. So a function that depends on the
    order of all rows is exact, and a task holds one batch and that state. Rows that are equal in `order` come in any order.
    It need not read its stream to the end. Only the columns of `rows` travel: select those that are needed.

    Keys share tasks, but the rows of one key go through one task one after the other, as the state is carried from row to
    row: Spark sorts them on disk if need be, so a long key costs time, not memory. A function whose
    results over parts can be merged is better off in `score_by_key`, which spreads such a key.
    """
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")
    ship_package(rows.sparkSession)
    made = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow_schema = to_arrow_schema(made)

    def tables(results: Iterator[pa.RecordBatch | pa.Table | pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for result in results:
            if isinstance(result, pd.DataFrame):
                result = pa.Table.from_pandas(result[made.names], arrow_schema, preserve_index=False)
            table = result if isinstance(result, pa.Table) else pa.Table.from_batches([result])
            yield from table.select(made.names).cast(arrow_schema).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(batches, key, batch_rows)
        piece = next(pieces, None)
        while piece is not None:
            following = None

            def stream(first: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
                nonlocal following
                yield first
                for begins, batch in pieces:
                    if begins:
                        following = begins, batch
                        return
                    yield batch

            own = stream(piece[1])
            yield from tables(function(own))
            for _ in own:  # what the function left
                pass
            piece = following

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, made)


def _pieces(batches: Iterator[pa.RecordBatch], key: str, batch_rows: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Sorted batches cut at each new key: whether a key begins with the piece, and the piece."""
    last: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = pa.Table.from_batches([batch]).select([key])
        met = own if last is None else pa.concat_tables([last, own])
        starts = np.flatnonzero(_changes(met[key])) + 1 - (0 if last is None else 1)
        starts = set(starts.tolist()) | ({0} if last is None else set())
        cuts = sorted({0, *starts, batch.num_rows})
        for a, b in zip(cuts, cuts[1:]):
            for at in range(a, b, batch_rows):
                yield at == a and a in starts, batch.slice(at, min(batch_rows, b - at))
        last = own.slice(batch.num_rows - 1)


def _scored(
    grouped: DataFrame, key: str, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """What `function` returns for every (key, part), from rows sorted by them.

    Groups are found on the Arrow columns, where NULL is no number, and each is turned to pandas on its
    own: what a function sees of its group does not depend on the groups beside it.
    """
    spark = grouped.sparkSession
    ship_package(spark)
    zone = spark.conf.get("spark.sql.session.timeZone")
    made = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow_schema = to_arrow_schema(made)

    def called(table: pa.Table) -> pa.Table:
        frame = table.drop_columns([PART]).to_pandas(date_as_object=True)
        for name, kind in frame.dtypes.items():
            if isinstance(kind, pd.DatetimeTZDtype):
                frame[name] = frame[name].dt.tz_convert(zone).dt.tz_localize(None)
        result = function(frame)[made.names]
        for name, kind in result.dtypes.items():
            if kind.kind == "M" and arrow_schema.field(name).type == pa.timestamp("us", "UTC"):
                result = result.assign(**{name: result[name].dt.tz_localize(zone)})
        return pa.Table.from_pandas(result, arrow_schema, preserve_index=False)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted, so a group ends where the key or the part changes; the last group of
        # a batch may go on in the next one.
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
            ends = np.flatnonzero(_changes(table[key]) | _changes(table[PART])) + 1
            starts = [0, *ends.tolist()]
            if len(ends):
                done = [called(table.slice(a, b - a)) for a, b in zip(starts, ends.tolist())]
                yield from pa.concat_tables(done).combine_chunks().to_batches()
            rest = table.slice(starts[-1])
        if rest is not None and rest.num_rows:
            yield from called(rest).to_batches()

    return grouped.mapInArrow(score, made)


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each value but the first differs from the one before; NULL equals NULL, and NaN NaN."""
    values = column.combine_chunks()
    left, right = values.slice(0, len(values) - 1), values.slice(1)
    if not len(right):
        return np.zeros(0, bool)
    if pa.types.is_nested(values.type):
        items = values.to_pylist()
        return np.array([a != b for a, b in zip(items, items[1:])], bool)
    same = pc.equal(left, right)
    if pa.types.is_floating(values.type):
        same = pc.or_(same, pc.and_(pc.is_nan(left), pc.is_nan(right)))
    same = pc.if_else(pc.is_null(left), pc.is_null(right), pc.fill_null(same, False))
    return ~np.asarray(same)


def first_n(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """The first `n` rows in the given order."""
    return rows.orderBy(*order).limit(n)
