"""

Array results are returned one value per row (`pos`, `value`), so that two engines' results can
be compared without comparing their array types.
"""

from __future__ import annotations

import importlib
import sys
import uuid
from collections.abc import Callable
from pathlib import Path
from types import ModuleType

ROOT = Path(__file__).resolve().parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

import numpy as np  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession, functions as F  # noqa: E402

import sql_checks  # noqa: E402
from callsieve.functions import arrays, casts, python_udfs, text  # noqa: E402
from callsieve.ml import features, metrics, split  # noqa: E402
from callsieve.ml.mlp import DistributedMLP, DistributedMLPModel  # noqa: E402
from callsieve.ml.synchronous import SynchronousMLP  # noqa: E402
from callsieve.operators import calls, history  # noqa: E402
from callsieve.operators.checkpoints import use_checkpoint_dir  # noqa: E402
from callsieve.operators.endpoint_join import either_endpoint_join  # noqa: E402
from callsieve.operators.groups import MAX_ROWS  # noqa: E402
from callsieve.plans import image_classifier, stored_traffic, suspect_traffic  # noqa: E402
from callsieve.sources import day_states, derived, tables  # noqa: E402
from callsieve.sources.leg_table import LegTable, write_leg_table  # noqa: E402

try:  # the training-data operators are an add-on: without their folder, everything else works
    import corpus_pipeline
    from callsieve.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "callsieve.llm", "callsieve.llm.queries"):
        raise
    llm_queries = None

# Callers in `events` make about 67 calls each, so the usual minimum of 100 would leave no rows.
RULES = calls.SuspectRules(min_calls=30)
# Small enough that most keys in `events` are cut into parts, as very large ones are.
SMALL_PART = 25
# Callers in `events` have 60 to 80 legs on one day: some are ordinary ones in the stored table, others frequent.
FREQUENT_LEGS = 60
USER_FILE = str(ROOT / "examples" / "call_scores.py")


def entry(spark: SparkSession) -> DataFrame:
    """Sessions that touch a heavy caller, on the smallest data."""
    return queries()["cdr_suspect_traffic"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return _own_queries()
    return _own_queries() | llm_queries.queries() | llm_queries.page_queries() | {"pipeline": corpus_pipeline.run}


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "cdr_scan": lambda s, d: calls.legs_of_day(_legs(s, d), RULES),
        "cdr_caller_filter": _caller_filter,
        "cdr_pattern_filter": _pattern_filter,
        "cdr_distinct_calls": lambda s, d: calls.distinct_calls(_legs(s, d)),
        "cdr_session_rollup": lambda s, d: calls.session_rollup(calls.legs_of_day(_legs(s, d), RULES)),
        "cdr_heavy_callers": _heavy_callers,
        "either_endpoint_join": _either_endpoint_join,
        "cdr_suspect_traffic": lambda s, d: suspect_traffic.suspect_traffic(_legs(s, d), RULES),
        "cdr_suspect_traffic_measured": lambda s, d: suspect_traffic.suspect_traffic_measured(
            _legs(s, d), RULES
        ),
        "cdr_suspect_traffic_shuffled": lambda s, d: suspect_traffic.suspect_traffic_measured(
            _legs(s, d), RULES, broadcast_bytes=0
        ),
        "cdr_suspect_traffic_sql": lambda s, d: suspect_traffic.suspect_traffic_sql(s, _legs(s, d), RULES),
        "cdr_suspect_traffic_filtered": lambda s, d: suspect_traffic.suspect_traffic_filtered(_legs(s, d), RULES),
        "cdr_heavy_callers_sketched": lambda s, d: suspect_traffic.sketched_heavy_callers(
            calls.legs_of_day(_legs(s, d), RULES), RULES
        ),
        "cdr_table_scan": lambda s, d: calls.legs_of_day(_leg_table(s, d).legs(), RULES),
        "cdr_table_distinct_calls": lambda s, d: stored_traffic.stored_distinct_calls(_leg_table(s, d)),
        "cdr_table_session_rollup": lambda s, d: stored_traffic.stored_sessions(_leg_table(s, d), RULES),
        "cdr_table_heavy_callers": lambda s, d: stored_traffic.stored_heavy_callers(_leg_table(s, d), RULES),
        "cdr_table_suspect_traffic": lambda s, d: stored_traffic.stored_suspect_traffic(_leg_table(s, d), RULES),
        "cdr_day_sessions": lambda s, d: day_states.sessions_of_days(s, _day_states(s, d)),
        "cdr_day_suspect_traffic": lambda s, d: day_states.suspect_traffic_of_days(s, _day_states(s, d), RULES, RULES.day),
        "safe_bigint": _safe_bigint,
        "duration_expr": _duration_expr,
        "regex_replace_all": _regex_replace_all,
        "calls_literal": _calls_literal,
        "calls_typed": _calls,
        "call_history_by_phone": lambda s, d: _history_rows(s, d, history.CALL_FIELDS),
        "call_history_by_phone_6": lambda s, d: _history_rows(s, d, history.CALL_FIELDS_WITHOUT_EVENT),
        "call_history_in_parts": _history_in_parts,
        "call_history_json": _history_json,
        "call_history_variant": _history_variant,
        "py_scalar_sql": _py_scalar_sql,
        "py_scalar_add": _py_scalar_add,
        "py_module_udf": _py_module_udf,
        "py_grouped_score": _py_grouped_score,
        "py_grouped_score_in_parts": lambda s, d: _py_grouped_score(s, d, SMALL_PART),
        "py_grouped_score_large_keys": _large_key_scores,
        "py_grouped_stream": _py_grouped_stream,
        "py_ndarray_reshape": _py_ndarray_reshape,
        "take_n": lambda s, d: history.first_n(_py_grouped_score(s, d), 5, "phone1"),
        "array_reshape": _array_reshape,
        "ml_load": lambda s, d: _vectors(s, d).select("vec_id", "label", *_values(F.col("embedding"))),
        "ml_labelled": _ml_labelled,
        "ml_scale": lambda s, d: features.scaled_images(_vectors(s, d), "embedding").select(
            "vec_id", *_values(F.col("embedding"))
        ),
        "ml_flatten": _ml_flatten,
        "ml_one_hot": lambda s, d: _vectors(s, d).select(
            "vec_id", *_values(arrays.one_hot(_gappy_label(), 10))
        ),
        "ml_train_test": lambda s, d: split.with_part(_vectors(s, d).select("vec_id"), "vec_id", 0.1),
        "ml_validation_split": lambda s, d: split.with_part(
            _vectors(s, d).select("vec_id"), "vec_id", 0.1, "validation", "fit", start=0.1
        ),
        "ml_exact_split": lambda s, d: split.with_exact_part(
            _vectors(s, d).select("vec_id", "label"), "vec_id", "label", 0.1
        ),
        "ml_row_counts": _ml_row_counts,
        "ml_confusion": lambda s, d: metrics.confusion(_rule_predictions(s, d)),
        "ml_precision_micro": lambda s, d: metrics.micro_precision(_gappy_predictions(s, d)),
        "ml_recall_micro": lambda s, d: metrics.micro_recall(_gappy_predictions(s, d)),
        "ml_per_class": lambda s, d: metrics.per_class(_gappy_predictions(s, d)),
        "ml_weighted": _ml_weighted,
        "ml_log_loss": _ml_log_loss,
        "show_predictions": lambda s, d: history.first_n(_rule_predictions(s, d), 100, "vec_id"),
        "ml_mlp_builtin": _ml_mlp_builtin,
        "ml_mlp_distributed": _ml_mlp_distributed,
        "ml_mlp_linear": _ml_mlp_linear,
        "ml_mlp_synchronous": _ml_mlp_synchronous,
        "ml_mlp_synchronous_rounds": _ml_mlp_synchronous_rounds,
        "ml_mlp_adadelta": _ml_mlp_adadelta,
        "ml_mlp_data_parallel": _ml_mlp_data_parallel,
        "ml_predict": _ml_predict,
        "ml_end_to_end": _ml_end_to_end,
    }


def oracle_sql() -> dict[str, str]:
    return sql_checks.checks() | (llm_queries.oracle_sql() if llm_queries else {})


def _legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.call_legs(tables.read_table(spark, sf_dir, "events"))


_leg_tables: dict[tuple[str, str], LegTable] = {}


def _leg_table(spark: SparkSession, sf_dir: str) -> LegTable:
    """The legs as a stored table, written once per application and data folder."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _leg_tables:
        _leg_tables[key] = write_leg_table(_legs(spark, sf_dir), frequent_legs=FREQUENT_LEGS)
    return _leg_tables[key]


def _day_states(spark: SparkSession, sf_dir: str) -> str:
    """A folder with day states of the legs of the watched addresses, of which a tenth come late."""
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/day-states-{uuid.uuid4().hex}"
    watched = _legs(spark, sf_dir).filter(F.col("dest_ne_ip").startswith(RULES.address_prefix))
    late = F.col("callid").cast("long") % 10 == 7
    day_states.write_day_states(watched.filter(~late), folder, RULES)
    day_states.add_late_legs(watched.filter(late), folder, RULES)
    return folder


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.calls(tables.read_table(spark, sf_dir, "events"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, sf_dir, "embeddings")


def _rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.rule_predictions(_vectors(spark, sf_dir))


def _gappy_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.gappy_predictions(_vectors(spark, sf_dir))


def _gappy_label() -> Column:
    return F.when(F.col("vec_id") % 11 != 0, F.col("label"))


def _values(array: Column) -> list[Column]:
    return [F.posexplode(array.cast("array<double>")).alias("pos", "value")]


def _user_module(spark: SparkSession) -> ModuleType:
    """The user's file, sent to the executors and imported here."""
    spark.sparkContext.addPyFile(USER_FILE)
    return importlib.import_module(Path(USER_FILE).stem)


def _calls_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal calls with declared types, joined to the events of the minute that each one names."""
    rows = [("100", "204", "call_dst", 1, 2, "17", 3), ("101", "0991", "call_src", 2, 2, "3", 22)]
    literal = tables.rows_to_frame(spark, rows)
    events = tables.read_table(spark, sf_dir, "events")
    return events.join(F.broadcast(literal), events["event_id"] % 24 == F.col("hours")).select("event_id", *literal.columns)


def _caller_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _legs(spark, sf_dir).filter(calls.allowed_caller(RULES))
    return kept.select("calling_number", "called_number", "callid", "btime")


def _pattern_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _legs(spark, sf_dir).filter(calls.pattern_clear())
    return kept.select("callid", "btime", "mathch_fraud_pattern", "mathch_white_pattern")


def _heavy_callers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.heavy_callers(calls.legs_of_day(_legs(spark, sf_dir), RULES), RULES)


def _either_endpoint_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = calls.session_rollup(_legs(spark, sf_dir)).select(
        "calling_number", "called_number", "callid", "cnt"
    )
    keys = _heavy_callers(spark, sf_dir)
    ends = ("calling_number", "called_number")
    return either_endpoint_join(sessions, keys, ends, "calling_number", ["calls"])


def _safe_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    number = event.cast("string")
    forms = [
        number,
        F.concat(F.lit(" "), number, F.lit(" ")),
        F.concat(number, F.lit(".7")),
        F.concat(F.lit("-"), number, F.lit(".7")),
        F.concat(F.lit("."), number),
        F.lit("."),
        F.concat(number, F.lit(".9999999")),
        F.concat(number, F.lit("e3")),
        F.concat(F.lit("9223372036854775808"), number),
        F.concat(F.lit("abc"), number),
        F.lit(""),
        F.lit(None).cast("string"),
        F.concat(F.lit("+"), number),
    ]
    form = F.coalesce(*[F.when(event % len(forms) == i, f) for i, f in enumerate(forms)])
    return (
        tables.read_table(spark, sf_dir, "events")
        .select("event_id", form.alias("txt"))
        .withColumn("number", casts.lenient_bigint(F.col("txt")))
    )


def _duration_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _legs(spark, sf_dir).select(
        "callid", "btime", "protocolid", calls.leg_seconds().alias("seconds")
    )


def _regex_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.read_table(spark, sf_dir, "pages")
    return pages.select("page_id", text.replace_all(F.col("html")).alias("cleaned"))


def _history_rows(
    spark: SparkSession, sf_dir: str, fields: tuple[str, ...], max_rows: int = MAX_ROWS
) -> DataFrame:
    collected = history.collect_history(_calls(spark, sf_dir), "phone1", fields, max_rows)
    return collected.select("phone1", "part", F.posexplode("calls").alias("pos", "call")).select(
        "phone1", "part", "pos", *[f"call.{f}" for f in fields if f != "phone1"]
    )


def _history_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_rows(spark, sf_dir, history.CALL_FIELDS, SMALL_PART)


def _large_key_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by a bigint key beyond what a double holds exactly, with NULL keys beside it."""
    user = F.col("user_id")
    key = F.when(user % 10 != 0, user + F.lit(2**53)).alias("big_id")
    rows = tables.read_table(spark, sf_dir, "events").select(key, "event_id")
    return history.score_by_key(
        rows,
        "big_id",
        _user_module(spark).id_summary,
        "big_id bigint, n bigint, last_event bigint",
        [F.sum("n").alias("n"), F.max("last_event").alias("last_event")],
        SMALL_PART,
    )


def _history_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    collected = history.collect_history(_calls(spark, sf_dir))
    return collected.select("phone1", "part", text.nested_json(F.col("calls")).alias("calls"))


def _history_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The callee and the seconds of every call, read by path from histories written as VARIANT values."""
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/variant-history-{uuid.uuid4().hex}"
    history.variant_history(history.collect_history(_calls(spark, sf_dir))).write.parquet(folder)
    return history.variant_rows(spark.read.parquet(folder), {"phone2": "string", "callDuration": "string"})


def _py_scalar_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_udfs.register_function(spark, "py_add", _user_module(spark).add, "long")
    return spark.sql(
        "select event_id, py_add(event_id, user_id) as total from {events}",
        events=tables.read_table(spark, sf_dir, "events"),
    )


def _py_scalar_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    add = python_udfs.batch_function(_user_module(spark).add, "long")
    events = tables.read_table(spark, sf_dir, "events")
    return events.select("event_id", add("event_id", "user_id").alias("total"))


def _py_module_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    add = python_udfs.module_function(spark, USER_FILE, "add", "long")
    return _calls(spark, sf_dir).select(
        "phone1", "phone2", "hours", add("hours", "phone2_type").alias("total")
    )


def _py_grouped_score(spark: SparkSession, sf_dir: str, max_rows: int = MAX_ROWS) -> DataFrame:
    return history.score_by_key(
        _calls(spark, sf_dir),
        "phone1",
        _user_module(spark).call_summary,
        "phone1 string, calls bigint, seconds bigint, longest bigint, night_calls bigint",
        [
            F.sum("calls").alias("calls"),
            F.sum("seconds").alias("seconds"),
            F.max("longest").alias("longest"),
            F.sum("night_calls").alias("night_calls"),
        ],
        max_rows,
    )


def _py_grouped_stream(spark: SparkSession, sf_dir: str, batch_rows: int = SMALL_PART) -> DataFrame:
    """Each caller's longest silence, from its legs in order; most callers have several batches."""
    start = casts.lenient_bigint(F.col("btime")).alias("start")
    return history.stream_by_key(
        _legs(spark, sf_dir).select("calling_number", start),
        "calling_number",
        ["start"],
        _user_module(spark).longest_gap,
        "calling_number string, legs bigint, longest_gap bigint, since bigint",
        batch_rows,
    )


def _py_ndarray_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir).select("vec_id", "embedding")
    made = python_udfs.map_matrices(
        vectors, "embedding", (32, 2), _user_module(spark).transposed, "transposed"
    )
    return made.select("vec_id", *_values(F.col("transposed")))


def _array_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = arrays.reshape(F.col("embedding").cast("array<double>"), 32, 2)
    return (
        _vectors(spark, sf_dir)
        .select("vec_id", F.posexplode(matrix).alias("pos", "row"))
        .select("vec_id", "pos", F.get("row", F.lit(0)).alias("x0"), F.get("row", F.lit(1)).alias("x1"))
    )


def _ml_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    one_hot = arrays.one_hot(_gappy_label(), 10)
    rows = features.labelled(_vectors(spark, sf_dir), F.col("embedding"), one_hot, True, "vec_id")
    return rows.select("vec_id", "label", *_values(vector_to_array("features")))


def _ml_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The vector's two halves as matrix rows, second half first.
    matrix = F.array(F.slice("embedding", 33, 32), F.slice("embedding", 1, 32))
    return _vectors(spark, sf_dir).select("vec_id", *_values(arrays.flatten_matrix(matrix)))


def _ml_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split.with_part(_vectors(spark, sf_dir), "vec_id", 0.1)
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def _ml_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = metrics.log_loss(derived.rule_probabilities(_vectors(spark, sf_dir)))
    return loss.select(F.round("log_loss", 9).alias("log_loss"))


def _labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.labelled_vectors(_vectors(spark, sf_dir))


def _ml_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = metrics.weighted(metrics.per_class(_gappy_predictions(spark, sf_dir)))
    return classes.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall")])


def _ml_mlp_builtin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.labelled(
        _labelled_vectors(spark, sf_dir), F.col("features"), F.col("label"), False, "vec_id"
    )
    scored = image_classifier.train_and_score(rows, image_classifier.builtin_mlp([64, 32, 4]), "vec_id")
    return _reached(scored, 0.6)


def _reached(scored: DataFrame, floor: float) -> DataFrame:
    """How many rows were scored, and whether accuracy reached `floor`."""
    return scored.agg(F.count("label").alias("n"), (metrics.share_right() >= floor).alias("reached"))


def _one_layer(**settings) -> DistributedMLP:
    """A network without hidden layers, all weights zero, that sees each task's rows as one batch.

    At zero weights every class has probability 1/4, so a task's change is its mean gradient, and the
    average over tasks is that of all rows, however they are partitioned.
    """
    return DistributedMLP(
        layers=[64, 4], initialWeights=[0.0] * 260, batchSize=0, localOptimizer="plain", dropout=0.0,
        validationSplit=0.0, **settings,
    )


def _weights(spark: SparkSession, model, digits: int = 2) -> DataFrame:
    values = [(i, float(w)) for i, w in enumerate(model.weights)]
    frame = spark.createDataFrame(values, "pos int, value double")
    return frame.select("pos", (F.round("value", digits) + F.lit(0.0)).alias("value"))


def _hidden_weights() -> list[float]:
    """Fixed weights of a network with a hidden layer: a pattern of 11 values in the order of the weights."""
    return [(i * 7 % 11 - 5) / 20 for i in range(64 * 3 + 3 + 3 * 4 + 4)]


def _ml_mlp_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights of a network with a hidden ReLU layer after one round: each task's step, averaged over the tasks."""
    estimator = DistributedMLP(
        layers=[64, 3, 4], initialWeights=_hidden_weights(), batchSize=0, localOptimizer="plain", optimizer="plain",
        dropout=0.0, validationSplit=0.0, numWorkers=4,
    )
    return _weights(spark, estimator.fit(_labelled_vectors(spark, sf_dir)), 3)


def _ml_mlp_synchronous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same network's weights after one step that four tasks make together."""
    estimator = SynchronousMLP(
        layers=[64, 3, 4], initialWeights=_hidden_weights(), batchSize=0, optimizer="plain", validationSplit=0.0,
        numWorkers=4,
    )
    return _weights(spark, estimator.fit(_labelled_vectors(spark, sf_dir)), 3)


def _ml_mlp_synchronous_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adam on shared mini-batches, a tenth held out: rows scored, and whether accuracy reached a floor."""
    estimator = SynchronousMLP(
        layers=[64, 32, 4], settings={"rate": 0.05}, epochs=12, batchSize=2048, numWorkers=4, validationSplit=0.1
    )
    return _reached(image_classifier.train_and_score(_labelled_vectors(spark, sf_dir), estimator, "vec_id"), 0.6)


def _ml_mlp_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights of a network without hidden layers after one round of plain averaging from zero."""
    return _weights(spark, _one_layer(optimizer="plain").fit(_labelled_vectors(spark, sf_dir)))


def _ml_mlp_adadelta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights after one Adadelta step on the change that three tasks average."""
    settings = {"decay": 0.9, "eps": 0.01}
    estimator = _one_layer(optimizer="adadelta", settings=settings, numWorkers=3)
    return _weights(spark, estimator.fit(_labelled_vectors(spark, sf_dir)))


def _ml_mlp_data_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adam in four tasks, Adadelta on the change, dropout, batches of 64, a tenth held out."""
    rows = _labelled_vectors(spark, sf_dir)
    estimator = DistributedMLP(
        layers=[64, 128, 128, 4], localOptimizer="adam", localSettings={"rate": 0.01}, optimizer="adadelta",
        settings={"decay": 0.95, "eps": 0.01}, numWorkers=4, epochs=10, batchSize=64, dropout=0.2, validationSplit=0.1,
    )
    return _reached(image_classifier.train_and_score(rows, estimator, "vec_id"), 0.55)


def _ml_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by a network whose weights pass the first four features on to the four classes."""
    weights = np.zeros((65, 4), np.float32)
    weights[range(4), range(4)] = 1
    model = DistributedMLPModel(weights.ravel())
    model._set(layers=[64, 4], featuresCol="features", predictionCol="prediction", probabilityCol="probability")
    scored = model.transform(_labelled_vectors(spark, sf_dir))
    probability = F.round(F.get("probability", F.col("prediction").cast("int")), 3)
    return scored.select("vec_id", "prediction", probability.alias("probability"))


def _ml_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled_vectors(spark, sf_dir)
    one_hot = rows.withColumn("one_hot", arrays.one_hot(F.col("label"), 4))
    estimator = DistributedMLP(
        layers=[64, 128, 128, 4], batchSize=8, optimizer="plain", epochs=8, labelCol="one_hot",
        categoricalLabels=True, numClasses=4,
    )
    figures = image_classifier.end_to_end(one_hot, estimator, "vec_id")
    return figures.select("n", (F.col("precision") >= 0.6).alias("reached"))
