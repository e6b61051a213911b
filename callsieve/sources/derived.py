"""Call and image-like tables derived row by row from the `events` and `embeddings` tables.

Only arithmetic on the ids is used, so any SQL engine gives the same rows. The leg table
holds the awkward cases on purpose: excluded and short callers, NULL callees, two-leg calls,
NULL, empty and decimal durations, near-miss addresses and NULL pattern flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callsieve.sources.tables import CALL_SCHEMA, LEG_SCHEMA, typed_fields


def _text(c: Column) -> Column:
    return c.cast("string")


def _subscriber(number: Column, digits: int = 8) -> Column:
    return F.concat(F.lit("130"), F.lpad(_text(number), digits, "0"))


def call_legs(events: DataFrame) -> DataFrame:
    """One or two call legs per event, in the shape of the call-leg table."""
    user, event = F.col("user_id"), F.col("event_id")
    click = F.col("event_type") == "click"

    caller = (
        F.when(user % 25 == 0, F.concat(F.lit("400"), F.lpad(_text(user), 8, "0")))
        .when(user % 25 == 1, F.concat(F.lit("95"), F.lpad(_text(user), 9, "0")))
        .when(user % 25 == 2, F.concat(F.lit("130"), _text(user)))
        .otherwise(_subscriber(user))
    )
    callee = F.when(event % 97 != 0, _subscriber((event * 37 + 11) % 300))
    legs = F.when(event % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    answered = (
        F.when(event % 11 == 0, F.lit(None))
        .when(event % 11 == 1, "")
        .when(event % 11 == 2, "12.7")
        .otherwise(_text(event % 300))
    )
    address = (
        F.when(event % 4 == 0, "10.14.1.1")
        .when(event % 4 == 1, "10.140.2.2")
        .when(event % 4 == 2, "10.14.9.9")
        .otherwise("10x14.1.1")
    )
    fraud = F.when(event % 5 == 0, "1").when(event % 7 == 0, F.lit(None)).otherwise("0")

    values = {
        "calling_number": caller,
        "called_number": callee,
        "calling_operator": F.concat(F.lit("op"), _text(user % 3)),
        "calling_location": F.concat(F.lit("loc"), _text(user % 7)),
        "called_operator": F.concat(F.lit("op"), _text(event % 3)),
        "called_localion": F.concat(F.lit("loc"), _text(event % 7)),
        "calling_countryname": F.lit("CN"),
        "calling_provincename": F.concat(F.lit("prov"), _text(user % 5)),
        "calling_cityname": F.concat(F.lit("city"), _text(user % 11)),
        "btime": _text(1510329600 + event * 10 + F.col("leg")),
        "protocolid": F.when(click, "120").otherwise("121"),
        "call_duration": F.when(~(click & (event % 5 == 0)), _text(event % 600)),
        "answerdur": answered,
        "callid": _text(event),
        "dest_ne_ip": address,
        "mathch_fraud_pattern": fraud,
        "mathch_white_pattern": F.when(event % 2 == 0, "0").otherwise("1"),
        "_add_day": F.when(event % 3 < 2, 20171111).otherwise(20171112),
    }
    return events.withColumn("leg", F.explode(legs)).select(
        [values[f.name].cast(f.dataType).alias(f.name) for f in LEG_SCHEMA.fields]
    )


def calls(events: DataFrame) -> DataFrame:
    """One call per event, in the shape of the call table."""
    user, event = F.col("user_id"), F.col("event_id")
    return events.select(
        _subscriber(user).alias("phone1"),
        F.when(event % 97 != 0, _subscriber((event * 37 + 11) % 300)).alias("phone2"),
        F.when(event % 2 == 0, "call_src").otherwise("call_dst").alias("call_event"),
        (user % 3).alias("phone1_type"),
        (event % 10).alias("phone2_type"),
        _text(event % 600).alias("callDuration"),
        (event % 24).alias("hours"),
    ).select(typed_fields(CALL_SCHEMA))


def labelled_vectors(embeddings: DataFrame) -> DataFrame:
    """`vec_id`, `features` and a class 0..3 that the features decide: the largest of the first four."""
    head = F.slice("embedding", 1, 4)
    return embeddings.select(
        "vec_id",
        F.transform("embedding", lambda x: x * F.lit(10).cast("float")).alias("features"),
        (F.array_position(head, F.array_max(head)) - 1).cast("double").alias("label"),
    )


def rule_predictions(embeddings: DataFrame) -> DataFrame:
    """Labelled rows with a deliberately coarse rule as the prediction, for exact metric checks."""
    head = F.slice("embedding", 1, 4)
    coarse = F.transform(head, lambda x: F.floor(x.cast("double") * 10))
    return embeddings.select(
        "vec_id",
        (F.array_position(head, F.array_max(head)) - 1).cast("double").alias("label"),
        (F.array_position(coarse, F.array_max(coarse)) - 1).cast("double").alias("prediction"),
    )


def gappy_predictions(embeddings: DataFrame) -> DataFrame:
    """`rule_predictions` with some labels and some predictions missing."""
    vec_id = F.col("vec_id")
    return rule_predictions(embeddings).select(
        "vec_id",
        F.when(vec_id % 11 != 0, F.col("label")).alias("label"),
        F.when(vec_id % 7 != 0, F.col("prediction")).alias("prediction"),
    )


def rule_probabilities(embeddings: DataFrame) -> DataFrame:
    """Labelled rows with a softmax over the first four values as class probabilities."""
    head = F.slice("embedding", 1, 4)
    weights = F.transform(head, lambda x: F.exp(x.cast("double") * 10))
    total = F.aggregate("weights", F.lit(0.0), lambda sum_, w: sum_ + w)
    return embeddings.select(
        "vec_id",
        (F.array_position(head, F.array_max(head)) - 1).cast("double").alias("label"),
        weights.alias("weights"),
    ).select("vec_id", "label", F.transform("weights", lambda w: w / total).alias("probability"))
