"""A document corpus from raw text to packed sequences.

Each stage gets the rows that the one before it kept and returns what it decides: documents go, lose
lines, or are repeated. All stages but the last return the columns of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callsieve.llm import line_dedup, mixing, near_dedup, packing, quality
from callsieve.llm.shared import named_as, plain_names, read_documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null text is rejected, as it has no words."""
    names = plain_names(docs, "text")
    return named_as(quality.judged(docs.toDF(*names)).filter("kept"), names, docs)


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines; `n_chars` follows the text."""
    names = plain_names(docs, "source", "text", "n_chars")
    cut = line_dedup.without_boilerplate(docs.toDF(*names))
    if "n_chars" in names:
        n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars)
    return named_as(cut, names, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Documents with a null, empty or blank text have no shingles and all stay. Equal rows are kept once; of different
    texts with one id in a group, that with the smallest hash stays. Texts are compared whole, however long.
    """
    return near_dedup.deduplicated(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, whole.

    A null source is a source of its own. A document without words counts as size 0 and is taken by its source's rate
    like the others; a source without any words gives no rows. Equal rows are taken equally often.
    """
    return mixing.emitted(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces, ids included: every row of the mix is a document of its own, a null text one id 0.

    Of the other columns, `doc_id` alone is carried over; a null id stays null. No documents, no pieces.
    """
    pieces = packing.cut(docs).withColumn("ids_crc32", F.crc32("ids"))
    return packing.packed(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", boilerplate_lines),
    ("near dedup", near_duplicates),
    ("source mix", source_mix),
    ("packing", packed_sequences),
]
# SQL expresses neither near-duplicate classes nor token ids; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are a stored table, the next one's input."""
    docs = read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
