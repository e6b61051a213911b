"""Dropping lines that too many pages of one site share. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callsieve.llm.shared import broadcast_if_small, fresh
from callsieve.operators.checkpoints import checkpointed

MAX_PERCENT = 10
MIN_PAGES = 5


def boilerplate_lines(
    pages: DataFrame, max_percent: int = MAX_PERCENT, min_pages: int = MIN_PAGES, host: str = "source"
) -> DataFrame:
    """`host, lines`: hashes of the lines on more than `max_percent` of a host's pages, and on `min_pages` at least.

    A line counts once a page, without the spaces around it; blank lines never count. Hashes are 64 bits
    and compared within one host only. The array of a host is bounded: its lines each take over
    `max_percent` of the pages, so there are at most 100 / `max_percent` times as many as a page of
    that host has lines on average. Both counts are summed in the tasks before any shuffle, so a host with a third
    of all pages, or a line on all of them, is no load on one task.
    """
    lines = F.array_distinct(F.transform(F.split(F.col("text"), "\n", -1), lambda x: F.trim(x)))
    found = F.explode_outer(F.filter(lines, lambda x: x != ""))
    on = pages.select(F.col(host).alias("host"), found.alias("line"))
    counted = (
        on.filter(F.col("line").isNotNull())
        .groupBy("host", F.xxhash64("line").alias("line"))
        .agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") >= min_pages)
    )
    totals = pages.groupBy(F.col(host).alias("site")).agg(F.count(F.lit(1)).alias("all_pages"))
    often = counted.join(totals, F.col("host").eqNullSafe(F.col("site"))).filter(
        F.col("pages") * 100 > F.col("all_pages") * max_percent
    )
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


def without_boilerplate(
    pages: DataFrame, max_percent: int = MAX_PERCENT, min_pages: int = MIN_PAGES, host: str = "source"
) -> DataFrame:
    """`pages` with boilerplate lines taken out of `text`, and `n_lines, n_dropped`.

    The other lines stay as they were, in order, blank ones included. A null text stays null with 0
    lines; a page may end up empty; pages without a host form one host. Every row is a page, so equal
    rows each count. Columns of `pages` called `n_lines` or `n_dropped` are replaced.
    """
    pages = pages.drop(*[c for c in pages.columns if c.lower() in ("n_lines", "n_dropped")])
    site, often, lines, kept = fresh(pages, "_site", "_often", "_lines", "_kept")
    found = checkpointed(boilerplate_lines(pages, max_percent, min_pages, host)).toDF(site, often)
    rows = pages.join(broadcast_if_small(found), F.col(host).eqNullSafe(F.col(site)), "left")
    rows = rows.withColumn(lines, F.split("text", "\n", -1))
    stays = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(often, F.xxhash64(F.trim(x))))
    rows = rows.withColumn(kept, F.when(F.col(often).isNull(), F.col(lines)).otherwise(stays))
    n = F.coalesce(F.array_size(lines), F.lit(0)).cast("long")
    return (
        rows.withColumn("n_lines", n)
        .withColumn("n_dropped", n - F.coalesce(F.array_size(kept), F.lit(0)))
        .withColumn("text", F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.array_join(kept, "\n")))
        .drop(site, often, lines, kept)
    )
