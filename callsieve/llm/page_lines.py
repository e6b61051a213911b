"""Boilerplate lines of web pages, by the host in their address. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callsieve.llm.line_dedup import MAX_PERCENT, MIN_PAGES
from callsieve.llm.shared import broadcast_if_small, stored
from callsieve.operators.checkpoints import checkpointed

# A line on a smaller share of a host's pages stays, wherever the counts would cut.
LEAST_PERCENT = 2
HOST = r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]+)"
UNSEEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|"
    "header|hr|html|li|main|nav|ol|option|p|pre|section|summary|table|tbody|td|tfoot|th|thead|title|tr|ul"
)
BLOCK_TAG = rf"(?i)</?(?:{BLOCKS})\b[^>]*>"
OTHER_TAG = r"<[a-zA-Z/!][^>]*>"


def host_of(url: Column) -> Column:
    """The host of an address in small letters; null if it names none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def page_lines(html: Column) -> Column:
    """The text lines of a page, cut at line ends and block tags; without blank ones. Entities stay as written."""
    seen = F.regexp_replace(html, UNSEEN, " ")
    text = F.regexp_replace(F.regexp_replace(seen, BLOCK_TAG, "\n"), OTHER_TAG, "")
    return F.filter(F.transform(F.split(text, r"[\r\n]+", -1), lambda x: F.trim(x)), lambda x: x != "")


def least_percent(histogram: dict[int, int], least: int = LEAST_PERCENT, most: int = MAX_PERCENT) -> int:
    """The percentage from which lines are boilerplate, from how many lines have each whole percentage (rounded down).

    This is Otsu's cut: of all cuts, the one with the most variance between its two sides, so it lies where
    the hosts' own counts fall apart. All lines on its lower side stay. It is at least `least` and at most
    `most`: menus on all pages would draw it up over lines on fewer pages, and on hosts of very many pages nearly
    all repeated lines are on under one per cent, which is no boilerplate yet.
    """
    best, apart = most, 0.0
    total, weighted = sum(histogram.values()), sum(p * n for p, n in histogram.items())
    below, sum_below = 0, 0
    for percent in sorted(histogram)[:-1]:
        below += histogram[percent]
        sum_below += percent * histogram[percent]
        gap = (sum_below * total - weighted * below) ** 2 / (below * (total - below))
        if gap > apart:
            best, apart = percent + 1, gap
    return max(least, min(best, most))


def without_site_lines(pages: DataFrame, min_pages: int = MIN_PAGES, least: int = LEAST_PERCENT) -> DataFrame:
    """`page_id, host, n_lines, n_dropped, text` of every page of `page_id, url, html`, without boilerplate lines.

    A line goes from a host if it is on `min_pages` of its pages at least and on `least_percent` % of them or more. It
    goes from all hosts if it is on that share of all pages together and on more than half of the hosts: near the
    cut, chance would keep it on some of them. There is one cut for all hosts, from the lines of all of them: most hosts
    have too few repeated lines to find one of their own.

    A null html has no lines and a null text; an empty table gives no rows. Pages without a host form one host, and every
    row is a page, so a repeated row counts again. Very long pages are cut whole. Other columns, whatever their names, play no
    part. Counts are summed in the tasks before any shuffle. What is broadcast for one host, or for all, are lines on
    `least` % of its pages at least: at most 100 / `least` times the lines of an average page.
    """
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), page_lines(F.col("html")).alias("lines"))
    line = F.explode(F.array_distinct("lines"))
    on = cut.select("host", line.alias("line")).groupBy("host", F.xxhash64("line").alias("line"))
    counted = stored(on.agg(F.count(F.lit(1)).alias("pages")))
    totals = checkpointed(cut.groupBy(F.col("host").alias("site")).agg(F.count(F.lit(1)).alias("all_pages")))
    shares = counted.filter(F.col("pages") >= min_pages).join(
        broadcast_if_small(totals), F.col("host").eqNullSafe(F.col("site"))
    )
    percent = F.floor(F.col("pages") * 100 / F.col("all_pages")).cast("int")
    percent = least_percent(dict(shares.groupBy(percent).count().collect()), least)
    hosts, rows = totals.agg(F.count(F.lit(1)), F.coalesce(F.sum("all_pages"), F.lit(0))).first()
    everywhere = (
        counted.groupBy("line")
        .agg(F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("hosts"))
        .filter((F.col("pages") >= min_pages) & (F.col("hosts") * 2 > hosts))
        .filter(F.col("pages") * 100 >= rows * percent)
        .agg(F.collect_list("line").alias("common"))
    )
    often = shares.filter(F.col("pages") * 100 >= F.col("all_pages") * percent).groupBy(F.col("host").alias("site"))
    often = checkpointed(often.agg(F.collect_list("line").alias("often")))
    found = cut.join(broadcast_if_small(often), F.col("host").eqNullSafe(F.col("site")), "left")
    gone = F.concat(F.coalesce("often", F.array().cast("array<long>")), checkpointed(everywhere).scalar())
    kept = F.filter("lines", lambda x: ~F.array_contains("gone", F.xxhash64(x)))
    n = F.coalesce(F.array_size("lines"), F.lit(0)).cast("long")
    made = found.withColumn("gone", gone).select("page_id", "host", n.alias("n_lines"), kept.alias("kept"))
    n_dropped = F.col("n_lines") - F.coalesce(F.array_size("kept"), F.lit(0))
    return made.select("page_id", "host", "n_lines", n_dropped.alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
