"""One registered query per training-data operator, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from callsieve.llm import (
    centroids,
    checks,
    hard_negatives,
    language,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    ngram_join,
    packing,
    page_lines,
    quality,
    repeats,
    token_counts,
    token_shards,
)
from callsieve.llm.shared import read_documents

TRAINING_KEY = 20_240_611


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_near_dedup": op2_near_dedup,
        "op3_line_dedup": op3_line_dedup,
        "op4_neighbours": op4_neighbours,
        "op5_quality_rules": op5_quality_rules,
        "op6_token_counts": op6_token_counts,
        "op7_language": op7_language,
        "op8_repeats": op8_repeats,
        "op9_mixing": op9_mixing,
        "op10_token_shards": op10_token_shards,
        "op11_ngram_join": op11_ngram_join,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_centroids": op13_centroids,
    }


def page_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op3_page_lines": op3_page_lines}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_near_dedup": checks.near_classes(near_dedup.WORDS, near_dedup.PERCENT, kept=True),
        "op3_line_dedup": LINE_DEDUP_SQL,
        "op3_page_lines": checks.PAGE_LINES,
        "op9_mixing": MIXING_SQL,
        "op11_ngram_join": checks.near_classes(ngram_join.WORDS, ngram_join.PERCENT, kept=False),
        "op12_hard_negatives": checks.HARD_NEGATIVES,
        "op13_centroids": checks.centroids(),
    }


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents, with a digest of their ids in place of the ids."""
    pieces = packing.cut(read_documents(spark, sf_dir))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(digests).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_dedup.near_duplicates(read_documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines."""
    kept = line_dedup.without_boilerplate(read_documents(spark, sf_dir).select("doc_id", "source", "text"))
    return kept.select("doc_id", "source", "n_lines", "n_dropped", "text")


def op3_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every web page without its host's boilerplate lines."""
    return page_lines.without_site_lines(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0, 5)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures and the verdict for every document."""
    return quality.judged(read_documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, and which are over the budget, from the written table of prefix counts."""
    return token_counts.over_limit(token_counts.counted_table(read_documents(spark, sf_dir)))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return language.identified(read_documents(spark, sf_dir))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when passages of earlier documents go."""
    return repeats.without_repeats(read_documents(spark, sf_dir)).drop("starts", "ends")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix of all sources takes."""
    mix = mixing.mixed(read_documents(spark, sf_dir).select("doc_id", "source", "text"))
    taken = mix["size"] * mix["copies"]
    return mix.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' sequences as the written shards hold them, with a digest of their ids."""
    table = token_shards.training_shards(read_documents(spark, sf_dir), TRAINING_KEY)
    slots = token_shards.read_slots(table)
    return slots.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under links between almost equal sets of three-word shingles."""
    return ngram_join.joined(read_documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector; every seventh vector's label is moved on by one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector, with its distance, and each cluster's figures."""
    return centroids.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


LINE_DEDUP_SQL = r"""
with lines as (
  select doc_id, source, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: trim(x)))) as line
  from documents
), totals as (
  select source, count(*) as all_pages from documents group by source
), often as (
  select l.source, l.line from lines l join totals t on l.source is not distinct from t.source
  where l.line <> '' group by l.source, l.line, t.all_pages
  having count(*) >= 5 and count(*) * 100 > t.all_pages * 10
), hosts as (
  select source, list(line) as often from often group by source
), cut as (
  select d.doc_id, d.source, string_split(d.text, chr(10)) as lines,
    list_filter(string_split(d.text, chr(10)),
      lambda x: trim(x) = '' or not list_contains(coalesce(h.often, []), trim(x))) as kept
  from documents d left join hosts h on d.source is not distinct from h.source
)
select doc_id, source, coalesce(len(lines), 0)::bigint as n_lines,
  coalesce(len(lines) - len(kept), 0)::bigint as n_dropped, array_to_string(kept, chr(10)) as text
from cut
"""

MIXING_SQL = r"""
with sized as (
  select doc_id, source, text,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents
), totals as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighted as (
  select *, [1, 2, 3][(row_number() over (order by source nulls last) - 1) % 3 + 1]::bigint as weight,
    source_size * 3 as most
  from totals
), levels as (
  select *, most / weight as ratio,
    ((sum(source_size) over ())::bigint - coalesce(sum(most) over (
      order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint
    )::double / (sum(weight) over (
      order by most / weight, source nulls last rows between current row and unbounded following))::double as level
  from weighted
), chosen as (
  select arg_min(level, ratio) as level from levels where level * weight <= most
), targets as (
  select source, source_size, least(most::double, weight * (select level from chosen)) as target from levels
), drawn as (
  select s.doc_id, s.source, s.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    list_transform(range(8), lambda i: ('0x' || substr(md5(concat_ws('|', (i // 4)::varchar,
      coalesce(s.doc_id::varchar, ''), md5(coalesce(s.text, '')))), (1 + 8 * (i % 4))::bigint, 8))::bigint
      / 4294967296.0::double) as draws
  from sized s join targets t on s.source is not distinct from t.source
), times as (
  select *, list_transform(draws, lambda u: floor(rate)::bigint + case when u < rate - floor(rate) then 1 else 0 end)
    as copies
  from drawn
), tried as (
  select source, i, abs(sum(size * copies[i])::double - any_value(target)) as off
  from times, range(1, 9) r(i) group by source, i
), best as (
  select source, arg_min(i, off * 8 + 0) as i from
    (select source, min(i) as i, off from tried group by source, off) group by source
)
select x.doc_id, x.source, x.size, x.source_size, x.target, (x.size * x.copies[b.i])::bigint as taken
from times x join best b on x.source is not distinct from b.source
"""
