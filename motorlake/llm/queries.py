"""The registered query of each operator, with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.llm import (
    decontaminate,
    exact_dedup,
    line_runs,
    lm,
    mixing,
    quality,
    simhash,
    token_shards,
    toxicity,
    tree_queries,
    warc,
)
from motorlake.llm.common import table
from motorlake.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES", "tree_queries"]

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


@query(
    "op2_mixing",
    oracle=rf"""
    with sized as (
      select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size from documents),
    totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
    weighed as (
      select *, (row_number() over (order by source is null, source) - 1) % 3 + 1 as weight from totals),
    ordered as (
      select *, row_number() over (order by 3 * source_size / weight, source is null, source) as k from weighed),
    filled as (
      select *, sum(source_size) over () as total, sum(weight) over () as weights,
        coalesce(sum(3 * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0) as held,
        coalesce(sum(weight) over (order by k rows between unbounded preceding and 1 preceding), 0) as held_weight
      from ordered),
    level as (
      select total - held as room, weights - held_weight as open from filled
      where 3 * source_size * (weights - held_weight) >= weight * (total - held) order by k limit 1),
    goals as (
      select source, source_size, case when 3 * source_size * open < weight * room
        then cast(3 * source_size as double)
        else cast(cast(weight * room as bigint) as double) / cast(open as double) end as target
      from weighed, level),
    rated as (
      select doc_id, size, source_size, target, least(case when source_size > 0
          then target / cast(source_size as double) else 0.0 end, cast(3 as double)) as rate,
        cast(('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar), 'null')), 1, 13))::bigint as double)
          / cast(4503599627370496 as double) as u
      from sized join goals on sized.source is not distinct from goals.source)
    select doc_id, size, source_size, target,
      cast(size * (cast(floor(rate) as bigint) + case when u < rate - floor(rate) then 1 else 0 end) as bigint) as taken
    from rated
    """,
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query(
    "op7_exact_dedup",
    oracle=rf"""
    with hashed as (
      select doc_id, length(coalesce(text, '')) as chars,
        sha256(regexp_replace(coalesce(text, ''), '{_SPACE}+', '', 'g')) as text_sha256 from documents),
    ranked as (
      select *, first_value(doc_id) over w as keep_id, row_number() over w as rn,
        count(*) over (partition by text_sha256) as group_size
      from hashed window w as (partition by text_sha256 order by chars desc, doc_id nulls last))
    select doc_id, keep_id, cast(group_size as bigint) as group_size, rn = 1 as kept, text_sha256 from ranked
    """,
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.digested(table(spark, sf_dir, "documents"))
    history, arrivals = exact_dedup.batches(rows)
    return exact_dedup.deduplicate(history, arrivals).drop("row_id")


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


@query(
    "op9_warc",
    oracle="""
    with stored as (
      select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages),
    ranked as (
      select *, case when payload_bytes >= 1000 then max(page_id) over (partition by html) end as first from stored)
    select page_id, cast(payload_bytes as bigint) as payload_bytes, sha1(html) as payload_digest,
      case when first <> page_id then 'revisit' else 'response' end as record_type,
      case when first <> page_id then first end as refers_to
    from ranked
    """,
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op6_benchmark_decontamination")
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_token_shards")
def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.slots(table(spark, sf_dir, "documents"))


@query(
    "op8_line_dedup",
    oracle=rf"""
    with docs as (
      select doc_id, text, string_split(coalesce(text, ''), chr(10)) as parts from documents),
    lines as (
      select doc_id, unnest(range(1, len(parts) + 1)) as p, unnest(parts) as line from docs where text is not null),
    classed as (
      select *, dense_rank() over (order by line) as id, len(regexp_extract_all(line, '{_WORD}')) as words from lines),
    texts as (
      select doc_id, list(id order by p) as ids, list(words order by p) as words from classed group by doc_id),
    starts as (select *, unnest(range(1, len(ids) + 1)) as s from texts),
    runs as (
      select doc_id, s, e, cast(ids[s:e] as varchar) as k, list_sum(words[s:e]) as words
      from (select *, unnest(range(s, len(ids) + 1)) as e from starts)),
    copies as (select *, row_number() over (partition by k order by doc_id, s) as n from runs),
    reach as (select doc_id, s, max(e) as e from copies where n > 1 and words >= 25 group by doc_id, s),
    gone as (
      select distinct lines.doc_id, lines.p from lines join reach
      on lines.doc_id = reach.doc_id and lines.p between reach.s and reach.e),
    rest as (
      select doc_id, string_agg(line, chr(10) order by p) as text from lines anti join gone using (doc_id, p)
      group by doc_id),
    counted as (select doc_id, count(*) as n from gone group by doc_id)
    select docs.doc_id, cast(case when docs.text is null then 0 else len(parts) end as bigint) as lines,
      cast(coalesce(counted.n, 0) as bigint) as removed,
      case when docs.text is null then null else coalesce(rest.text, '') end as text
    from docs left join rest using (doc_id) left join counted using (doc_id)
    """,
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_runs.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "lines", "removed", "text")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))
