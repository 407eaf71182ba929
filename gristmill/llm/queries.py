"""The registered queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, line_dedup, maxent, mixing, quality, secrets, simhash, span_dedup, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark, sf_dir):
    return maxent.score(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark, sf_dir):
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op4_simhash_dedup(spark, sf_dir):
    found = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op5_quality_rules(spark, sf_dir):
    led = quality.ledger(_table(spark, sf_dir, "documents"), out="_ledger")
    of = lambda c: F.col(f"_ledger.{c}")
    return led.select(
        "doc_id", *[of(c).alias(c) for c in quality.MEASURES[:5]], of("failed").alias("failed_rules"),
        (of("failed").bitwiseAND(quality.POLICIES["base"]) != 0).alias("base_failed"), (of("failed").bitwiseAND(quality.POLICIES["v1"]) == 0).alias("kept"),
    )


def op6_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), with_text=False)


def op7_source_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_byte_bpe(spark, sf_dir, vocabulary: str | None = None):
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(_table(spark, sf_dir, "documents"), vocabulary)


def op9_secret_scans(spark, sf_dir):
    return secrets.digests(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op10_span_dedup(spark, sf_dir):
    return span_dedup.dedup_spans(_table(spark, sf_dir, "documents"))


def queries():
    return {f.__name__: f for f in (op1_lm_scoring, op2_url_filter, op3_exact_dedup, op4_simhash_dedup, op5_quality_rules, op6_line_dedup, op7_source_mixing, op8_byte_bpe, op9_secret_scans, op10_span_dedup)}


_WS = r"\x20\x09-\x0D"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES = {
    "op3_exact_dedup": """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents) window w as (partition by t)""",
    "op5_quality_rules": f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(regexp_split_to_array(t, '[{_WS}]+'), lambda x: x <> '') as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_WS}]')) as ls from d),
g as (select doc_id, i, array_to_string(ws[i:i+4], ' ') as gram from (select doc_id, ws, unnest(generate_series(1, len(ws) - 4)) as i from w)),
hit as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as c from g) where c > 1),
rep as (select doc_id, count(distinct i + k) as n from hit, (select unnest(generate_series(0, 4)) as k) group by doc_id),
m as (select w.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words, len(ls) as nl from w left join rep on w.doc_id = rep.doc_id),
f as (select *, case when n_words < 10 then 1 else 0 end + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end + case when word_chars < 2 * n_words or word_chars > 30 * n_words then 4 else 0 end
  + case when n_symbols > n_words then 8 else 0 end + case when 2 * n_dup_lines > nl then 16 else 0 end as failed_rules from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_rules::integer as failed_rules, failed_rules & 3 <> 0 as base_failed, failed_rules = 0 as kept from f""",
    "op6_line_dedup": f"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, i, ls[i] as line, regexp_replace(regexp_replace(translate(ls[i], {_LOWER}), '^[{_WS}]+', ''), '[{_WS}]+$', '') as k from (select doc_id, ls, unnest(generate_series(1, len(ls))) as i from d)),
r as (select k, max(doc_id) as last from l where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
j as (select l.doc_id, i, line, last is not null and last <> l.doc_id as gone from l left join r on l.k = r.k)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256 from j group by doc_id""",
}


def oracle_sql():
    return dict(ORACLES)
