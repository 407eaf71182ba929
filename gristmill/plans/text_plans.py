"""Scalar functions, filters and the quality score over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import filters, quality, records
from . import REC, query, strip_sql, table

_A, _U = strip_sql("answer"), strip_sql("usr")
_STATS = """
st as (select doc_id, lang, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '\\s+', '', 'g') as c from documents),
cs as (select doc_id, lang, length(c) as total, len(regexp_extract_all(c, '[A-Za-z]')) as latin, len(regexp_extract_all(c, '[぀-ゟ]')) as hiragana, len(regexp_extract_all(c, '[゠-ヿㇰ-ㇿ]')) as katakana,
  len(regexp_extract_all(c, '[㐀-䶿一-鿿]')) as cjk, len(regexp_extract_all(text, '(?i)```|</?[A-Za-z][^>]*>|\\b(def|class|import|function|const|SELECT|FROM)\\b|[{};]')) as code_markers from st)"""


@query("scl1_tokens", "select doc_id, case when length(coalesce(text, '')) = 0 then 0 else greatest(1, ceil(length(text) / 2.0)) end::bigint as token_estimate from documents")
def scl1(spark, d):
    return table(spark, d, "documents").select("doc_id", X.token_estimate("text").alias("token_estimate"))


@query("scl2_char_stats", f"with {_STATS} select doc_id, total, latin, hiragana, katakana, cjk, code_markers from cs")
def scl2(spark, d):
    return table(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in X.char_stats("text").items()])


@query("scl3_language", f"""with {_STATS}, r as (select *, greatest(1, total)::double as t from cs),
s as (select *, (hiragana + katakana) / t as j, cjk / t as k, latin / t as e, least(1.0, code_markers / greatest(1.0, t / 80)) as q from r)
select doc_id, case when j >= 0.08 or (j >= 0.03 and k >= 0.15) then case when e >= 0.15 then 'mixed' else 'japanese' end when q >= 0.45 and e >= 0.10 then 'code-heavy'
  when lang = 'en' or e >= 0.35 then 'english' else 'unknown' end as language, round_even(least(1.0, j + 0.25 * k), 6) as japanese_ratio, round_even(least(1.0, e), 6) as english_ratio, round_even(q, 6) as code_ratio from s""")
def scl3(spark, d):
    docs = table(spark, d, "documents")
    stats = docs.select("doc_id", "lang", *[c.alias(n) for n, c in X.char_stats("text").items()])
    made = X.language({n: F.col(n) for n in ("total", "latin", "hiragana", "katakana", "cjk", "code_markers")}, F.col("lang"))
    return stats.select("doc_id", *[c.alias(n) for n, c in made.items()])


_TOP = f"""
ln as (select *, list_filter(list_transform(string_split(answer, chr(10)), lambda x: {strip_sql('x')}), lambda x: x <> '') as ls from rec),
tp as (select *, {_A} as a, {_U} as u, len(ls) as nl, case when len(ls) > 0 then list_max(map_values(list_aggregate(ls, 'histogram'))) / len(ls)::double else 0.0 end as share from ln)"""


@query("scl11_quality", f"""with {REC}, {_TOP},
w as (select *, u || a as whole from tp),
q as (select record_id, case when u <> '' and a <> '' then 20.0 else 0.0 end as structural,
 greatest(0.0, least(20.0, 20 - 500.0 * (length(whole) - length(replace(whole, chr(65533), ''))) / greatest(1, length(whole)) - case when nl > 0 then greatest(0.0, least(10.0, 10 * share - 2)) else 0.0 end)) as linguistic,
 least(20.0, 7.0 + case when length(a) >= 40 then 6 else 0 end + case when length(a) / greatest(1, length(u))::double >= 0.35 then 4 else 0 end) as completeness,
 greatest(0.0, least(15.0, 15 * (0.45 + least(0.55::double, 2.0::double * len(list_distinct(list_filter(string_split(whole, ''), lambda x: x <> ''))) / greatest(1, length(whole)))))) as density, 10.0 as usefulness, 10.0 as format_integrity from w),
r as (select record_id, round_even(structural::double, 3) as structural, round_even(linguistic::double, 3) as linguistic, round_even(completeness::double, 3) as completeness, round_even(density::double, 3) as density, round_even(usefulness::double, 3) as usefulness, round_even(format_integrity::double, 3) as format_integrity from q)
select *, round_even(structural + linguistic + completeness + density + usefulness + format_integrity, 3) as quality_score from r""")
def scl11(spark, d):
    rec = records.from_documents(table(spark, d, "documents"))
    p = quality.parts(category=F.col("category"))
    scored = rec.select("record_id", *[c.alias(n) for n, c in p.items()])
    return scored.withColumn("quality_score", quality.total(list(p)))


_FILTER = f"""{REC}, {_TOP},
f as (select *, greatest(1, length(a)) as n, concat_ws(chr(10), nullif(usr, ''), nullif(answer, '')) as whole from tp),
fr as (select record_id, category, list_filter([case when u = '' then 'empty_user' end, case when a = '' then 'empty_assistant' end,
 case when regexp_matches(a, '(?i)^(?:n/?a|none|null|todo|tbd|placeholder|未回答|回答なし)[.!。\\s]*$') then 'placeholder_answer' end,
 case when length(a) <= 240 and regexp_matches(a, '(?i)(?:I\\s+can(?:not|''t)|申し訳ありません|お手伝いできません|対応できません)') then 'refusal_only' end,
 case when regexp_matches(a, '(?i)(?:Traceback \\(most recent call last\\)|Exception:|Error:\\s*\\w+Error)') and length(a) < 1200 then 'stack_trace_only' end,
 case when (length(a) - length(replace(a, chr(65533), ''))) / n::double > 0.01 then 'unicode_corruption' end,
 case when len(regexp_extract_all(a, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]')) / n::double > 0.02 then 'control_character_corruption' end,
 case when nl >= 4 and share >= 0.65 then 'meaningless_repetition' end,
 case when length(a) > 40 and contains(lower(a), '<html') and not contains(lower(a), '</html') then 'html_navigation_garbage' end,
 case when regexp_matches(whole, '\\bsk-[A-Za-z0-9]{{20,}}\\b') or regexp_matches(whole, '(?i)\\b(?:ghp|github_pat|xox[baprs])-[-A-Za-z0-9_]{{12,}}\\b') or regexp_matches(whole, '\\bAKIA[0-9A-Z]{{16}}\\b')
  or regexp_matches(whole, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') or regexp_matches(whole, '(?i)\\b(?:api[_ -]?key|secret[_ -]?key|access[_ -]?token)\\s*[:=]\\s*[''"]?[A-Za-z0-9_\\-/+=]{{16,}}') then 'secret_like_string' end,
 case when len(regexp_extract_all(whole, '(?i)[A-Z]:\\\\Users\\\\[^\\\\\\s]+\\\\')) + len(regexp_extract_all(whole, '/home/[^/\\s]+/')) + len(regexp_extract_all(whole, '/Users/[^/\\s]+/')) >= 2 then 'private_path_exposure' end,
 case when regexp_matches(category, '(?i)(?:answercarefully|mt[- ]?bench|gsm8k|humaneval|mmlu|private holdout|評価用split)') then 'benchmark_or_eval_signal' end], lambda x: x is not null) as reasons from f)"""


def _filtered(spark, d):
    rec = records.from_documents(table(spark, d, "documents"))
    # staged, or the filter that Spark derives for an explode would compute the reasons a second time
    return X.staged(rec.select("record_id", "category", "user", "assistant_final"), reasons=filters.reasons(metadata=F.col("category"))).select("record_id", "category", "reasons")


@query("flt_hard_filter", f"with {_FILTER} select record_id, len(reasons) = 0 as eligible, array_to_string(reasons, ',') as exclusion_reasons from fr")
def flt(spark, d):
    return _filtered(spark, d).select("record_id", (F.size("reasons") == 0).alias("eligible"), F.array_join("reasons", ",").alias("exclusion_reasons"))


_MORE = (
    _FILTER.replace("list_filter([case when u = ''", "list_filter([case when record_no % 17 = 0 then 'broken_json' end, case when u = ''", 1)
    .replace("case when a = '' then 'empty_assistant' end,", "case when a = '' then 'empty_assistant' end, case when lower(split) in ('eval', 'test', 'validation') then 'eval_split_not_train' end, case when source_role in ('eval_only', 'reference_only', 'future_cpt_candidate') then 'forbidden_source_role' end,", 1)
    .replace("then 'benchmark_or_eval_signal' end]", "then 'benchmark_or_eval_signal' end, case when source_role = 'eval_only' then 'eval_only_source' end]", 1)
    .replace("f as (select *,", "f as (select *, source_row_id::bigint as record_no, case source_row_id::bigint % 5 when 0 then 'test' when 1 then 'Validation' when 2 then 'train' end as split, case source_row_id::bigint % 6 when 0 then 'eval_only' when 1 then 'reference_only' when 2 then 'train_candidate' when 3 then '' end as source_role,", 1)
)


@query("flt_source_filter", f"with {_MORE} select record_id, array_to_string(reasons, ',') as exclusion_reasons from fr")
def flt_source(spark, d):
    """The hard filter with what is known of the row's source: parse errors, split and role."""
    rec = records.from_documents(table(spark, d, "documents"))
    i = F.col("source_row_id").cast("long")
    made = filters.reasons(
        metadata=F.col("category"), error=F.when(i % 17 == 0, "bad"), split=F.when(i % 5 == 0, "test").when(i % 5 == 1, "Validation").when(i % 5 == 2, "train"),
        role=F.when(i % 6 == 0, "eval_only").when(i % 6 == 1, "reference_only").when(i % 6 == 2, "train_candidate").when(i % 6 == 3, ""),
    )
    return rec.select("record_id", F.array_join(made, ",").alias("exclusion_reasons"))


@query("agg3_reason_counts", f"with {_FILTER} select r as reason, count(*) as n from (select unnest(reasons) as r from fr) group by r")
def agg3(spark, d):
    return _filtered(spark, d).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("flt12_html_garbage", "select page_id, length(html) > 40 and contains(lower(html), '<html') and not contains(lower(html), '</html') as garbage from pages")
def flt12(spark, d):
    low = F.lower("html")
    return table(spark, d, "pages").select("page_id", ((F.length("html") > 40) & low.contains("<html") & ~low.contains("</html")).alias("garbage"))


@query("flt25_benchmark_signal", "select conv_id, turn, " + " or ".join(f"contains(lower(text), '{s}')" for s in ("mt-bench", "mt bench", "answercarefully", "answer carefully", "llm-jp-instructions", "japanese mt-bench")) + " as signal from conversations")
def flt25(spark, d):
    from ..operators.contamination import SIGNALS_2, signal

    return table(spark, d, "conversations").select("conv_id", "turn", signal(F.col("text"), SIGNALS_2).alias("signal"))


@query("scl13_record_ids", "select doc_id, sha256(source || ':' || 'part/train.jsonl#' || doc_id::varchar) as record_id from documents")
def scl13(spark, d):
    return table(spark, d, "documents").select("doc_id", records.record_id("source", F.concat(F.lit("part/train.jsonl#"), F.col("doc_id").cast("string"))).alias("record_id"))


@query("scl14_source_family", "select page_id, regexp_extract(url, '^([^#]*)', 1) as source_file, array_to_string(string_split(regexp_replace(regexp_extract(url, '^([^#]*)', 1), '^[a-z]+://', ''), '/')[1:2], '/') as source_family from pages")
def scl14(spark, d):
    file = F.substring_index("url", "#", 1)
    return table(spark, d, "pages").select("page_id", file.alias("source_file"), F.array_join(F.slice(F.split(F.regexp_replace(file, "^[a-z]+://", ""), "/"), 1, 2), "/").alias("source_family"))


@query("scl15_token_split", "select p_partkey, list_filter(list_transform(regexp_split_to_array(p_name || ';' || p_brand || ' ,' || p_type || '||', '[;,|]'), lambda x: trim(x)), lambda x: x <> '') as tokens from part")
def scl15(spark, d):
    joined = F.concat("p_name", F.lit(";"), "p_brand", F.lit(" ,"), "p_type", F.lit("||"))
    return table(spark, d, "part").select("p_partkey", F.filter(F.transform(F.split(joined, "[;,|]"), lambda x: F.trim(x)), lambda x: x != "").alias("tokens"))


@query("scl16_percent", "select o_orderstatus, count(*) as n, round(100.0::double * count(*) / sum(count(*)) over (), 6) as percent from orders group by o_orderstatus")
def scl16(spark, d):
    from pyspark.sql import Window as W

    g = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 6))


@query("scl18_budget", "select c_custkey, c_acctbal > 0 and c_acctbal * 1.5 * 24 <= 100000 as within_budget from customer")
def scl18(spark, d):
    return table(spark, d, "customer").select("c_custkey", ((F.col("c_acctbal") > 0) & (F.col("c_acctbal") * 1.5 * 24 <= 100000)).alias("within_budget"))


@query("scl20_median", "select event_type, quantile_cont(value, 0.5) as median_value from events where isfinite(value) group by event_type")
def scl20(spark, d):
    e = table(spark, d, "events").where(F.col("value").isNotNull() & ~F.isnan("value"))
    return e.groupBy("event_type").agg(F.median("value").alias("median_value"))


@query("scl21_record_fingerprint", """select doc_id, sha256('{"content_hash":"' || sha256(text) || '","source_dataset":"' || source || '","source_row_id":"' || doc_id::varchar || '"}') as fingerprint from documents""")
def scl21(spark, d):
    s = F.struct(F.sha2("text", 256).alias("content_hash"), F.col("source").alias("source_dataset"), F.col("doc_id").cast("string").alias("source_row_id"))
    return table(spark, d, "documents").select("doc_id", F.sha2(F.to_json(s), 256).alias("fingerprint"))
