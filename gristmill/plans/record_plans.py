"""Sources, canonical records and conversation validators."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import given
from ..operators import records, validate
from ..sources import inference
from . import query, table

_CONV = """
cv as (select conv_id, list({'turn': turn, 'role': role, 'content': coalesce(text, '')} order by turn, role, text) as m from conversations group by conv_id)"""
_SAID = "array_to_string(list_transform(list_filter(m, lambda x: x.role = '{0}'), lambda x: x.content), chr(10))"
_LAST = "coalesce(list_filter(m, lambda x: x.role = 'assistant')[-1].content, '')"


def _conv(spark, d):
    return records.from_turns(table(spark, d, "conversations"))


@query("prj9_conversation_record", f"with {_CONV} select conv_id, {_SAID.format('system')} as system, {_SAID.format('user')} as \"user\", {_LAST} as assistant_final, len(m) as n_messages from cv")
def prj9(spark, d):
    return _conv(spark, d).select("conv_id", "system", "user", "assistant_final", F.size("messages").alias("n_messages"))


@query("prj21_content_prompt", f"""with {_CONV} select conv_id, sha256(array_to_string(list_transform(m, lambda x: x.content), chr(10))) as content_hash,
 sha256(array_to_string(list_transform(list_filter(m, lambda x: x.role in ('system', 'user')), lambda x: x.content), chr(10))) as prompt_hash from cv""")
def prj21(spark, d):
    return _conv(spark, d).select("conv_id", F.sha2(records.content_text("messages"), 256).alias("content_hash"), F.sha2(records.prompt_text("messages"), 256).alias("prompt_hash"))


@query("ded14_template_family", f"with {_CONV} select conv_id, substr(sha256(array_to_string(list_transform(m, lambda x: x.role), ',')), 1, 16) as template_family_hash from cv")
def ded14(spark, d):
    return _conv(spark, d).select("conv_id", records.template_family("messages").alias("template_family_hash"))


@query("ded2_hashes", f"""with {_CONV}, n as (select conv_id, list_transform(m, lambda x: {{'role': x.role, 'c': trim(regexp_replace(x.content, '\\s+', ' ', 'g'))}}) as m from cv)
select conv_id, sha256(array_to_string(list_transform(m, lambda x: '<' || x.role || '>:' || x.c), chr(10))) as role_text_hash,
 sha256('[' || array_to_string(list_transform(m, lambda x: '{{"content":' || to_json(x.c)::varchar || ',"role":"' || x.role || '"}}'), ',') || ']') as record_hash from n""")
def ded2(spark, d):
    return _conv(spark, d).select("conv_id", F.sha2(records.role_text("messages"), 256).alias("role_text_hash"), records.record_hash("messages").alias("record_hash"))


@query("prj12_canonical", f"""with {_CONV} select sha256('conv:' || conv_id::varchar) as record_id, {_SAID.format('user')} as "user", {_LAST} as assistant_final, len(m) as n_messages, 'teacher-x' as teacher_model, 'high' as provenance from
 (select conv_id, list_filter(list_transform(m, lambda x: {{'role': x.role, 'content': regexp_replace(x.content, '^\\s+|\\s+$', '', 'g')}}), lambda x: x.content <> '') as m from cv)""")
def prj12(spark, d):
    """Raw rows as JSON text with a nested row_json, canonicalized."""
    conv = _conv(spark, d)
    inner = F.to_json(F.struct(F.col("messages"), F.struct(F.lit("mit").alias("license")).alias("metadata")))
    raw = conv.select(F.lit("conv").alias("dataset_id"), F.col("conv_id").cast("string").alias("source_row_id"), F.lit("r1").alias("source_revision"), F.to_json(F.struct(inner.alias("row_json"), F.lit("teacher-x").alias("model"))).alias("raw"))
    c = records.canonicalize(raw)
    return c.select("record_id", "user", "assistant_final", F.size("messages").alias("n_messages"), "teacher_model", records.provenance_confidence("source_revision", "license_raw").alias("provenance"))


@query("prj1_unwrap_row_json", "select event_id, event_type as kind, json_extract_string(props, '$.k')::integer as k from events")
def prj1(spark, d):
    raw = F.to_json(F.struct(F.col("props").alias("row_json"), F.col("event_type").alias("kind")))
    e = table(spark, d, "events").select("event_id", raw.alias("raw"))
    get = lambda k, kind: F.try_variant_get(records.unwrapped("raw", k), "$", kind)
    return e.select("event_id", get("kind", "string").alias("kind"), get("k", "int").alias("k"))


@query("prj2_json_value", "select event_id, json_valid(props) and (starts_with(props, '{') or starts_with(props, '[')) as is_object, json_valid(event_type) and false as type_is_object from events")
def prj2(spark, d):
    return table(spark, d, "events").select("event_id", records.parse("props").isNotNull().alias("is_object"), records.parse("event_type").isNotNull().alias("type_is_object"))


@query("prj8_reasoning_split", r"""select doc_id, regexp_replace(split_part(text, chr(10), 1), '^\s+|\s+$', '', 'g') as reasoning, regexp_replace(substr(text, length(split_part(text, chr(10), 1)) + 2), '^\s+|\s+$', '', 'g') as final from documents""")
def prj8(spark, d):
    user = F.substring_index("text", "\n", 1)
    rest = F.substr("text", F.length(user) + 2, F.length("text"))
    tagged = F.concat(F.lit("<think>"), user, F.lit("</think>"), rest)
    reasoning, final = records.reasoning_split(tagged)
    return table(spark, d, "documents").select("doc_id", reasoning.alias("reasoning"), final.alias("final"))


@query("prj10_find_value", "select c_custkey, coalesce(nullif(case when c_nationkey < 10 then c_mktsegment else '' end, ''), c_name) as found from customer")
def prj10(spark, d):
    c = table(spark, d, "customer")
    raw = F.to_json(F.struct(F.when(F.col("c_nationkey") < 10, F.col("c_mktsegment")).otherwise("").alias("model"), F.struct(F.col("c_name").alias("model")).alias("metadata")))
    return c.select("c_custkey", records.found_value(raw, ("teacher", "model")).alias("found"))


@query("prj13_manifest", "select sha256(source || ':' || doc_id::varchar) as record_id, source as source_dataset, lang as category, length(text)::bigint as char_count, sha256(text) as content_hash from documents")
def prj13(spark, d):
    docs = table(spark, d, "documents")
    return docs.select(records.record_id("source", F.col("doc_id").cast("string")).alias("record_id"), F.col("source").alias("source_dataset"), F.col("lang").alias("category"), F.length("text").cast("long").alias("char_count"), F.sha2("text", 256).alias("content_hash"))


@query("prj14_provenance", "select o_orderkey, case when o_orderstatus = 'F' and o_orderpriority <> '1-URGENT' then 'high' when o_orderstatus = 'F' or o_orderstatus = 'O' or o_orderpriority <> '1-URGENT' then 'partial' else 'unknown' end as provenance from orders")
def prj14(spark, d):
    rev = F.when(F.col("o_orderstatus") == "F", "abc").when(F.col("o_orderstatus") == "O", "unknown").otherwise("")
    lic = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("string")).otherwise("mit")
    return table(spark, d, "orders").select("o_orderkey", records.provenance_confidence(rev, lic).alias("provenance"))


@query("prj16_disposition", "select page_id, case when regexp_matches(url, '/de/') then 'excluded_metadata' when not regexp_matches(url, '/(en|fr)/') then 'excluded_derivative' else 'scan' end as disposition from pages")
def prj16(spark, d):
    return table(spark, d, "pages").select("page_id", inference.disposition("url", "/de/", "/(en|fr)/").alias("disposition"))


@query("prj15_schema_registry", "select doc_id, case when source in ('src0', 'src1', 'src2') then 'adapter:' || source else 'excluded_unregistered_schema' end as schema_adapter from documents")
def prj15(spark, d):
    registry = spark.createDataFrame([(s, f"adapter:{s}") for s in ("src0", "src1", "src2")], "source string, adapter string")
    docs = table(spark, d, "documents").select("doc_id", "source")
    return inference.adapt(docs, registry, "source").select("doc_id", "schema_adapter")


@query("prj17_eval_projection", "select item_id, text || chr(10) || length(text)::varchar as content, text as prompt from benchmark")
def prj17(spark, d):
    b = table(spark, d, "benchmark")
    raw = F.to_json(F.struct(F.col("text").alias("text"), F.length("text").cast("string").alias("output")))
    content, prompt = inference.named_fields(raw, ("text", "output"), ("text",))
    return b.select("item_id", content.alias("content"), prompt.alias("prompt"))


@query("prj22_safe_sample", "select doc_id, case when length(text) > 160 then substr(text, 1, 157) || '...' else text end as sample from documents")
def prj22(spark, d):
    return table(spark, d, "documents").select("doc_id", inference.safe_sample("text").alias("sample"))


@query("prj23_char_count", "select conv_id, sum(length(text))::bigint as chars from conversations group by conv_id")
def prj23(spark, d):
    total = F.aggregate("messages", F.lit(0).cast("long"), lambda acc, m: acc + F.length(m["content"]))
    return _conv(spark, d).select("conv_id", total.alias("chars"))


@query("prj24_license_evidence", "select s_suppkey, s_nationkey % 4 = 0 as license_mixed, s_nationkey % 4 = 1 as license_unknown, s_nationkey % 4 > 1 as evidence_complete, null::boolean as approved from supplier")
def prj24(spark, d):
    lic = F.element_at(F.array(F.array(F.lit("mit"), F.lit("gpl")), F.array().cast("array<string>"), F.array(F.lit("mit")), F.array(F.lit("apache-2.0"))), (F.col("s_nationkey") % 4 + 1).cast("int"))
    mixed, unknown = inference.license_flags(lic)
    return table(spark, d, "supplier").select("s_suppkey", mixed.alias("license_mixed"), unknown.alias("license_unknown"), (~mixed & ~unknown).alias("evidence_complete"), F.lit(None).cast("boolean").alias("approved"))


@query("src9_event_groups", """select user_id, count(*) as n_events, sha256(array_to_string(list(event_type order by event_id), ',')) as sequence_hash, max(ts) as last_ts from events group by user_id""")
def src9(spark, d):
    e = table(spark, d, "events")
    seq = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]), ",")
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.sha2(seq, 256).alias("sequence_hash"), F.max("ts").alias("last_ts"))


@query("src12_13_inference", r"""with p as (select page_id, regexp_extract(url, '^[a-z]+://[^/]*/([^?#]*)', 1) as path from pages), q as (select *, lower(regexp_replace(regexp_replace(path, '/$', ''), '^.*/', '')) as stem0 from p),
r as (select *, regexp_replace(stem0, '\.[^.]*$', '') as stem from q)
select page_id, coalesce(nullif(regexp_extract(path, '(?:^|/)((?i)v\d+(?:\.\d+)*)/', 1), ''), 'default') as source_config,
 case when regexp_matches(stem, '(?:^|[-_])eval(?:[-_.]|$)') then 'eval' when regexp_matches(stem, '(?:^|[-_])test(?:[-_.]|$)') then 'test' when regexp_matches(stem, '(?:^|[-_])train(?:[-_.]|$)') then 'train' else stem end as source_split from r""")
def src12(spark, d):
    path = F.regexp_extract("url", "^[a-z]+://[^/]*/([^?#]*)", 1)
    return table(spark, d, "pages").select("page_id", inference.config_of(path).alias("source_config"), inference.split_of(path).alias("source_split"))


@query("src15_revision", """select o_custkey, case when count(distinct o_orderstatus) = 1 then min(o_orderstatus) else 'mixed:' || array_to_string(list_sort(list(distinct o_orderstatus)), ',') end as revision from orders group by o_custkey""")
def src15(spark, d):
    return inference.revisions(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus")


@query("src3_policy_match", "select s_suppkey, n_name from supplier left join nation on s_nationkey = n_nationkey")
def src3(spark, d):
    s = table(spark, d, "supplier")
    dirs = table(spark, d, "nation").select(F.upper("n_name").alias("dir"), "n_name", "n_nationkey")
    named = s.join(table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.lower("n_name").alias("repo_dir")), F.col("s_nationkey") == F.col("k"), "left")
    return inference.match_dirs(named, dirs, "repo_dir", "dir").select("s_suppkey", "n_name")


@query("src17_eval_rows", "select item_id, 'test' as split, text from benchmark")
def src17(spark, d):
    b = table(spark, d, "benchmark")
    packed = b.groupBy((F.col("item_id") % 7).alias("file")).agg(F.to_json(F.struct(F.collect_list(F.struct("item_id", "text")).alias("questions"))).alias("raw"))
    rows = inference.container_rows(packed, "raw", "item_id long, text string")
    return rows.select("item_id", F.lit("test").alias("split"), "text")


@query("src22_eval_prompts", "select item_id, split_part(text, chr(10), 1) as prompt from benchmark where trim(split_part(text, chr(10), 1)) <> '' order by item_id limit 2000")
def src22(spark, d):
    b = table(spark, d, "benchmark")
    raw = F.to_json(F.struct(F.substring_index("text", "\n", 1).alias("question")))
    p = b.select("item_id", inference.prompt_of(raw).alias("prompt"))
    return p.where(F.trim("prompt") != "").orderBy("item_id").limit(2000)


@query("src21_union_sources", "select 'documents' as source, doc_id::varchar as row_id, length(text)::bigint as chars from documents union all select 'benchmark', item_id::varchar, length(text) from benchmark union all select 'conversations', conv_id::varchar || '#' || turn::varchar, length(text) from conversations")
def src21(spark, d):
    part = lambda n, key: table(spark, d, n).select(F.lit(n).alias("source"), key.alias("row_id"), F.length("text").cast("long").alias("chars"))
    return part("documents", F.col("doc_id").cast("string")).unionByName(part("benchmark", F.col("item_id").cast("string"))).unionByName(part("conversations", F.concat_ws("#", F.col("conv_id").cast("string"), F.col("turn").cast("string"))))


_VALID = f"""{_CONV}, v as (select conv_id, m, list_transform(m, lambda x: x.role) as r from cv)"""


@query("val1_trace_errors", f"""with {_VALID} select conv_id, array_to_string(list_sort(list_filter([case when len(list_filter(r, lambda x: x not in ('system', 'user', 'assistant', 'tool'))) > 0 then 'unknown_role' end,
 case when not list_contains(r, 'user') then 'user_missing' end, case when not list_contains(r, 'assistant') then 'assistant_missing' end, case when r[-1] = 'tool' then 'trace_ends_with_tool_result' end,
 case when r[1] = 'tool' or len(list_filter(generate_series(2, len(r)), lambda i: r[i] = 'tool' and r[i - 1] <> 'assistant')) > 0 then 'tool_without_preceding_assistant' end], lambda x: x is not null)), ',') as errors from v""")
def val1(spark, d):
    return _conv(spark, d).select("conv_id", F.array_join(validate.trace_errors("messages"), ",").alias("errors"))


_TRAIN = f"""{_VALID}, a as (select *, list_transform(list_filter(m, lambda x: x.role = 'assistant'), lambda x: x.content) as mine, (select 1) as one, list_sum(list_transform(m, lambda x: greatest(1, len(list_filter(regexp_split_to_array(x.content, '\\s+'), lambda w: w <> ''))))) as tokens from v),
tr as (select conv_id, tokens::bigint as tokens, list_sort(list_filter([case when len(mine) = 0 then 'assistant_role_missing' end, case when not list_contains(r, 'user') then 'user_role_missing' end,
 case when len(list_filter(mine, lambda x: trim(x) <> '')) = 0 then 'final_answer_missing' end, case when trim(coalesce(mine[-1], '')) = '' then 'final_answer_field_missing' end,
 case when tokens > 4096 then 'max_sequence_exceeded_without_safe_segmentation' end], lambda x: x is not null)) as errors from a)"""


def _tokens():
    return F.aggregate("messages", F.lit(0).cast("long"), lambda acc, m: acc + F.greatest(F.lit(1), F.size(F.filter(F.split(m["content"], r"\s+"), lambda w: w != ""))))


def _training(spark, d):
    c = _conv(spark, d).withColumn("tokens", _tokens())
    return c.select("conv_id", "tokens", validate.training_errors("messages", "assistant_final", "system", "tokens").alias("errors"))


@query("val2_training_record", f"with {_TRAIN} select conv_id, tokens, len(errors) = 0 as valid, array_to_string(errors, ',') as errors from tr")
def val2(spark, d):
    return _training(spark, d).select("conv_id", "tokens", (F.size("errors") == 0).alias("valid"), F.array_join("errors", ",").alias("errors"))


@query("agg17_format_summary", f"with {_TRAIN} select coalesce(e, 'valid') as error, count(*) as n from (select unnest(case when len(errors) = 0 then [null] else errors end) as e from tr) group by 1")
def agg17(spark, d):
    e = _training(spark, d).select(F.explode(F.when(F.size("errors") == 0, F.array(F.lit("valid"))).otherwise(F.col("errors"))).alias("error"))
    return e.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("agg17_supervised_ratio", f"""with {_TRAIN}, s as (select a.conv_id, coalesce(list_sum(list_transform(mine, lambda x: greatest(1, len(list_filter(regexp_split_to_array(x, '\\s+'), lambda w: w <> ''))))), 0)::double / a.tokens as ratio, len(errors) as e from a join tr on a.conv_id = tr.conv_id)
select count(*) as records, count(*) filter (where e = 0) as valid, round(avg(ratio), 6) as mean_supervised_ratio from s""")
def agg17_ratio(spark, d):
    """Valid records, and the mean share of assistant tokens."""
    words = lambda c: F.greatest(F.lit(1), F.size(F.filter(F.split(c, r"\s+"), lambda w: w != "")))
    mine = F.aggregate(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(0).cast("long"), lambda acc, m: acc + words(m["content"]))
    c = _conv(spark, d).withColumns({"tokens": _tokens(), "mine": mine})
    e = c.select((F.col("mine") / F.col("tokens")).alias("ratio"), F.size(validate.training_errors("messages", "assistant_final", "system", "tokens")).alias("e"))
    return e.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("e") == 0).alias("valid"), F.round(F.avg("ratio"), 6).alias("mean_supervised_ratio"))


@query("val3_segments")
def val3(spark, d):
    return validate.segments(_conv(spark, d), "conv_id", 256)


@query("agg11_trace_states")
def agg11(spark, d):
    s = validate.segments(_conv(spark, d), "conv_id", 256)
    return s.groupBy("conv_id", "state").agg(F.count(F.lit(1)).alias("segments")).groupBy("state").agg(F.count(F.lit(1)).alias("traces"), F.sum("segments").alias("segments"))


@query("win6_prev_role", "select conv_id, turn, role, lag(role) over (partition by conv_id order by turn) as prev_role from conversations")
def win6(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", "role", F.lag("role").over(W.partitionBy("conv_id").orderBy("turn")).alias("prev_role"))


def _label(x: str) -> str:
    """The language label of an SQL expression, by the same counts as SCL3 without metadata."""
    c = f"regexp_replace({x}, '\\s+', '', 'g')"
    n = lambda p: f"len(regexp_extract_all({c}, '{p}')) / greatest(1, length({c}))::double"
    j, k, e = n("[぀-ゟ゠-ヿㇰ-ㇿ]"), n("[㐀-䶿一-鿿]"), n("[A-Za-z]")
    code = f"least(1.0, len(regexp_extract_all({x}, '(?i)```|</?[A-Za-z][^>]*>|\\b(def|class|import|function|const|SELECT|FROM)\\b|[{{}};]')) / greatest(1.0, greatest(1, length({c}))::double / 80))"
    return f"case when {j} >= 0.08 or ({j} >= 0.03 and {k} >= 0.15) then case when {e} >= 0.15 then 'mixed' else 'japanese' end when {code} >= 0.45 and {e} >= 0.10 then 'code-heavy' when {e} >= 0.35 then 'english' else 'unknown' end"


@query("scl4_record_languages", f"""with {_CONV}, p as (select conv_id, {_SAID.format('user')} as u, {_LAST} as a from cv), w as (select *, concat_ws(chr(10), nullif(u, ''), nullif(a, '')) as w from p)
select conv_id, {_label('u')} as language_user, {_label('a')} as language_assistant, 'unknown' as language_reasoning, {_label('w')} as language_overall,
 round_even(len(regexp_extract_all(w, '[A-Za-z]')) / greatest(1, length(regexp_replace(w, '\\s+', '', 'g')))::double, 6) as english_ratio from w""")
def scl4(spark, d):
    made = records.record_languages()
    return _conv(spark, d).select("conv_id", *[made[c].alias(c) for c in ("language_user", "language_assistant", "language_reasoning", "language_overall", "english_ratio")])