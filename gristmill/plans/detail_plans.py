"""Smaller operators: message extraction, metadata, keys, candidate generation, readiness."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions.text import normalize, strip
from ..operators import contamination as C
from ..operators import records, selection
from . import norm, query, table


@query("prj3_text_extraction", "select p_partkey, case p_partkey % 3 when 0 then p_name when 1 then p_type else p_name || chr(10) || p_type end as extracted from part")
def prj3(spark, d):
    """A string, an object with a text key, or a list of both."""
    n, k = F.col("p_name"), F.col("p_partkey") % 3
    raw = F.when(k == 0, F.to_json(F.struct(n.alias("v")))).when(k == 1, F.to_json(F.struct(F.struct(F.col("p_type").alias("answer")).alias("v")))).otherwise(F.to_json(F.struct(F.array(F.struct(n.alias("text")), F.struct(F.col("p_type").alias("text"))).alias("v"))))
    return table(spark, d, "part").withColumn("raw", raw).select("p_partkey", records.text_of(records.unwrapped("raw", "v"), 2).alias("extracted"))


@query("prj4_roles", "select c_custkey, case c_custkey % 6 when 0 then 'system' when 1 then 'user' when 2 then 'assistant' when 3 then 'tool' when 4 then 'user' else 'alien' end as role from customer")
def prj4(spark, d):
    said = F.element_at(F.array(*map(F.lit, ("Developer", " human", "MODEL", "tool_result", "user", "alien"))), (F.col("c_custkey") % 6 + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", records.role_of(said).alias("role"))


@query("prj6_prompt_answer", "select p_partkey, p_name as prompt, case when p_size > 25 then p_type else p_brand end as answer from part")
def prj6(spark, d):
    raw = F.to_json(F.struct(F.lit("").alias("input"), F.col("p_name").alias("question"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("output"), F.col("p_brand").alias("solution")))
    p = table(spark, d, "part").withColumn("raw", raw)
    return p.select("p_partkey", records.first_text("raw", records.USER_KEYS).alias("prompt"), records.first_text("raw", records.ANSWER_KEYS).alias("answer"))


@query("prj7_event_messages", "select user_id, count(*) filter (where event_type in ('click', 'error')) as n_messages, sha256(array_to_string(list(case event_type when 'click' then 'user:' || event_id::varchar else 'assistant:' || event_id::varchar end order by event_id) filter (where event_type in ('click', 'error')), ',')) as sequence_hash from events group by user_id")
def prj7(spark, d):
    e = table(spark, d, "events")
    nested = F.struct(F.lit("human").alias("role"), F.col("event_id").cast("string").alias("content"))
    typed = F.when(F.col("event_type") == "error", "assistant").otherwise("noise")
    one = F.struct("event_id", F.when(F.col("event_type") == "click", nested).alias("message"), typed.alias("type"), F.col("event_id").cast("string").alias("text"))
    files = e.groupBy("user_id").agg(F.to_json(F.struct(F.sort_array(F.collect_list(one)).alias("_event_stream"))).alias("raw"))
    m = files.withColumn("m", records.event_messages("raw"))
    return m.select("user_id", F.size("m").cast("long").alias("n_messages"), F.sha2(F.array_join(F.transform("m", lambda x: F.concat_ws(":", x["role"], x["content"])), ","), 256).alias("sequence_hash"))


@query("prj11_metadata_json", """select s_suppkey, '{"s_name":"' || s_name || '","s_nationkey":' || s_nationkey::varchar || ',"s_suppkey":' || s_suppkey::varchar || '}' as metadata from supplier""")
def prj11(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", records.metadata_json(s, ["s_suppkey", "s_nationkey", "s_name"]).alias("metadata"))


@query("prj19_enriched_tokens", "select doc_id, case when lang = 'de' then 'japanese_stem_code' when lang = 'fr' then 'japanese_math_reasoning' else 'general_japanese' end as bucket, case when length(text) <= 256 then 'le_256' when length(text) <= 1024 then 'le_1024' when length(text) <= 4096 then 'le_4096' when length(text) <= 16384 then 'le_16384' else 'gt_16384' end as char_bin, coalesce(quality, -1) as policy_quality from documents left join labels using (doc_id)")
def prj19(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.length("text").alias("n"))
    category = F.when(F.col("lang") == "de", "code").when(F.col("lang") == "fr", "math").otherwise("chat")
    j = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.select("doc_id", selection.bucket(category).alias("bucket"), selection.char_bin("n").alias("char_bin"), F.coalesce("quality", F.lit(-1)).alias("policy_quality"))


@query("flt21_readiness", "select doc_id from documents where not (coalesce(source, '') = 'src1' and doc_id % 3 <> 0) and not (coalesce(source, '') = 'src2' and (doc_id % 5 = 0 or length(text) > 1000))")
def flt21(spark, d):
    """One source must be ready for reasoning; another must have passed its integrity stage and be short."""
    i = F.col("doc_id")
    rules = {"src1": i % 3 == 0, "src2": (i % 5 != 0) & (F.coalesce(F.length("text"), F.lit(0)) <= 1000)}
    return table(spark, d, "documents").where(selection.ready(F.coalesce("source", F.lit("")), rules)).select("doc_id")


_SHARED = f"""with e as (select item_id as id, {norm('text')} as t from benchmark), c as (select doc_id as id, {norm('text')} as t from documents),
eg as (select id, unnest(list_distinct(list_transform(range(1, greatest(length(t) - 22, 1)), lambda i: substr(t, i, 24)))) as g from e), cg as (select id, unnest(list_distinct(list_transform(range(1, greatest(length(t) - 22, 1)), lambda i: substr(t, i, 24)))) as g from c),
sh as (select c.id as doc_id, e.id as item_id, count(*) as shared from cg c join eg e on c.g = e.g group by 1, 2)"""


def _shared(spark, d):
    """Pairs of documents and eval texts by the distinct 24-grams they share."""
    cand = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    evals = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), normalize("text").alias("norm"))
    return C.shared_counts(cand, evals, 24).select(F.col("id").alias("doc_id"), F.col("eval_id").alias("item_id"), "shared")


@query("top5_near_topk", _SHARED + ", r as (select doc_id, item_id, round(shared / 1000.0::double, 6) as similarity, row_number() over (partition by doc_id order by shared desc, item_id) as rank from sh) select * from r where rank <= 16")
def top5(spark, d):
    return C.top_matches(_shared(spark, d).select("doc_id", "item_id", F.round(F.col("shared") / 1000, 6).alias("similarity")), 16, "doc_id", "item_id")


@query("smp2_stable_score", "select doc_id, sha256('3407:' || coalesce(case when doc_id % 3 = 0 then 'r' || doc_id::varchar end, nullif(case when doc_id % 3 = 1 then 's' || doc_id::varchar else '' end, ''), sha256(coalesce(text, '')))) as score from documents")
def smp2(spark, d):
    i = F.col("doc_id")
    made = lambda k, p: F.when(i % 3 == k, F.concat(F.lit(p), i.cast("string")))
    return table(spark, d, "documents").select("doc_id", selection.stable_score(3407, made(0, "r"), F.coalesce(made(1, "s"), F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("score"))


@query("ded5_simhash", f"""with t as (select item_id, {norm('text')} as text, length({norm('text')}) - 2 as k from benchmark),
g as (select item_id, unnest(list_distinct(case when k > 0 then list_transform(range(1, k + 1, greatest(1, ceil(k / 256.0))::bigint), lambda i: substr(text, i, 3)) when length(text) > 0 then [text] else [] end)) as gram from t),
v as (select item_id, b, 2 * sum(((('0x' || substr(md5(gram), 1, 16))::ubigint >> b) & 1)::bigint) >= count(*) as one from g, (select unnest(range(0, 64)) as b) group by item_id, b),
s as (select item_id, bit_or(case when one then 1::ubigint << b::ubigint else 0::ubigint end) as sig from v group by item_id)
select t.item_id, printf('%016x', coalesce(sig, 0)::ubigint) as simhash from t left join s on t.item_id = s.item_id""")
def ded5_simhash(spark, d):
    """The fingerprint's signature with MD5, which SQL has, in place of seeded BLAKE2b."""
    n = table(spark, d, "benchmark").select("item_id", normalize("text").alias("n"))
    return n.select("item_id", F.lower(F.lpad(F.hex(C.fingerprint_simhash("n", digest="md5")), 16, "0")).alias("simhash"))


@query("ded5_fingerprint_parts", f"select item_id, sha256({norm('text')}) as content_hash, sha256({norm('split_part(text, chr(10), 1)')}) as prompt_hash, length({norm('text')})::bigint as normalized_length from benchmark")
def ded5(spark, d):
    b = table(spark, d, "benchmark")
    n = b.select("item_id", normalize("text").alias("n"), normalize(F.substring_index("text", "\n", 1)).alias("p"))
    return n.select("item_id", F.sha2("n", 256).alias("content_hash"), F.sha2("p", 256).alias("prompt_hash"), F.length("n").cast("long").alias("normalized_length"))


@query("con3_candidates", _SHARED + " select * from sh")
def con3(spark, d):
    """Candidate pairs by shared 24-grams, and how many they share."""
    return _shared(spark, d)


@query("scl17_slug", "select n_nationkey, replace(lower(n_name), ' ', '-') as slug from nation")
def scl17(spark, d):
    return table(spark, d, "nation").select("n_nationkey", F.replace(F.lower("n_name"), F.lit(" "), F.lit("-")).alias("slug"))


@query("scl23_clean_ids", "select event_id, trim(coalesce(case when event_id % 4 = 0 then null else ' ' || user_id::varchar || ' ' end, '')) as cleaned from events")
def scl23(spark, d):
    raw = F.when(F.col("event_id") % 4 != 0, F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
    return table(spark, d, "events").select("event_id", F.coalesce(strip(raw), F.lit("")).alias("cleaned"))


@query("src8_parquet_footer", "select 'documents' as name, count(*) as rows from documents union all select 'pages', count(*) from pages union all select 'events', count(*) from events")
def src8(spark, d):
    from functools import reduce

    one = lambda n: table(spark, d, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
    return reduce(lambda a, b: a.unionByName(b), map(one, ("documents", "pages", "events")))


@query("src10_logical_files", "select page_id from (select page_id, url, bool_or(contains(url, '/de/')) over (partition by split_part(url, '/', 3)) as has from pages) where contains(url, '/de/') or not has")
def src10(spark, d):
    """The preferred view of each host if it has one, else all its files."""
    p = table(spark, d, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.col("url").contains("/de/").alias("wanted"))
    any_ = F.max(F.col("wanted").cast("int")).over(W.partitionBy("host"))
    return p.withColumn("any", any_).where(F.col("wanted") | (F.col("any") == 0)).select("page_id")


@query("set1_union_all", "select role as kind, text from conversations union all select 'benchmark', text from benchmark")
def set1(spark, d):
    return table(spark, d, "conversations").select(F.col("role").alias("kind"), "text").unionByName(table(spark, d, "benchmark").select(F.lit("benchmark").alias("kind"), "text"))
