"""Joins, aggregates, windows, ranking, sampling and audits."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import audits, filters, selection
from . import query, table


def _tokens(spark, d):
    """Token rows of documents: record_id, source, category, bucket, tokens, quality, family."""
    x = table(spark, d, "documents")
    return x.select(
        "doc_id", F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("lang", F.lit("unknown")).alias("lang"), F.greatest(F.lit(1), F.ceil(F.length("text") / 2)).cast("long").alias("tokens"),
        (75 + F.col("doc_id") % 25).cast("double").alias("quality"), (F.col("doc_id") % 8).cast("string").alias("family"), (F.col("doc_id") % 5 != 0).alias("eligible"),
    )


TOK = """tok as (select doc_id, coalesce(source, 'unknown') as source, coalesce(lang, 'unknown') as lang, greatest(1, ceil(length(text) / 2.0))::bigint as tokens, (75 + doc_id % 25)::double as quality, (doc_id % 8)::varchar as family, doc_id % 5 <> 0 as eligible from documents)"""


# joins
@query("jn1_metadata_lookup", "select l_orderkey, l_linenumber, o_orderstatus, o_totalprice from lineitem join orders on l_orderkey = o_orderkey")
def jn1(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return li.select("l_orderkey", "l_linenumber").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice"), "l_orderkey")


@query("jn2_semi_attach", f"with {TOK}, s as (select doc_id, sha256('3407:' || doc_id::varchar) as k, row_number() over (partition by lang order by sha256('3407:' || doc_id::varchar)) as r from tok) select d.doc_id, sha256(d.text) as h, s.r as rank from documents d join s on d.doc_id = s.doc_id where s.r <= 50")
def jn2(spark, d):
    """Late materialization: ids are chosen first, texts are attached to the chosen."""
    ids = _tokens(spark, d).select("doc_id", "lang", selection.sample_key(3407, "doc_id").alias("k"))
    chosen = selection.bottom_k(ids, ["lang"], ["k"], 50).select("doc_id", "rank")
    return table(spark, d, "documents").join(chosen, "doc_id").select("doc_id", F.sha2("text", 256).alias("h"), "rank")


@query("jn3_status_attach", "select d.doc_id, coalesce(case when l.toxic = 1 then 'quarantine' when l.quality = 1 then 'clean' end, 'not_scanned') as status from documents d left join labels l on d.doc_id = l.doc_id")
def jn3(spark, d):
    status = F.when(F.col("toxic") == 1, "quarantine").when(F.col("quality") == 1, "clean")
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", F.coalesce(status, F.lit("not_scanned")).alias("status"))


@query("jn4_zip_join", "select coalesce(o.o_custkey, c.c_custkey) as custkey, o.o_custkey is not null as in_old, c.c_custkey is not null as in_new from (select distinct o_custkey from orders) o full outer join customer c on o.o_custkey = c.c_custkey")
def jn4(spark, d):
    return audits.zip_sides(table(spark, d, "orders").select(F.col("o_custkey").alias("custkey")).distinct(), table(spark, d, "customer").select(F.col("c_custkey").alias("custkey")), "custkey")


@query("jn5_anti_eval", "select doc_id from documents where doc_id not in (select doc_id from labels where toxic = 1)")
def jn5(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").where("toxic = 1"), "doc_id", "left_anti")


@query("jn10_hash_groups", "select doc_id, min(doc_id) over (partition by sha256(text)) as duplicate_of from documents")
def jn10(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = x.groupBy("h").agg(F.min("doc_id").alias("duplicate_of"))
    return x.join(first, "h").select("doc_id", "duplicate_of")


@query("jn11_registry_check", "select s_suppkey, case when n_nationkey is null then 'unknown_dataset' when n_regionkey = 0 then 'forbidden_role' when s_acctbal < 0 then 'blocked_status' else 'ok' end as issue from supplier left join nation on s_nationkey = n_nationkey")
def jn11(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    issue = F.when(F.col("n_regionkey").isNull(), "unknown_dataset").when(F.col("n_regionkey") == 0, "forbidden_role").when(F.col("s_acctbal") < 0, "blocked_status").otherwise("ok")
    return table(spark, d, "supplier").join(n, "s_nationkey", "left").select("s_suppkey", issue.alias("issue"))


@query("jn12_expected_minus_forbidden", "select n_nationkey from nation except select s_nationkey from supplier where s_acctbal < 0")
def jn12(spark, d):
    bad = table(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey"))
    return table(spark, d, "nation").select("n_nationkey").distinct().join(bad, "n_nationkey", "left_anti")


@query("jn13_stage_summary", f"""with {TOK}, a as (select source, count(*) as rows_scanned, count(*) filter (where eligible) as valid_rows from tok where lang <> 'fr' group by source),
s as (select source, count(*) as status_rows, count(*) filter (where doc_id % 9 = 0) as flagged_rows from tok where eligible and doc_id % 2 = 0 group by source)
select t.source, coalesce(rows_scanned, 0) as rows_scanned, coalesce(valid_rows, 0) as valid_rows, coalesce(status_rows, 0) as status_rows, coalesce(flagged_rows, 0) as flagged_rows from (select distinct source from tok) t left join a on t.source = a.source left join s on t.source = s.source""")
def jn13(spark, d):
    t = _tokens(spark, d)
    audit = t.where("lang <> 'fr'").groupBy("source").agg(F.count(F.lit(1)).alias("rows_scanned"), F.count_if("eligible").alias("valid_rows"))
    statuses = t.where("eligible and doc_id % 2 = 0").select("source", F.when(F.col("doc_id") % 9 == 0, "quarantine").otherwise("clear").alias("status"))
    return audits.stage_summary(t, audit, statuses)


# aggregates
@query("agg1_audit_summary", f"""with {TOK} select source, count(*) as rows_scanned, count(*) filter (where eligible) as valid_rows, count(*) filter (where not eligible) as rejected_rows, sum(case when eligible then tokens else 0 end)::bigint as eligible_token_count,
 count(*) filter (where doc_id % 6 = 1) as excluded_eval_rows, count(*) filter (where tokens > 300) as reasoning_ready_rows, count(*) filter (where tokens > 900 and lang = 'en') as tool_ready_rows from tok group by source""")
def agg1(spark, d):
    t = _tokens(spark, d).withColumns({"split": F.when(F.col("doc_id") % 6 == 1, "test").otherwise("train"), "reasoning_ready": F.col("tokens") > 300, "tool_ready": (F.col("tokens") > 900) & (F.col("lang") == "en")})
    return audits.audit_summary(t)


@query("agg2_value_counts", "select 'lang' as field, coalesce(lang, 'unknown') as value, count(*) as n from documents group by 2 union all select 'source', coalesce(source, 'unknown'), count(*) from documents group by 2")
def agg2(spark, d):
    return audits.value_counts(table(spark, d, "documents"), ["lang", "source"])


@query("agg4_quantiles", "select lang, round(avg(length(text)), 6) as mean, quantile_cont(length(text)::double, 0.5) as median, quantile_cont(length(text)::double, 0.1) as p10, quantile_cont(length(text)::double, 0.9) as p90, quantile_cont(length(text)::double, 0.95) as p95 from documents group by lang")
def agg4(spark, d):
    return audits.profile(table(spark, d, "documents").select("lang", F.length("text").alias("n")), ["lang"], "n")


@query("agg6_token_stats", f"""with {TOK} select source, lang, count(*) as rows, sum(tokens)::bigint as tokens, sum(tokens // 3)::bigint as supervised, max(tokens) as max_tokens, round(avg(tokens), 6) as mean_tokens, """
 + ", ".join(f"quantile_cont(tokens::double, {q}) as p{round(q * 100)}" for q in (0.5, 0.75, 0.9, 0.95, 0.99)) + """,
 count(*) filter (where tokens <= 1024) as le_1024, count(*) filter (where tokens > 1024 and tokens <= 4096) as le_4096, count(*) filter (where tokens > 4096 and tokens <= 8192) as le_8192, count(*) filter (where tokens > 8192 and tokens <= 32768) as le_32768, count(*) filter (where tokens > 32768) as gt_32768 from tok group by source, lang""")
def agg6(spark, d):
    t = _tokens(spark, d).withColumn("supervised", F.floor(F.col("tokens") / 3).cast("long"))
    return audits.token_stats(t, ["source", "lang"], "tokens", also=("supervised",))


@query("agg7_threshold_sweep", f"""with {TOK}, th as (select unnest([95, 90, 85, 80, 75]) as threshold),
s as (select threshold, source, sum(tokens) as every, sum(case when eligible and quality >= threshold then tokens else 0 end) as sel, count(*) filter (where eligible and quality >= threshold) as k from tok, th group by 1, 2),
a as (select threshold, sum(k)::bigint as rows, sum(sel)::bigint as mass, sum(case when sel / every::double < 0.1 then 1 else 0 end)::bigint as missing_minimum from s group by 1),
f as (select threshold, family, sum(case when eligible and quality >= threshold then tokens else 0 end)::double as m, sum(case when eligible then tokens else 0 end)::double as em from tok, th group by 1, 2),
g as (select threshold, m / nullif(sum(m) over (partition by threshold), 0) as p, em / nullif(sum(em) over (partition by threshold), 0) as q from f),
h as (select threshold, coalesce(-sum(case when p > 0 then p * ln(p) end), 0) as ent, coalesce(-sum(case when q > 0 then q * ln(q) end), 0) as eent from g group by 1)
select a.threshold::integer as threshold, rows, mass, missing_minimum, round(ent, 6) as entropy, round(ent / eent, 6) as diversity_ratio, missing_minimum = 0 and ent / eent >= 0.70 as passes from a join h on a.threshold = h.threshold""")
def agg7(spark, d):
    return selection.threshold_sweep(_tokens(spark, d), default_minimum=0.1)


@query("agg9_recommended_threshold", f"""with {TOK}, th as (select unnest([95, 90, 85, 80, 75]) as threshold), f as (select threshold, family, sum(case when eligible and quality >= threshold then tokens else 0 end)::double as m, sum(case when eligible then tokens else 0 end)::double as em from tok, th group by 1, 2),
g as (select threshold, m / nullif(sum(m) over (partition by threshold), 0) as p, em / sum(em) over (partition by threshold) as q from f), h as (select threshold, -sum(case when p > 0 then p * ln(p) end) / -sum(case when q > 0 then q * ln(q) end) as r from g group by 1) select max(threshold)::integer as recommended from h where r >= 0.70""")
def agg9(spark, d):
    return selection.threshold_sweep(_tokens(spark, d)).agg(F.max(F.when(F.col("passes"), F.col("threshold"))).alias("recommended"))


@query("agg8_entropy", f"with {TOK}, m as (select source, family, sum(tokens)::double as m from tok group by 1, 2), p as (select source, m / sum(m) over (partition by source) as p from m) select source, round(-sum(p * ln(p)), 9) as entropy from p group by source")
def agg8(spark, d):
    return audits.entropy(_tokens(spark, d), ["source"], "family", "tokens")


@query("agg10_split_buckets", f"with {TOK}, h as (select lang, source, sum(tokens) as mass, count(*) as n, avg(quality) as q from tok group by 1, 2) select t.lang, count(*) as rows, sum(t.tokens)::bigint as mass, round(avg(t.quality), 6) as mean_quality, (count(*) - count(distinct sha256(d.text)))::bigint as duplicate_rows from tok t join documents d on t.doc_id = d.doc_id group by t.lang")
def agg10(spark, d):
    x = _tokens(spark, d).join(table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h")), "doc_id")
    by = x.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("mass"), F.sum("quality").alias("q"))
    return by.groupBy("lang").agg(F.sum("n").alias("rows"), F.sum("mass").alias("mass"), F.round(F.sum("q") / F.sum("n"), 6).alias("mean_quality"), F.sum(F.col("n") - 1).alias("duplicate_rows"))


@query("agg13_candidate_manifest", f"with {TOK} select source, sum(tokens)::bigint as mass, round(100.0::double * sum(tokens) / sum(sum(tokens)) over (), 6) as percent from tok where eligible group by source")
def agg13(spark, d):
    return audits.shares(_tokens(spark, d).where("eligible"), ["source"], "tokens")


@query("agg14_mass_plan", "with s as (select l_returnflag, l_linestatus, sum(l_quantity)::double as tokens from lineitem group by 1, 2) select l_returnflag as bucket, l_linestatus as dataset_id, tokens as available_tokens, round(1000000.0::double * tokens / sum(tokens) over (partition by l_returnflag), 8) as target_mass from s where tokens > 0")
def agg14(spark, d):
    """Sources are (flag, status) pairs, one a bucket of its flag."""
    s = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("bucket"), "l_linestatus").agg(F.sum("l_quantity").cast("double").alias("tokens"))
    s = s.withColumn("dataset_id", F.concat_ws("/", "bucket", "l_linestatus"))
    plan = selection.mass_plan(s.select("bucket", "dataset_id", F.lit(1_000_000.0).alias("mass")), s.select("dataset_id", "tokens"))
    return plan.withColumn("dataset_id", F.substring_index("dataset_id", "/", -1))


_HITS = """
h as (select coalesce(source, '') as source, coalesce(source, '') || '/part-' || (doc_id % 3)::varchar || '/' || (doc_id % 2)::varchar || '.jsonl' as file, coalesce(source, '') || '/part-' || (doc_id % 3)::varchar as family, (doc_id % 4)::varchar as eval, substr(sha256(coalesce(text, '')), 1, 2) as cluster from documents)"""


@query("agg15_decomposition", f"with {_HITS} " + " union all ".join(f"select '{axis}' as axis, {key} as key, count(*) as n from h{group}" for axis, key, group in (
    *((c, c, f" group by {c}") for c in ("source", "family", "file", "eval", "cluster")), ("source_x_eval", "source || '|' || eval", " group by source, eval"), ("total", "''", ""))))
def agg15(spark, d):
    i, source = F.col("doc_id"), F.coalesce("source", F.lit(""))
    row_id = F.concat(source, F.lit("/part-"), (i % 3).cast("string"), F.lit("/"), (i % 2).cast("string"), F.lit(".jsonl#"), i.cast("string"))
    hits = table(spark, d, "documents").select(source.alias("source"), row_id.alias("source_row_id"), (i % 4).cast("string").alias("eval"), F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 2).alias("cluster"))
    return audits.hit_decomposition(hits)


@query("agg16_waterfall", "with s as (select l_orderkey, case when count(distinct l_linestatus) > 1 then 'P' else min(l_linestatus) end as derived from lineitem group by 1) select o_orderstatus as old_status, coalesce(derived, 'missing') as new_status, count(*) as n from orders left join s on o_orderkey = l_orderkey group by 1, 2")
def agg16(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("a"), F.max("l_linestatus").alias("b"))
    new = li.select("o_orderkey", F.when(F.col("a") != F.col("b"), "P").otherwise(F.col("a")).alias("new_status"))
    old = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("old_status"))
    return audits.waterfall(old, new, "o_orderkey", "old_status", "new_status")


@query("agg18_inventory", "select lang as format, count(*) as rows, sum(length(text))::bigint as chars, array_to_string(list_sort(list(distinct source)), ',') as configs from documents group by lang")
def agg18(spark, d):
    return table(spark, d, "documents").groupBy(F.col("lang").alias("format")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text").cast("long")).alias("chars"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("configs"))


_POOL = "case lang when 'en' then 'frontier_reasoning' when 'de' then 'general_japanese' when 'fr' then 'agent_code_retention' when 'es' then 'japanese_stem_code' else 'other' end"


@query("agg19_pool_mass", f"""with {TOK}, p as (select tokens, {_POOL} as bucket from tok),
s as (select coalesce(sum(case when bucket in ('general_japanese', 'japanese_stem_code') then tokens end), 0)::bigint as japanese_pool_tokens, coalesce(sum(case when bucket in ('frontier_reasoning', 'agent_code_retention') then tokens end), 0)::bigint as frontier_pool_tokens from p)
select *, 50000::bigint as target_each_side, least(japanese_pool_tokens, frontier_pool_tokens) >= 50000 as balanced from s""")
def agg19(spark, d):
    return selection.pool_mass(_tokens(spark, d).withColumn("bucket", F.expr(_POOL)), 100_000)


@query("agg20_fill_status", f"with {TOK}, s as (select source, sum(tokens) as selected, 40000 as target from tok where eligible group by source) select source, round(selected / target::double, 6) as fill, selected < 0.9 * target as severe_underfill, case when selected >= 0.95 * target then 'PASS' else 'PARTIAL' end as status from s")
def agg20(spark, d):
    s = _tokens(spark, d).where("eligible").groupBy("source").agg(F.sum("tokens").alias("selected"))
    return audits.fill_status(s, "selected", 40000).select("source", "fill", "severe_underfill", "status")


@query("agg24_reconciliation", f"""with {TOK}, c as (select count(*) as raw_rows, (select count(distinct coalesce(text, '')) from documents) as canonical_rows, (select count(distinct coalesce(text, '')) from documents where length(text) > 20) as formatted_rows, (select coalesce(sum(tokens), 0)::bigint from tok where eligible) as selected_tokens from documents),
f as (select *, raw_rows - canonical_rows as grouped_away, round(selected_tokens / 1000000.0::double, 6) as fill from c)
select *, array_to_string(list_filter([case when canonical_rows > raw_rows then 'more_canonical_than_raw_rows' end, case when formatted_rows < canonical_rows then 'rows_not_formatted' end, case when fill < 0.95 then 'underfilled' end], lambda x: x is not null), ',') as blockers from f""")
def agg24(spark, d):
    """Documents are the raw rows, distinct texts the canonical ones, and texts of over 20 characters the formatted ones."""
    docs = table(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("text"))
    texts = docs.distinct()
    return audits.reconciliation(docs, texts, texts.where(F.length("text") > 20), _tokens(spark, d).where("eligible"), 1_000_000)


@query("agg25_length_profile", "select quantile_cont(n, 0.5) as median_chars, quantile_cont(n, 0.95) as p95_chars from (select length(text)::double as n from documents order by doc_id limit 10000)")
def agg25(spark, d):
    """The profile is defined over the first 10,000 rows of a file."""
    first = table(spark, d, "documents").select("doc_id", F.length("text").alias("n")).orderBy("doc_id").limit(10_000)
    return first.agg(F.percentile("n", F.lit(0.5)).alias("median_chars"), F.percentile("n", F.lit(0.95)).alias("p95_chars"))


# windows and ranking
@query("win3_token_prefix", f"with {TOK}, k as (select *, coalesce(sum(tokens) over (partition by lang order by sha256('3407:' || doc_id::varchar) rows between unbounded preceding and 1 preceding), 0) as before from tok) select doc_id, lang, before::bigint as mass_before from k where before < 20000")
def win3(spark, d):
    t = _tokens(spark, d).withColumn("k", selection.sample_key(3407, "doc_id"))
    return selection.token_prefix(t, "k", "tokens", 20000, ["lang"]).select("doc_id", "lang", "mass_before")


@query("win4_round_robin", f"with {TOK}, t as (select *, row_number() over (partition by lang, source order by sha256('3407:' || doc_id::varchar)) as turn from tok) select doc_id, turn, row_number() over (partition by lang order by turn, source) as position from t")
def win4(spark, d):
    t = _tokens(spark, d).withColumn("k", selection.sample_key(3407, "doc_id"))
    return selection.round_robin(t, "lang", "source", ["k"]).select("doc_id", "turn", "position")


@query("win5_row_position", "select event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as row_index from events")
def win5(spark, d):
    return table(spark, d, "events").select("event_id", (F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1).alias("row_index"))


@query("win7_share", "select o_orderkey, round(o_totalprice / sum(o_totalprice) over (partition by o_orderstatus), 12) as share from orders")
def win7(spark, d):
    o = table(spark, d, "orders")
    total = o.groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("t"))
    return o.join(total, "o_orderstatus").select("o_orderkey", F.round(F.col("o_totalprice") / F.col("t"), 12).alias("share"))


@query("top1_bucket_heap", f"with {TOK}, b as (select doc_id, unnest([lang, source]) as bucket from tok), r as (select *, row_number() over (partition by bucket order by sha256('7:' || doc_id::varchar)) as rank from b) select doc_id, bucket, rank from r where rank <= 20")
def top1(spark, d):
    """A row may stand in several buckets; each keeps its 20 least priorities."""
    b = _tokens(spark, d).select("doc_id", F.explode(F.array("lang", "source")).alias("bucket")).withColumn("k", selection.sample_key(7, "doc_id"))
    return selection.bottom_k(b, ["bucket"], ["k"], 20).select("doc_id", "bucket", "rank")


@query("top2_bucket_pool", f"with {TOK}, r as (select doc_id, lang, row_number() over (partition by lang order by sha256('3407:' || doc_id::varchar)) as rank from tok) select doc_id, lang, rank from r where rank <= 8000")
def top2(spark, d):
    t = _tokens(spark, d).select("doc_id", "lang", selection.sample_key(3407, "doc_id").alias("k"))
    return selection.bottom_k(t, ["lang"], ["k"], 8000).select("doc_id", "lang", "rank")


@query("top3_stratum_reservoir", "with r as (select o_orderkey, o_orderstatus, o_orderpriority, row_number() over (partition by o_orderstatus, o_orderpriority order by sha256('11:' || o_orderkey::varchar)) as rank from orders) select * from r where rank <= 10")
def top3(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", selection.sample_key(11, "o_orderkey").alias("k"))
    return selection.bottom_k(o, ["o_orderstatus", "o_orderpriority"], ["k"], 10).drop("k")


@query("top4_hash_sample", "select doc_id from documents order by sha256('3407:' || doc_id::varchar) limit (select greatest(100, least(count(*), 500)) from documents)")
def top4(spark, d):
    x = table(spark, d, "documents").select("doc_id")
    n = max(100, min(x.count(), 500))
    return x.orderBy(selection.sample_key(3407, "doc_id")).limit(n)


@query("top7_report_order", "select source, n, row_number() over (order by n desc, source) as place from (select source, count(*) as n from documents group by source)")
def top7(spark, d):
    g = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), "source")))


# sampling
@query("smp1_deterministic_key", "select doc_id, sha256('3407:' || doc_id::varchar || ':' || sha256(text) || ':None') as k from documents")
def smp1(spark, d):
    return table(spark, d, "documents").select("doc_id", selection.sample_key(3407, "doc_id", F.sha2("text", 256), F.lit(None).cast("string")).alias("k"))


@query("smp3_stratified")
def smp3(spark, d):
    t = _tokens(spark, d).select(F.col("doc_id").cast("string").alias("record_id"), F.concat_ws("|", "lang", "family").alias("stratum"), "family", "tokens", "lang")
    bucket = F.element_at(F.create_map(*[F.lit(x) for kv in zip(("en", "de", "fr", "es"), selection.TARGETS, strict=False) for x in kv]), F.col("lang"))
    return selection.stratified_by_mass(t.withColumn("bucket", bucket).drop("lang"), 200_000)


_ALLOC = """st as (select o_orderstatus || '|' || o_orderpriority as stratum, count(*) as n from orders group by 1),
x as (select *, count(*) over () as k, sum(n) over () as total, row_number() over (order by n desc, stratum) as by_size from st),
y as (select *, greatest(0, least({n}, total) - k) as lft, (n - 1) * greatest(0, least({n}, total) - k) / greatest(1, total - k)::double as quota from x),
z as (select *, floor(quota) as fl, lft - sum(floor(quota)) over () as rest from y),
al as (select stratum, n, case when k > {n} then case when by_size <= {n} then 1 else 0 end else 1 + fl + case when row_number() over (order by round_even(quota - fl, 9) desc, n desc, stratum) <= rest then 1 else 0 end end::bigint as allocated from z)"""


def _strata(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.concat_ws("|", "o_orderstatus", "o_orderpriority").alias("stratum"))


@query("smp4_allocation", f"with {_ALLOC.format(n=500)} select stratum, n, allocated from al")
def smp4(spark, d):
    return selection.allocate(_strata(spark, d).groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "stratum", "n", 500)


@query("smp5_evidence_sample", f"with {_ALLOC.format(n=500)}, r as (select o_orderkey, o_orderstatus || '|' || o_orderpriority as stratum, row_number() over (partition by o_orderstatus || '|' || o_orderpriority order by sha256('11:' || o_orderkey::varchar)) as rank from orders) select o_orderkey, r.stratum, rank from r join al on r.stratum = al.stratum where rank <= allocated")
def smp5(spark, d):
    s = _strata(spark, d).withColumn("k", selection.sample_key(11, "o_orderkey"))
    plan = selection.allocate(s.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "stratum", "n", 500)
    return selection.bottom_k(s, ["stratum"], ["k"], 500).join(plan.select("stratum", "allocated"), "stratum").where("rank <= allocated").select("o_orderkey", "stratum", "rank")


@query("smp6_bucket", "select p_partkey, case when contains(lower(p_type), 'eco') then 'japanese_math_reasoning' when contains(lower(p_type), 'promo') then 'japanese_stem_code' when contains(lower(p_type), 'standard') then 'frontier_reasoning' when contains(lower(p_type), 'small') then 'agent_code_retention' else 'general_japanese' end as bucket from part")
def smp6(spark, d):
    low = F.lower("p_type")
    category = F.when(low.contains("eco"), "Math_Reason").when(low.contains("promo"), "stem-x").when(low.contains("standard"), "frontier code").when(low.contains("small"), "coding_agent").otherwise("chat")
    return table(spark, d, "part").select("p_partkey", selection.bucket(category).alias("bucket"))


@query("smp7_split_class", "select page_id, case when regexp_matches(url, '/de/') then 'ja_code' when regexp_matches(url, '/es/') then 'ja_math' else 'non_ja' end as split_bucket, regexp_matches(url, '/(de|es)/') as known from pages")
def smp7(spark, d):
    path = F.regexp_replace(F.regexp_replace("url", "/de/", "/x_code_ja_y/"), "/es/", "/math_ja.jsonl/")
    bucket, known = audits.split_class(path)
    return table(spark, d, "pages").select("page_id", bucket.alias("split_bucket"), known.alias("known"))


@query("flt23_split_conflict", "select page_id, regexp_matches(url, '/de/') and regexp_matches(url, 'ref=x') as conflict from pages")
def flt23(spark, d):
    path = F.regexp_replace(F.regexp_replace("url", "/de/", "/code_ja/"), "ref=x", "/math_ko/")
    return table(spark, d, "pages").select("page_id", audits.split_conflict(path).alias("conflict"))


@query("smp8_length_bins", f"with {TOK} select d.doc_id, case when tokens <= 4096 then 'short' when tokens <= 8192 then 'medium' when tokens <= 32768 then 'long' else 'extra_long' end as length_bucket, case when length(text) <= 256 then 'le_256' when length(text) <= 1024 then 'le_1024' when length(text) <= 4096 then 'le_4096' when length(text) <= 16384 then 'le_16384' else 'gt_16384' end as char_bin from documents d join tok on d.doc_id = tok.doc_id")
def smp8(spark, d):
    x = table(spark, d, "documents")
    tokens = F.greatest(F.lit(1), F.ceil(F.length("text") / 2))
    return x.select("doc_id", selection.length_bucket(tokens).alias("length_bucket"), selection.char_bin(F.length("text")).alias("char_bin"))


@query("flt20_pool_filter", f"with {TOK} select doc_id from tok where eligible and quality >= 85 and doc_id not in (select doc_id from labels where toxic = 1)")
def flt20(spark, d):
    return _tokens(spark, d).where("eligible and quality >= 85").select("doc_id").join(table(spark, d, "labels").where("toxic = 1"), "doc_id", "left_anti")


@query("flt24_oversize", "select page_id, length(html) > 3000 as oversize, case when length(html) > 3000 then 0.0 end::double as quality_score, case when length(html) > 3000 then '>16384' end as length_bin, case when length(html) > 3000 then 'unavailable_oversized_record' end as assistant_mask_status from pages")
def flt24(spark, d):
    made = filters.oversize(F.length("html"), 3000)
    return table(spark, d, "pages").select("page_id", *[made[c].alias(c) for c in ("oversize", "quality_score", "length_bin", "assistant_mask_status")])


@query("flt27_license", "select s_suppkey, s_nationkey % 3 = 0 as flagged from supplier")
def flt27(spark, d):
    from ..sources.inference import license_flags

    lic = F.when(F.col("s_nationkey") % 3 == 0, F.array(F.lit("mixed-license"))).otherwise(F.array(F.lit("mit")))
    mixed, unknown = license_flags(lic)
    return table(spark, d, "supplier").select("s_suppkey", (mixed | unknown).alias("flagged"))


@query("flt28_required_eval_missing", "select coalesce(bool_or(item_id % 4 = 3 and length(text) < 50), false) as missing from benchmark")
def flt28(spark, d):
    from ..operators import governance

    entries = table(spark, d, "benchmark").select((F.col("item_id") % 4 == 3).alias("required"), F.when(F.length("text") >= 50, "available").otherwise("gated").alias("availability"))
    return governance.required_eval_missing(entries)


# sets
@query("set2_last_wins", "select user_id, arg_max(event_id, event_id) as event_id, arg_max(event_type, event_id) as event_type from events group by user_id")
def set2(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(F.max(F.struct("event_id", "event_type")).alias("m")).select("user_id", "m.event_id", "m.event_type")


@query("set3_ordered_distinct", "with n as (select user_id, event_type, min(event_id) as f from events group by 1, 2) select user_id, array_to_string(list(event_type order by f), ',') as kinds from n group by user_id")
def set3(spark, d):
    first = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("f"))
    return first.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("f", "event_type"))), lambda x: x["event_type"]), ",").alias("kinds"))


@query("set4_difference", "select doc_id from documents except select doc_id from labels")
def set4(spark, d):
    return table(spark, d, "documents").select("doc_id").exceptAll(table(spark, d, "labels").select("doc_id")).distinct()


@query("set6_summary_merge", "select coalesce(n.doc_id, o.doc_id) as doc_id, coalesce(n.quality, o.q) as quality from labels n full outer join (select doc_id, 0 as q from documents) o on n.doc_id = o.doc_id")
def set6(spark, d):
    old = table(spark, d, "documents").select("doc_id", F.lit(0).alias("q"))
    return table(spark, d, "labels").join(old, "doc_id", "full").select("doc_id", F.coalesce("quality", "q").alias("quality"))
