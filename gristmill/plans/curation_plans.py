"""Dedup, similarity and contamination queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions.text import casefold, normalize
from ..operators import contamination as C
from ..operators import dedup, records
from . import norm, query, table

_DOC = "d as (select doc_id, coalesce(source, '') as source, coalesce(text, '') as text, sha256(coalesce(text, '')) as h, length(coalesce(text, '')) as n from documents)"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))


_REC = """
r as (select doc_id as record_id, sha256(coalesce(text, '')) as content_hash, doc_id % 7 <> 0 as eligibility, doc_id as seq, case doc_id % 4 when 0 then 'unknown' when 1 then null else 'rev' end as source_revision,
  case doc_id % 3 when 0 then 'mit' when 1 then 'unknown' end as license_raw, doc_id % 2 = 0 as schema_complete, (75 + doc_id % 5)::double as quality_score, coalesce(source, '') as source_dataset, doc_id::varchar as source_row_id from documents),
e as (select *, first_value(record_id) over w as winner_id, count(*) over (partition by content_hash) as copies from r where eligibility
  window w as (partition by content_hash order by coalesce(source_revision, '') not in ('', 'unknown') desc, coalesce(license_raw, '') not in ('', 'unknown') desc, schema_complete desc, quality_score desc, source_dataset desc, source_row_id desc, seq))"""


def _records(spark, d):
    """Documents as records, with made-up provenance that differs among copies."""
    i = F.col("doc_id")
    return table(spark, d, "documents").select(
        i.alias("record_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"), (i % 7 != 0).alias("eligibility"), i.alias("seq"), F.when(i % 4 == 0, "unknown").when(i % 4 > 1, "rev").alias("source_revision"),
        F.when(i % 3 == 0, "mit").when(i % 3 == 1, "unknown").alias("license_raw"), (i % 2 == 0).alias("schema_complete"), (75 + i % 5).cast("double").alias("quality_score"), F.coalesce("source", F.lit("")).alias("source_dataset"), i.cast("string").alias("source_row_id"),
    )


@query("ded3_exact_dedup", f"with {_REC} select record_id, 'exact:' || content_hash as duplicate_cluster, copies, winner_id, record_id = winner_id as is_winner from e")
def ded3(spark, d):
    return dedup.exact_deduplicate(_records(spark, d)).select("record_id", "duplicate_cluster", "copies", "winner_id", "is_winner")


@query("win1_keep_best", f"with {_REC} select record_id, case when record_id <> winner_id then winner_id end as duplicate_of from e")
def win1(spark, d):
    return dedup.exact_deduplicate(_records(spark, d)).select("record_id", "duplicate_of")


@query("win2_running_winner", """select o_orderkey, (select p.o_orderkey from orders p where p.o_custkey = o.o_custkey and p.o_orderkey < o.o_orderkey order by p.o_totalprice desc, p.o_orderkey limit 1) as duplicate_of from orders o""")
def win2(spark, d):
    o = table(spark, d, "orders")
    return dedup.running_winner(o, "o_custkey", [F.col("o_totalprice")], "o_orderkey", "o_orderkey").select("o_orderkey", "duplicate_of")


_SIM = """
x as (select doc_id, coalesce(text, '') as raw from documents),
t as (select doc_id, text, length(text) - 2 as k from (select doc_id, case when length(raw) > 4096 then substr(raw, 1, 2048) || chr(10) || '<simhash-window>' || chr(10) || substr(raw, length(raw) - 2047) else raw end as text from x)),
g as (select doc_id, unnest(case when k > 0 then list_transform(range(1, k + 1, greatest(1, ceil(k / 256.0))::bigint), lambda i: substr(text, i, 3)) else [text] end) as gram from t),
hh as (select doc_id, ('0x' || substr(md5(gram), 1, 16))::ubigint as h from g),
v as (select doc_id, b, 2 * sum(((h >> b) & 1)::bigint) >= count(*) as one from hh, (select unnest(range(0, 64)) as b) group by doc_id, b),
s as (select doc_id, bit_or(case when one then 1::ubigint << b::ubigint else 0::ubigint end) as sig from v group by doc_id),
sig as (select t.doc_id, coalesce(sig, 0)::ubigint as simhash from t left join s on t.doc_id = s.doc_id)"""


def _sigs(spark, d):
    """The document signature with MD5, which SQL has, in place of BLAKE2b."""
    return dedup.simhash_text(_docs(spark, d).select("doc_id", "text"), "doc_id", F.col("text"), digest="md5")


@query("ded4_simhash", f"with {_SIM} select doc_id, printf('%016x', simhash) as simhash from sig")
def ded4(spark, d):
    return _sigs(spark, d).select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("simhash"))


@query("jn9_simhash_pairs", f"with {_SIM}, u as (select distinct simhash from sig) select printf('%016x', least(a.simhash, b.simhash)) as sig_a, printf('%016x', greatest(a.simhash, b.simhash)) as sig_b, bit_count(xor(a.simhash, b.simhash))::integer as distance from u a join u b on a.simhash < b.simhash and bit_count(xor(a.simhash, b.simhash)) <= 3")
def jn9(spark, d):
    """Pairs of distinct signatures; membership is ded4_simhash."""
    e = dedup.near_edges(_sigs(spark, d), "doc_id")
    a, b = (F.lower(F.lpad(F.hex(c), 16, "0")) for c in ("sig_a", "sig_b"))
    return e.select(F.least(a, b).alias("sig_a"), F.greatest(a, b).alias("sig_b"), "distance")


@query("ded7_near_dedup")
def ded7(spark, d):
    return dedup.greedy_near(_sigs(spark, d), "doc_id")


@query("ded8_bands", "select p_partkey, list_transform([0, 1, 2, 3], lambda i: ((('0x' || substr(md5(p_name), 1, 16))::ubigint >> (16 * i)) & 65535)::bigint) as bands from part")
def ded8(spark, d):
    p = table(spark, d, "part").select("p_partkey", H.md5_64("p_name").alias("h"))
    return p.select("p_partkey", F.transform(H.bands("h"), lambda x: x["value"]).alias("bands"))


@query("ded6_hamming", "select a.item_id, bit_count(xor(('0x' || substr(md5(a.text), 1, 16))::ubigint, ('0x' || substr(md5(b.text), 1, 16))::ubigint))::integer as distance, round(1 - bit_count(xor(('0x' || substr(md5(a.text), 1, 16))::ubigint, ('0x' || substr(md5(b.text), 1, 16))::ubigint)) / 64.0::double, 6) as similarity from benchmark a join benchmark b on a.item_id + 1 = b.item_id")
def ded6(spark, d):
    b = table(spark, d, "benchmark").select("item_id", H.md5_64("text").alias("h"))
    j = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("h").alias("h2")), "item_id")
    return j.select("item_id", H.hamming("h", "h2").alias("distance"), F.round(1 - H.hamming("h", "h2") / 64, 6).alias("similarity"))


@query("ded12_grams", f"with b as (select item_id, {norm('text')} as t from benchmark), g as (select item_id, list_distinct(case when length(t) - 12 > 1 then list_transform(range(1, length(t) - 11, greatest(1, ceil((length(t) - 12) / 64.0))::bigint), lambda i: substr(t, i, 13)) when length(t) > 0 then [t] else [] end) as g from b) select item_id, len(g) as n, sha256(array_to_string(list_sort(g), '|')) as gram_hash from g")
def ded12(spark, d):
    g = H.grams("norm", 13, 64)
    return table(spark, d, "benchmark").select("item_id", normalize("text").alias("norm")).select("item_id", F.size(g).alias("n"), F.sha2(F.array_join(F.array_sort(g), "|"), 256).alias("gram_hash"))


@query("ded13_windows", f"with b as (select item_id, {norm('text')} as t from benchmark) select item_id, list_transform(range(1, greatest(length(t) - 78, 1), 40), lambda i: substr(t, i, 80)) as windows from b")
def ded13(spark, d):
    return table(spark, d, "benchmark").select("item_id", normalize("text").alias("norm")).select("item_id", H.windows("norm").alias("windows"))


_MH = f"""
b as (select item_id, {norm('text')} as t from benchmark),
hs as (select item_id, list_transform(list_distinct(case when length(t) - 12 > 1 then list_transform(range(1, length(t) - 11, greatest(1, ceil((length(t) - 12) / 64.0))::bigint), lambda i: substr(t, i, 13)) when length(t) > 0 then [t] else [] end), lambda g: ('0x' || substr(md5(g), 1, 15))::bigint % 2147483647) as hs from b),
mh as (select item_id, list_transform({[list(x) for x in H.permutations(128)]}, lambda s: list_min(list_transform(hs, lambda h: (h * s[1] + s[2]) % 2147483647))) as mh from hs)"""


@query("ded9_minhash", f"with {_MH} select item_id, sha256(array_to_string(mh, ',')) as signature from mh")
def ded9(spark, d):
    b = table(spark, d, "benchmark").select("item_id", normalize("text").alias("norm")).select("item_id", F.transform(H.grams("norm", 13, 64), H.md5_60).alias("hs"))
    return b.select("item_id", F.sha2(F.array_join(H.minhash("hs").cast("array<string>"), ","), 256).alias("signature"))


@query("ded10_minhash_pairs", f"""with {_MH}, k as (select item_id, mh, unnest(list_transform(range(0, 32), lambda b: b::varchar || ':' || array_to_string(mh[b * 4 + 1:b * 4 + 4], ','))) as k from mh),
p as (select distinct a.item_id as a, b.item_id as b, a.mh as x, b.mh as y from k a join k b on a.k = b.k and a.item_id < b.item_id)
select a as item_a, b as item_b, len(list_filter(range(1, 129), lambda i: x[i] = y[i])) / 128.0::double as similarity from p""")
def ded10(spark, d):
    b = table(spark, d, "benchmark").select("item_id", normalize("text").alias("norm")).select("item_id", F.transform(H.grams("norm", 13, 64), H.md5_60).alias("hs"))
    m = b.select("item_id", H.minhash("hs").alias("mh"))
    k = m.select("item_id", F.explode(H.band_keys("mh")).alias("k"))
    pairs = k.select(F.col("item_id").alias("item_a"), "k").join(k.select(F.col("item_id").alias("item_b"), "k"), "k").where("item_a < item_b").select("item_a", "item_b").distinct()
    j = pairs.join(m.select(F.col("item_id").alias("item_a"), F.col("mh").alias("x")), "item_a").join(m.select(F.col("item_id").alias("item_b"), F.col("mh").alias("y")), "item_b")
    return j.select("item_a", "item_b", H.minhash_similarity("x", "y").alias("similarity"))


_CON = f"""
c as (select doc_id as id, coalesce(text, '') as text, {norm('text')} as t from documents),
e as (select item_id as id, {norm('text')} as t from benchmark),
eg as (select distinct g from (select unnest(case when length(t) > 13 then list_transform(range(1, length(t) - 11), lambda i: substr(t, i, 13)) when length(t) > 0 then [t] else [] end) as g from e)),
cg as (select id, unnest(list_distinct(case when length(t) > 13 then list_transform(range(1, length(t) - 11), lambda i: substr(t, i, 13)) when length(t) > 0 then [t] else [] end)) as g from c),
ng as (select distinct id from cg where g in (select g from eg)),
sp as (select distinct c.id, e.id as eval_id from c join e on length(e.t) >= 40 and (contains(c.t, e.t) or contains(e.t, c.t))),
f as (select id, list_filter([case when t in (select t from e) then 'exact_eval_match' end, case when id in (select id from sp) then 'substring_eval_match' end, case when id in (select id from ng) then 'ngram_eval_match' end,
 case when regexp_matches(lower(text), 'answercarefully|mt-bench|mt bench|llm-jp instruction|private holdout|gsm8k|humaneval|mmlu') then 'benchmark_name_signal' end], lambda x: x is not null) as r from c)"""


def _cand(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")


def _evals(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text")


@query("con7_scan", f"with {_CON} select id as doc_id, case when len(r) > 0 then 'quarantine_contamination' else 'clear' end as status, array_to_string(r, ',') as reasons from f")
def con7(spark, d):
    return C.scan(_cand(spark, d), _evals(spark, d)).select(F.col("id").alias("doc_id"), "status", F.array_join("reasons", ",").alias("reasons"))


@query("con7_summary", f"with {_CON} select coalesce(x, 'clear') as reason, count(*) as n from (select unnest(case when len(r) = 0 then [null] else r end) as x from f) group by 1")
def con7_summary(spark, d):
    s = C.scan(_cand(spark, d), _evals(spark, d))
    return s.select(F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("clear"))).otherwise(F.col("reasons"))).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("jn7_substring_pairs", f"with {_CON} select id as doc_id, eval_id from sp")
def jn7(spark, d):
    prep = lambda df: df.select("id", normalize("text").alias("norm"))
    return C.substring_pairs(_cand(spark, d), prep(_evals(spark, d))).select(F.col("id").alias("doc_id"), "eval_id")


@query("jn8_ngram_semijoin", f"with {_CON} select id as doc_id from ng")
def jn8(spark, d):
    prep = lambda df: df.select("id", normalize("text").alias("norm"))
    return C.gram_overlap(_cand(spark, d), prep(_evals(spark, d))).select(F.col("id").alias("doc_id"))


@query("set5_gram_intersection", f"with {_CON} select count(*) as shared from eg where g in (select g from cg)")
def set5(spark, d):
    evals = _evals(spark, d).select("id", normalize("text").alias("norm"))
    return C.shared_keys(_cand(spark, d), evals, 13).agg(F.count(F.lit(1)).alias("shared"))


@query("con1_normalize", f"select doc_id, sha256({norm('text')}) as norm_hash from documents")
def con1(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(normalize("text"), 256).alias("norm_hash"))


@query("con8_fingerprints", f"select item_id, sha256({norm('text')}) as content_norm_hash, length({norm('text')})::bigint as normalized_length from benchmark")
def con8(spark, d):
    return C.fingerprints(_evals(spark, d)).withColumnRenamed("id", "item_id")


_WIN = f"""
c as (select doc_id as id, {norm('text')} as t, {norm("split_part(text, chr(10), 1)")} as p, lower(text) as low from documents),
e as (select item_id as id, {norm('text')} as t, {norm("split_part(text, chr(10), 1)")} as p from benchmark),
ew as (select id, substr(t, i, 80) as w from (select id, t, unnest(range(1, greatest(length(t) - 78, 1), 40)) as i from e)),
lw as (select distinct c.id, ew.id as eval_id from c join ew on contains(c.t, ew.w)),
hits as (select c.id, 1 as k, e.id as eval_id from c join e on c.t = e.t where e.t <> '' union all select c.id, 2, e.id from c join e on c.p = e.p where c.p <> '' union all select id, 3, eval_id from lw),
b as (select id, min(k) as k from hits group by id), ids as (select hits.id, list_sort(list(distinct eval_id)) as ids from hits join b on hits.id = b.id and hits.k = b.k group by hits.id)"""
_NAMED = " or ".join(f"contains(low, '{s}')" for s in C.SIGNALS_2)


def _prompted(df, key):
    return df.select(F.col(key).alias("id"), "text", F.substring_index("text", "\n", 1).alias("prompt"))


@query("con5_exact_status", f"""with {_WIN}, o as (select c.id, c.t, coalesce(b.k, 0) as k, ({_NAMED}) and t <> '' as named, ids from c left join b on c.id = b.id left join ids on c.id = ids.id)
select id as doc_id, case when t = '' then 'excluded_empty_projection' when k > 0 then 'quarantine_exact' when named then 'requires_manual_review' else 'clean' end as status,
 array_to_string(list_filter([['full_content_sha256', 'prompt_sha256', 'long_substring_ge_80'][k], case when named then 'benchmark_or_source_metadata_signal' end], lambda x: x is not null), ',') as reasons, coalesce(array_to_string(ids, ','), '') as matched_eval_ids from o""")
def con5_exact(spark, d):
    c = C.classify(_prompted(table(spark, d, "documents"), "doc_id"), _prompted(table(spark, d, "benchmark"), "item_id"), near=False)
    return c.select(F.col("id").alias("doc_id"), "status", F.array_join("reasons", ",").alias("reasons"), F.array_join(F.col("matched_eval_ids").cast("array<string>"), ",").alias("matched_eval_ids"))


@query("con5_status")
def con5(spark, d):
    """With the near check, whose votes SQL states only at great length; tested on planted texts."""
    c = C.classify(_prompted(table(spark, d, "documents"), "doc_id"), _prompted(table(spark, d, "benchmark"), "item_id"))
    return c.select(F.col("id").alias("doc_id"), "status", F.array_join("reasons", ",").alias("reasons"), "similarity", "matched_eval_ids")


@query("con6_gate", f"""with {_WIN} select c.id as doc_id, case when t = '' then 'excluded_empty_projection' when b.k is not null then 'quarantine_exact' when {_NAMED} then 'requires_manual_review' else 'not_checked_missing_eval_source' end as status from c left join b on c.id = b.id""")
def con6(spark, d):
    c = C.classify(_prompted(table(spark, d, "documents"), "doc_id"), _prompted(table(spark, d, "benchmark"), "item_id"), near=False)
    return C.gate(c, required_missing=True).select(F.col("id").alias("doc_id"), "status")


@query("jn6_window_probe", f"with {_WIN} select id as doc_id, eval_id from lw")
def jn6(spark, d):
    prep = lambda df: df.select("id", normalize("text").alias("norm"))
    return C.window_matches(_cand(spark, d), prep(_evals(spark, d))).select(F.col("id").alias("doc_id"), "eval_id")


@query("agg12_status_counts", f"with {_CON} select case when len(r) > 0 then 'quarantine_contamination' else 'clear' end as status, count(*) as rows, sum(case when len(r) > 0 then 1 else 0 end)::bigint as excluded from f group by 1")
def agg12(spark, d):
    s = C.scan(_cand(spark, d), _evals(spark, d))
    return s.groupBy("status").agg(F.count(F.lit(1)).alias("rows"), F.sum((F.size("reasons") > 0).cast("long")).alias("excluded"))


@query("jn14_cluster_evidence", f"with e as (select item_id, sha256({norm('text')}) as h from benchmark), c as (select doc_id, sha256({norm('text')}) as h from documents) select doc_id, count(e.item_id) as n_evals, min(e.item_id) as primary_eval from c left join e on c.h = e.h group by doc_id")
def jn14(spark, d):
    """Exact cluster evidence, and the least eval id of each (AGG22)."""
    key = lambda df: df.select("id", F.sha2(normalize("text"), 256).alias("h"))
    e = key(_evals(spark, d)).select(F.col("id").alias("item_id"), "h")
    by = e.groupBy("h").agg(F.count(F.lit(1)).alias("n_evals"), F.min("item_id").alias("primary_eval"))
    return key(_cand(spark, d)).join(by, "h", "left").select(F.col("id").alias("doc_id"), F.coalesce("n_evals", F.lit(0)).alias("n_evals"), "primary_eval")


@query("agg23_eval_corpus", f"select item_id % 4 as corpus, count(*) as rows, count(*) filter (where {norm('text')} = '') as empty_projections, count(distinct sha256({norm('text')})) as unique_content_hashes from benchmark group by 1")
def agg23(spark, d):
    n = _evals(spark, d).select((F.col("id") % 4).alias("corpus"), normalize("text").alias("norm"))
    return n.groupBy("corpus").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("norm") == "").alias("empty_projections"), F.count_distinct(F.sha2("norm", 256)).alias("unique_content_hashes"))


@query("agg21_corpus_hash", "select sha256(array_to_string(list(sha256(text) order by item_id), chr(10))) as corpus_hash from benchmark")
def agg21(spark, d):
    b = table(spark, d, "benchmark").agg(F.sort_array(F.collect_list(F.struct("item_id", F.sha2("text", 256).alias("h")))).alias("l"))
    return b.select(F.sha2(F.array_join(F.transform("l", lambda x: x["h"]), "\n"), 256).alias("corpus_hash"))


@query("flt26_genuine_exact", "select doc_id, sha256(text) <> sha256('') and text in (select text from documents group by text having count(*) > 1) as genuine from documents")
def flt26(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    many = docs.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return docs.join(many, "h").select("doc_id", ((F.col("h") != F.sha2(F.lit(""), 256)) & (F.col("n") > 1)).alias("genuine"))


@query("ded1_role_text", "select conv_id, turn, '<' || role || '>:' || trim(regexp_replace(text, '\\s+', ' ', 'g')) as line from conversations")
def ded1(spark, d):
    c = table(spark, d, "conversations")
    one = F.array(F.struct(records.role_of(F.col("role")).alias("role"), F.col("text").alias("content")))
    return c.select("conv_id", "turn", records.role_text(one).alias("line"))


@query("con1_casefold", "select doc_id, sha256(replace(lower(text), 'ß', 'ss')) as folded from documents")
def con1b(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(casefold("text"), 256).alias("folded"))
