"""Event-time windows and governance tables over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import governance
from ..streaming import ingest
from . import query, table


@query("str7_sessions", "with p as (select user_id, ts, lag(ts) over (partition by user_id order by ts) as prev from events), s as (select *, sum(case when prev is null or ts >= prev + interval 30 minutes then 1 else 0 end) over (partition by user_id order by ts rows between unbounded preceding and current row) as g from p) select user_id, min(ts) as session_start, count(*) as n from s group by user_id, g")
def str7(spark, d):
    return ingest.sessions(table(spark, d, "events"), "ts", "user_id")


@query("str_tumbling", "select time_bucket(interval 1 hour, ts) as window_start, event_type, count(*) as n from events group by 1, 2")
def str_tumbling(spark, d):
    return ingest.tumbling(table(spark, d, "events"), "ts", ["event_type"])


@query("str6_first_seen", "select event_type, user_id, min(event_id) as event_id from events group by 1, 2")
def str6(spark, d):
    return table(spark, d, "events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("event_id"))


_REG = "reg as (select s_name as id, case s_nationkey % 5 when 0 then 'train_candidate' when 1 then 'eval_only' when 2 then 'future_cpt_candidate' when 3 then 'reference_only' else 'other' end as role, case s_suppkey % 3 when 0 then 'approved' when 1 then 'locked' else 'quarantine' end as status, case when s_acctbal < 0 then '' else 'chat' end as category, 'repo/' || s_suppkey::varchar as repo from supplier)"


def _registry(spark, d):
    pick = lambda n, xs: F.element_at(F.array(*map(F.lit, xs)), (n + 1).cast("int"))
    return table(spark, d, "supplier").select(
        F.col("s_name").alias("id"), pick(F.col("s_nationkey") % 5, ("train_candidate", "eval_only", "future_cpt_candidate", "reference_only", "other")).alias("role"), pick(F.col("s_suppkey") % 3, ("approved", "locked", "quarantine")).alias("status"),
        F.when(F.col("s_acctbal") < 0, "").otherwise("chat").alias("category"), F.concat(F.lit("repo/"), F.col("s_suppkey").cast("string")).alias("repo"),
    )


@query("val5_registry_issues", f"""with {_REG}, i as (select id, unnest(list_filter([case when role = 'other' then 'unknown_role' end, case when category = '' then 'category_missing' end, case when role in ('eval_only', 'reference_only') and status <> 'locked' then 'protected_dataset_not_locked' end,
 case when role = 'future_cpt_candidate' and status <> 'quarantine' then 'future_candidate_not_quarantined' end, case when status = 'approved' and role <> 'train_candidate' then 'approved_role_invalid' end], lambda x: x is not null)) as code from reg) select code, 'error' as level, id as subject from i""")
def val5(spark, d):
    return governance.registry_issues(_registry(spark, d))


@query("src1_policy_issues", f"with {_REG} select 'unknown_role' as code, 'error' as level, id as subject from reg where role = 'other'")
def src1(spark, d):
    return governance.policy_issues(_registry(spark, d).withColumn("max_weight", F.lit(0.5)))


@query("jn11_recipe_issues", f"with {_REG} select case when role is null then 'candidate_unknown' when role in ('eval_only', 'reference_only', 'future_cpt_candidate') then 'candidate_role_forbidden' else 'candidate_not_approved' end as code, case when role = 'train_candidate' then 'blocked' else 'error' end as level, id as subject from reg where role <> 'other' and not (role = 'train_candidate' and status = 'approved')")
def jn11(spark, d):
    reg = _registry(spark, d)
    n = reg.count()
    cand = reg.select(F.lit("r").alias("recipe"), F.lit("b").alias("bucket"), F.col("id").alias("dataset_id"), F.lit(1.0 / max(n, 1)).alias("mass"))
    return governance.recipe_issues(cand, reg)


@query("src23_required_evals", f"with {_REG} select id from reg where role = 'eval_only' and status <> 'locked' and category = 'chat'")
def src23(spark, d):
    reg = _registry(spark, d)
    evals = reg.where("role = 'eval_only'").select("id", F.when(F.col("status") == "locked", "available").otherwise("gated").alias("availability"), "category")
    return governance.missing_evals(evals, evals.select("id"), evals.where("category = ''").select("id"))
