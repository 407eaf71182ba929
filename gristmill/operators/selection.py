"""Buckets, token-mass selection, allocation and sampling."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import casefold, given

# Targets, thresholds and limits.
TARGETS = {"general_japanese": 0.30, "instruction_extraction": 0.15, "japanese_math_reasoning": 0.20, "japanese_stem_code": 0.10, "frontier_reasoning": 0.15, "agent_code_retention": 0.10}
THRESHOLDS = (95, 90, 85, 80, 75)
DIVERSITY, FAMILY_SHARE = 0.70, 0.05
EXCLUDED_SPLITS = ("eval", "test", "validation", "dev")
#: (bucket, pattern of the category); sources may be added by sets of ids.
BUCKET_RULES = (
    ("agent_code_retention", "agent"), ("frontier_reasoning", "frontier"), ("japanese_stem_code", "code|stem"),
    ("japanese_math_reasoning", "math|reason"), ("instruction_extraction", "instruction|extraction"),
)


def bucket(category, source=None, split_bucket=None, sources: dict[str, tuple[str, ...]] | None = None) -> Column:
    """First rule that fits: by source id, by split bucket (…_code, …_math), by category."""
    cat = casefold(given(category))
    src = casefold(given(source)) if source is not None else F.lit("")
    special = given(split_bucket) if split_bucket is not None else F.lit("")
    out = F.lit("general_japanese")
    for name, pattern in reversed(BUCKET_RULES):
        test = cat.rlike(pattern) | src.isin(*(sources or {}).get(name, ("\0",)))
        if name == "japanese_stem_code":
            test = test | special.endswith("_code")
        if name == "japanese_math_reasoning":
            test = test | special.endswith("_math")
        out = F.when(test, name).otherwise(out)
    return out


def length_bucket(tokens) -> Column:
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.when(t <= 4096, "short").when(t <= 8192, "medium").when(t <= 32768, "long").otherwise("extra_long")


def char_bin(chars) -> Column:
    c = F.col(chars) if isinstance(chars, str) else chars
    return F.when(c <= 256, "le_256").when(c <= 1024, "le_1024").when(c <= 4096, "le_4096").when(c <= 16384, "le_16384").otherwise("gt_16384")


def sample_key(seed: int, *parts) -> Column:
    """Hex SHA-256 of seed:part:…, missing parts printed as None."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("None")) for p in parts]), 256)


def stable_score(seed: int, record_id, source_row_id=None, content_hash=None) -> Column:
    """Hex SHA-256 of seed:identity, identity being the first of the three that is not empty."""
    some = [F.nullif((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in (record_id, source_row_id, content_hash) if c is not None]
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(*some, F.lit(""))), 256)


def ready(source, rules: dict[str, Column]) -> Column:
    """Whether a record meets its own source's condition; sources without one always do."""
    out = F.lit(True)
    for name, test in rules.items():
        out = F.when((F.col(source) if isinstance(source, str) else source) == name, F.coalesce(test, F.lit(False))).otherwise(out)
    return out


def mass_plan(candidates: DataFrame, stats: DataFrame) -> DataFrame:
    """Target mass of each candidate (bucket, dataset_id, mass of the bucket): its share
    of the tokens (dataset_id, tokens) that its bucket has; candidates without tokens are left out."""
    j = candidates.join(stats, "dataset_id").where("tokens > 0")
    total = F.sum("tokens").over(W.partitionBy("bucket"))
    return j.select("bucket", "dataset_id", F.col("tokens").alias("available_tokens"), F.round(F.col("mass") * F.col("tokens") / total, 8).alias("target_mass"))


#: Buckets of the two sides that a balanced candidate needs.
SIDES = {"japanese": ("general_japanese", "instruction_extraction", "japanese_math_reasoning", "japanese_stem_code"), "frontier": ("frontier_reasoning", "agent_code_retention")}


def pool_mass(pools: DataFrame, target: int, bucket: str = "bucket", tokens: str = "tokens") -> DataFrame:
    """One row: token mass of each side, half the target, and whether both sides reach it."""
    side = lambda s: F.coalesce(F.sum(F.when(F.col(bucket).isin(*SIDES[s]), F.col(tokens))), F.lit(0)).alias(f"{s}_pool_tokens")
    half = target // 2
    return pools.agg(*[side(s) for s in SIDES]).select("*", F.lit(half).cast("long").alias("target_each_side"), F.least(*[F.col(f"{s}_pool_tokens") for s in SIDES]).__ge__(half).alias("balanced"))


def token_prefix(df: DataFrame, key: str, tokens: str, target: int, partition: list[str], digits: int = 3) -> DataFrame:
    """Rows in key order up to and with the one that reaches the target, a stratum at a time.

    A running sum over a whole stratum would be one task's work.  The first digits
    of the key cut a stratum into ranges; range totals give each range its offset,
    ranges beyond the target go unread, and rows are summed within their range."""
    cut = df.withColumn("_range", F.substring(key, 1, digits))
    totals = cut.groupBy(*partition, "_range").agg(F.sum(tokens).alias("_t"))
    before = F.coalesce(F.sum("_t").over(W.partitionBy(*partition).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = totals.withColumn("_start", before).where(F.col("_start") < target).select(*partition, "_range", "_start")
    within = W.partitionBy(*partition, "_range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    summed = cut.join(starts, [*partition, "_range"]).withColumn("mass_before", F.col("_start") + F.coalesce(F.sum(tokens).over(within), F.lit(0)))
    return summed.where(F.col("mass_before") < target).drop("_range", "_start")


def bottom_k(df: DataFrame, partition: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """The k rows of least order in each partition; Spark limits each task to k a group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*partition).orderBy(*order))).where(F.col(rank) <= k)


def allocate(strata: DataFrame, key: str, count: str, n: int) -> DataFrame:
    """Proportional allocation of n over strata: one each, the rest by floors of the
    quotas and largest remainders; with fewer places than strata the largest get them.
    strata has one row a stratum."""
    s = strata.where(F.col(count) > 0)
    every = W.partitionBy()
    s = s.withColumns({"_k": F.count(F.lit(1)).over(every), "_total": F.sum(count).over(every), "_by_size": F.row_number().over(W.orderBy(F.desc(count), key))})
    left = F.greatest(F.lit(0), F.least(F.lit(n), F.col("_total")) - F.col("_k"))
    room = F.greatest(F.lit(1), F.col("_total") - F.col("_k"))
    s = s.withColumn("_quota", (F.col(count) - 1) * left / room)
    s = s.withColumns({"_floor": F.floor("_quota"), "_rest": left - F.sum(F.floor("_quota")).over(every)})
    s = s.withColumn("_place", F.row_number().over(W.orderBy((F.bround(F.col("_quota") - F.col("_floor"), 9)).desc(), F.desc(count), key)))
    many = 1 + F.col("_floor") + F.when(F.col("_place") <= F.col("_rest"), 1).otherwise(0)
    few = F.when(F.col("_by_size") <= n, 1).otherwise(0)
    return s.select(key, F.col(count), F.when(F.col("_k") > n, few).otherwise(many).cast("long").alias("allocated"))


def round_robin(df: DataFrame, part: str, group: str, order: list) -> DataFrame:
    """df plus turn and position: the r-th row of each group of a part, groups by key."""
    turn = F.row_number().over(W.partitionBy(part, group).orderBy(*order))
    t = df.withColumn("turn", turn)
    return t.withColumn("position", F.row_number().over(W.partitionBy(part).orderBy("turn", group)))


def stratified_by_mass(df: DataFrame, total_tokens: int, targets: dict[str, float] = TARGETS, pool: int = 8000, seed: int = 3407) -> DataFrame:
    """Greedy selection by token mass from (record_id, bucket, stratum, family,
    tokens).  A bucket's pool is its `pool` rows of least hash, taken in turns over
    its strata; a row is skipped if it has no mass, would overshoot the bucket's
    target, or would take its family over FAMILY_SHARE of it.  The pool bounds what
    one task holds."""
    scored = df.withColumn("_score", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("record_id")), 256))
    pooled = bottom_k(scored.where(F.col("bucket").isin(*targets)), ["bucket"], ["_score", "record_id"], pool)
    turns = round_robin(pooled, "bucket", "stratum", ["_score", "record_id"]).select("record_id", "bucket", "stratum", "family", "tokens", "position")

    def pick(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("position")
        target = round(total_tokens * targets[part["bucket"].iloc[0]])
        cap, mass, families, keep = max(1, int(target * FAMILY_SHARE)), 0, {}, []
        for family, tokens in zip(part["family"], part["tokens"], strict=True):
            ok = mass < target and tokens > 0 and mass + tokens <= target and families.get(family, 0) + tokens <= cap
            if ok:
                mass += tokens
                families[family] = families.get(family, 0) + tokens
            keep.append(ok)
        return part[keep]

    return turns.groupBy("bucket").applyInPandas(pick, turns.schema)


def threshold_sweep(rows: DataFrame, thresholds=THRESHOLDS, minimum: dict[str, float] | None = None, default_minimum: float = 0.0) -> DataFrame:
    """One row a threshold from (source, quality, tokens, family, eligible): rows,
    mass, missing minimum retention, entropy, ratio, passes.  Two aggregations; the
    rows are multiplied by the thresholds only after they are summed by
    (source, family, first threshold they pass)."""
    level = F.lit(None).cast("int")
    for t in sorted(thresholds):
        level = F.when(F.col("quality") >= t, t).otherwise(level)
    base = rows.withColumn("_level", level).groupBy("source", "family", "eligible", "_level").agg(F.sum("tokens").alias("mass"), F.count(F.lit(1)).alias("n"))
    each = base.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    taken = F.col("eligible") & F.coalesce(F.col("_level") >= F.col("threshold"), F.lit(False))
    each = each.withColumns({"m": F.when(taken, F.col("mass")).otherwise(0), "k": F.when(taken, F.col("n")).otherwise(0), "em": F.when(F.col("eligible"), F.col("mass")).otherwise(0)})
    src = each.groupBy("threshold", "source").agg(F.sum("m").alias("sel"), F.sum("mass").alias("every"), F.sum("k").alias("k"))
    need = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in (minimum or {"": 0.0}).items() for x in kv]), F.col("source")), F.lit(default_minimum)) if minimum else F.lit(default_minimum)
    src = src.groupBy("threshold").agg(F.sum("k").alias("rows"), F.sum("sel").alias("mass"), F.sum((F.col("sel") / F.greatest(F.col("every"), F.lit(1)) < need).cast("long")).alias("missing_minimum"))
    fam = each.groupBy("threshold", "family").agg(F.sum("m").alias("m"), F.sum("em").alias("em"))
    tot = W.partitionBy("threshold")
    p, q = F.col("m") / F.sum("m").over(tot), F.col("em") / F.sum("em").over(tot)
    fam = fam.withColumns({"p": F.when(F.sum("m").over(tot) > 0, p), "q": F.when(F.sum("em").over(tot) > 0, q)})
    ent = lambda x: F.coalesce(-F.sum(F.when(F.col(x) > 0, F.col(x) * F.log(x))), F.lit(0.0))
    fam = fam.groupBy("threshold").agg(ent("p").alias("entropy"), ent("q").alias("eligible_entropy"))
    out = src.join(fam, "threshold")
    ratio = F.when(F.col("eligible_entropy") > 1e-12, F.col("entropy") / F.col("eligible_entropy")).otherwise(F.when((F.abs("entropy") <= 1e-12) & (F.col("rows") > 0), 1.0).otherwise(0.0))
    out = out.withColumn("diversity_ratio", F.bround(ratio, 6))
    return out.select("threshold", "rows", "mass", "missing_minimum", F.bround("entropy", 6).alias("entropy"), "diversity_ratio", ((F.col("missing_minimum") == 0) & (F.col("diversity_ratio") >= DIVERSITY)).alias("passes"))
