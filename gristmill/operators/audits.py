"""Counts, profiles, decompositions and reconciliations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import given

# Known task splits and their buckets.
KNOWN_SPLITS = {"code_ja": "ja_code", "math_ja": "ja_math", "stem_ja": "ja_stem"}
TASK = r"(?:^|[_/])((?:code|math|stem)_[a-z]{2})(?=[_/.-]|$)"


def value_counts(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, n): one pass, each row expanded to its fields before the map-side counts."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.nullif(F.col(f).cast("string"), F.lit("")), F.lit("unknown")).alias("value")) for f in fields]))
    return df.select(pairs.alias("p")).select("p.field", "p.value").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, by: list[str], x: str) -> DataFrame:
    """Mean and exact quantiles, with linear interpolation."""
    q = {"median": 0.5, "p10": 0.1, "p90": 0.9, "p95": 0.95}
    return df.groupBy(*by).agg(F.round(F.avg(x), 6).alias("mean"), F.percentile(x, F.array(*map(F.lit, q.values()))).alias("_q")).select(*by, "mean", *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(q)])


def token_stats(df: DataFrame, by: list[str], tokens: str, quantiles=(0.5, 0.75, 0.9, 0.95, 0.99), edges=(1024, 4096, 8192, 32768), also: tuple[str, ...] = ()) -> DataFrame:
    """Rows, mass, quantiles and a histogram, and the mass of other token columns; rows without a count are left out."""
    t = F.col(tokens)
    bins, low = [], None
    for e in edges:
        bins.append(F.count_if(t <= e if low is None else (t > low) & (t <= e)).alias(f"le_{e}"))
        low = e
    bins.append(F.count_if(t > low).alias(f"gt_{low}"))
    g = df.where(t.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(t).alias("tokens"), F.max(t).alias("max_tokens"), F.round(F.avg(t), 6).alias("mean_tokens"), F.percentile(t, F.array(*map(F.lit, quantiles))).alias("_q"), *[F.sum(c).alias(c) for c in also], *bins)
    return g.select(*by, "rows", "tokens", *also, "max_tokens", "mean_tokens", *[F.get("_q", F.lit(i)).alias(f"p{round(q * 100)}") for i, q in enumerate(quantiles)], *[b for b in g.columns if b.startswith(("le_", "gt_"))])


def entropy(df: DataFrame, by: list[str], key: str, mass: str) -> DataFrame:
    """Shannon entropy in nats of the mass over key, a group at a time."""
    m = df.groupBy(*by, key).agg(F.sum(mass).cast("double").alias("_m"))
    m = m.withColumn("_p", F.col("_m") / F.sum("_m").over(W.partitionBy(*by))).where("_p > 0")
    return m.groupBy(*by).agg(F.round(-F.sum(F.col("_p") * F.log("_p")), 9).alias("entropy"))


def shares(df: DataFrame, by: list[str], mass: str) -> DataFrame:
    g = df.groupBy(*by).agg(F.sum(mass).alias("mass"))
    return g.withColumn("percent", F.round(100.0 * F.col("mass") / F.sum("mass").over(W.partitionBy()), 6))


def decomposition(df: DataFrame, fields: list[str]) -> DataFrame:
    """Counts by both fields, each, and in total, from one scan by grouping sets."""
    a, b = fields
    g = df.groupingSets([[F.col(a), F.col(b)], [F.col(a)], [F.col(b)], []], F.col(a), F.col(b)).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("_a"), F.grouping(b).alias("_b"))
    level = F.when((F.col("_a") == 0) & (F.col("_b") == 0), f"{a}_x_{b}").when(F.col("_a") == 0, a).when(F.col("_b") == 0, b).otherwise("total")
    return g.select(level.alias("level"), a, b, "n")


def waterfall(old: DataFrame, new: DataFrame, key: str, old_status: str, new_status: str, missing: str = "missing") -> DataFrame:
    """(old, new) status transitions with counts, by id."""
    j = old.join(new, key, "left").select(F.col(old_status), F.coalesce(new_status, F.lit(missing)).alias(new_status))
    return j.groupBy(old_status, new_status).agg(F.count(F.lit(1)).alias("n"))


def zip_sides(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Full outer join of two result sets by id, and which side has it."""
    a, b = old.select(key, F.lit(True).alias("_a")), new.select(key, F.lit(True).alias("_b"))
    return a.join(b, key, "full").select(key, F.col("_a").isNotNull().alias("in_old"), F.col("_b").isNotNull().alias("in_new"))


def audit_summary(records: DataFrame, by: str = "source") -> DataFrame:
    """One row a source from records (eligible, tokens, split, reasoning_ready, tool_ready)."""
    ok = F.coalesce(F.col("eligible"), F.lit(False))
    return records.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows_scanned"), F.count_if(ok).alias("valid_rows"), F.count_if(~ok).alias("rejected_rows"), F.sum(F.when(ok, F.col("tokens")).otherwise(0)).alias("eligible_token_count"),
        F.count_if(F.col("split").isin("eval", "test", "validation")).alias("excluded_eval_rows"), F.count_if("reasoning_ready").alias("reasoning_ready_rows"), F.count_if("tool_ready").alias("tool_ready_rows"),
    )


def stage_summary(sources: DataFrame, audits: DataFrame, statuses: DataFrame, key: str = "source") -> DataFrame:
    """Every source with its audit counts and its number of rows in each status; 0 where there are none."""
    by = statuses.groupBy(key).agg(F.count(F.lit(1)).alias("status_rows"), F.count_if(F.col("status") != "clear").alias("flagged_rows"))
    out = sources.select(key).distinct().join(audits, key, "left").join(by, key, "left")
    return out.fillna(0)


HIT_AXES = {"source": ["source"], "family": ["family"], "file": ["file"], "eval": ["eval"], "cluster": ["cluster"], "source_x_eval": ["source", "eval"], "total": []}


def hit_decomposition(hits: DataFrame) -> DataFrame:
    """(axis, key, n) of hits (source, source_row_id, eval, cluster) by HIT_AXES, from one
    scan by grouping sets; file and family are those of the row id."""
    file = F.substring_index("source_row_id", "#", 1)
    h = hits.select("source", "eval", "cluster", file.alias("file"), F.array_join(F.slice(F.split(file, "/"), 1, 2), "/").alias("family"))
    names = ("source", "family", "file", "eval", "cluster")
    sets = [[F.col(c) for c in axis] for axis in HIT_AXES.values()]
    g = h.groupingSets(sets, *[F.col(c) for c in names]).agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*names).alias("_g"))
    code = lambda axis: sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in axis)
    axis = F.lit(None).cast("string")
    for name, cols in HIT_AXES.items():
        axis = F.when(F.col("_g") == code(cols), name).otherwise(axis)
    return g.select(axis.alias("axis"), F.concat_ws("|", *names).alias("key"), "n")


def require_reconciled(decomposed: DataFrame) -> None:
    """Every axis adds up to the total, or an error."""
    sums = {r["axis"]: r["n"] for r in decomposed.groupBy("axis").agg(F.sum("n").alias("n")).collect()}
    off = [a for a, n in sums.items() if n != sums.get("total")]
    if off:
        raise ValueError(f"axes that do not add up to the total: {', '.join(sorted(off))}")


def reconciliation(raw: DataFrame, canonical: DataFrame, formatted: DataFrame, selected: DataFrame, target: int, tokens: str = "tokens") -> DataFrame:
    """One row: rows of each stage and what each lost, selected tokens, fill, and the blockers."""
    one = lambda df, stage: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "n")
    mass = selected.agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("n")).select(F.lit("selected").alias("stage"), "n")
    rows = union([one(raw, "raw"), one(canonical, "canonical"), one(formatted, "formatted"), mass])
    of = lambda stage: F.max(F.when(F.col("stage") == stage, F.col("n")))
    out = rows.agg(of("raw").alias("raw_rows"), of("canonical").alias("canonical_rows"), of("formatted").alias("formatted_rows"), of("selected").alias("selected_tokens"))
    fill = F.round(F.col("selected_tokens") / float(target), 6)
    blockers = F.array_compact(F.array(F.when(F.col("canonical_rows") > F.col("raw_rows"), "more_canonical_than_raw_rows"), F.when(F.col("formatted_rows") < F.col("canonical_rows"), "rows_not_formatted"), F.when(fill < 0.95, "underfilled")))
    return out.withColumns({"grouped_away": F.col("raw_rows") - F.col("canonical_rows"), "fill": fill, "blockers": F.array_join(blockers, ",")})


def require_same_ids(old: DataFrame, new: DataFrame, key: str) -> None:
    if zip_sides(old, new, key).where("not (in_old and in_new)").limit(1).count():
        raise ValueError("the two results do not have the same ids")


def fill_status(df: DataFrame, selected: str, target: float) -> DataFrame:
    s = F.col(selected)
    return df.withColumns({"fill": F.round(s / float(target), 6), "severe_underfill": s < 0.9 * target, "status": F.when(s >= 0.95 * target, "PASS").otherwise("PARTIAL")})


def split_class(path, split=None) -> tuple[Column, Column]:
    """(bucket, known) of a source path, or of an explicit split."""
    said = F.lower(given(split)) if split is not None else F.lit("")
    low = F.concat(F.lit("_"), F.replace(F.lower(given(path)), F.lit("-"), F.lit("_")), F.lit("_"))
    bucket = F.lit("non_ja")
    for name, b in reversed(KNOWN_SPLITS.items()):
        bucket = F.when((said == name) | low.contains(name), b).otherwise(bucket)
    return bucket, said.rlike("^(code|math|stem)_[a-z]{2}$") | low.rlike(TASK)


def split_conflict(path, split=None) -> Column:
    """More than one task label in the path, or one that differs from the split."""
    labels = F.array_distinct(F.regexp_extract_all(F.lower(given(path)), F.lit(TASK), 1))
    said = F.lower(given(split)) if split is not None else F.lit("")
    return (F.size(labels) > 1) | (said.rlike("^(code|math|stem)_[a-z]{2}$") & (F.size(labels) > 0) & ~F.array_contains(labels, said))


def require_no_text(df: DataFrame, refused=("text", "content", "messages", "user", "system", "assistant_final", "reasoning", "raw")) -> DataFrame:
    """df, if none of its columns could carry raw text."""
    bad = [c for c in df.columns if c.lower() in refused]
    if bad:
        raise ValueError(f"columns with raw text: {', '.join(bad)}")
    return df


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
