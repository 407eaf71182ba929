"""Policies, registries, recipes and manifests as tables; their issues as rows.

An issue is (code, level, subject).  Rules are data: a code, a level and a
predicate; every rule is evaluated once over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import given

# Roles and statuses of a registry, and fields a manifest must name.
ROLES = ("train_candidate", "future_cpt_candidate", "eval_only", "reference_only")
STATUSES = ("quarantine", "locked", "approved")
AVAILABILITY = ("available", "unavailable", "gated", "license_restricted", "not_acquired")
MANIFEST_FIELDS = ("dataset_id", "source_repo", "source_config", "source_revision", "source_split", "license", "language", "category", "contamination_status")
KNOWN_FIELDS = ("source_revision", "source_split", "license")
EVAL_FIELDS = ("id", "name", "version", "split", "row_count", "availability", "required", "training_allowed", "revision", "license", "content_hash")


def issues(df: DataFrame, subject: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    every = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(level).alias("level"))) for code, level, test in rules]))
    return df.select(F.col(subject).alias("subject"), F.explode(every).alias("i")).select("i.code", "i.level", "subject").distinct()


def blank(x: str) -> Column:
    return F.trim(given(x)) == ""


def policy_issues(policies: DataFrame) -> DataFrame:
    """Policies (id, repo, role, max_weight, …): ids and repos are unique and named."""
    dup = lambda key: policies.groupBy(key).count().where("count > 1").select(F.lit(f"duplicate_{key}").alias("code"), F.lit("error").alias("level"), F.col(key).alias("subject"))
    own = issues(policies, "id", [("id_missing", "error", blank("id")), ("repo_missing", "error", blank("repo")), ("unknown_role", "error", ~F.col("role").isin(*ROLES)), ("weight_invalid", "error", (F.col("max_weight") < 0) | (F.col("max_weight") > 1))])
    return own.unionByName(dup("id")).unionByName(dup("repo"))


def registry_issues(datasets: DataFrame) -> DataFrame:
    """Registry entries (id, role, status, category, repo)."""
    role, status = F.col("role"), F.col("status")
    own = issues(datasets, "id", [
        ("dataset_id_missing", "error", blank("id")), ("unknown_role", "error", ~given("role").isin(*ROLES)), ("unknown_status", "error", ~given("status").isin(*STATUSES)),
        ("category_missing", "error", blank("category")), ("repo_missing", "error", role.isin("train_candidate", "future_cpt_candidate", "reference_only") & blank("repo")),
        ("protected_dataset_not_locked", "error", role.isin("eval_only", "reference_only") & (given("status") != "locked")),
        ("future_candidate_not_quarantined", "error", (role == "future_cpt_candidate") & (given("status") != "quarantine")),
        ("approved_role_invalid", "error", (status == "approved") & (given("role") != "train_candidate")),
    ])
    dup = datasets.groupBy("id").count().where("count > 1").select(F.lit("duplicate_dataset_id").alias("code"), F.lit("error").alias("level"), F.col("id").alias("subject"))
    return own.unionByName(dup)


def manifest_issues(registry: DataFrame, manifests: DataFrame) -> DataFrame:
    """Approved training sources against their manifests (MANIFEST_FIELDS,
    schema_version, manifest_sha256 as stated and actual_sha256, n_records)."""
    m = manifests.select(*[F.col(c).alias(f"m_{c}") for c in manifests.columns])
    j = registry.where("status = 'approved'").join(m, F.col("id") == F.col("m_dataset_id"), "left")
    have = F.col("m_dataset_id").isNotNull()
    rules = [("manifest_missing", "blocked", ~have)]
    rules += [("manifest_field_missing", "blocked", have & blank(f"m_{f}")) for f in MANIFEST_FIELDS]
    rules += [("manifest_field_unknown", "blocked", have & F.lower(F.trim(given(f"m_{f}"))).isin("unknown", "unspecified", "tbd")) for f in KNOWN_FIELDS]
    rules += [
        ("manifest_schema_version", "blocked", have & (F.col("m_schema_version") != 1)), ("manifest_hash_invalid", "blocked", have & ~given("m_manifest_sha256").rlike("(?i)^[0-9a-f]{64}$")),
        ("manifest_hash_mismatch", "blocked", have & (F.lower(given("m_manifest_sha256")) != F.col("m_actual_sha256"))), ("manifest_repo_mismatch", "blocked", have & (F.col("repo") != F.col("m_source_repo"))),
        ("manifest_category_mismatch", "blocked", have & (F.col("category") != F.col("m_category"))), ("contamination_not_clear", "blocked", have & (given("m_contamination_status") != "clear")),
        ("manifest_records_empty", "blocked", have & (F.col("m_n_records") < 1)),
    ]
    return issues(j, "id", rules)


def recipe_issues(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Recipe candidates (recipe, bucket, dataset_id, mass) against the registry, and buckets whose shares do not add up to 1."""
    r = registry.select(F.col("id").alias("_id"), "role", "status")
    j = candidates.join(r, F.col("dataset_id") == F.col("_id"), "left")
    own = issues(j, "dataset_id", [
        ("candidate_unknown", "error", F.col("_id").isNull()), ("candidate_role_forbidden", "error", F.col("role").isin("eval_only", "reference_only", "future_cpt_candidate")),
        ("candidate_not_approved", "blocked", (F.col("role") == "train_candidate") & (F.col("status") != "approved")), ("mass_invalid", "error", ~(F.col("mass") > 0)),
    ])
    sums = candidates.groupBy("recipe").agg(F.sum("mass").alias("s")).where(F.abs(F.col("s") - 1) > 1e-6)
    return own.unionByName(sums.select(F.lit("recipe_mass_not_one").alias("code"), F.lit("error").alias("level"), F.col("recipe").alias("subject")))


def missing_evals(registry: DataFrame, expected: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Expected eval ids that are neither forbidden nor available."""
    need = expected.join(forbidden, "id", "left_anti")
    return need.join(registry.where("availability = 'available'").select("id"), "id", "left_anti")


def required_eval_missing(entries: DataFrame) -> DataFrame:
    """One row: whether any required entry (required, availability) is not available."""
    return entries.agg(F.coalesce(F.bool_or(F.col("required") & (given("availability") != "available")), F.lit(False)).alias("missing"))


#: What an evaluation registry may say of an entry; never its content.
EVAL_METADATA = (
    "availability", "blocked_reason", "contamination_scan_ready", "content_hash", "fingerprint_path", "id", "license_raw", "local_path",
    "name", "required", "row_count", "source", "source_revision", "split", "training_forbidden", "version",
)


def eval_metadata(entries: DataFrame) -> DataFrame:
    """entries with the columns of EVAL_METADATA alone, by name."""
    return entries.select(*[c for c in EVAL_METADATA if c in entries.columns])


def eval_config_issues(evals: DataFrame) -> DataFrame:
    return issues(evals, "id", [("availability_unknown", "error", ~given("availability").isin(*AVAILABILITY)), ("training_allowed", "error", F.col("training_allowed")), ("split_not_test", "error", ~F.lower(given("split")).isin("test", "eval", "validation")), ("required_missing", "blocked", F.col("required") & (given("availability") != "available"))])


def train_config_issues(config: dict) -> list[tuple[str, str, str]]:
    """Checks of one training configuration."""
    number = lambda x: isinstance(x, int | float) and not isinstance(x, bool)
    bad = [k for k in ("max_sequence_length", "learning_rate", "epochs") if not (number(config.get(k)) and config[k] > 0)]
    out = [("value_not_positive", "error", k) for k in bad]
    if config.get("training_allowed"):
        out.append(("training_allowed_must_be_false", "blocked", "training_allowed"))
    if not config.get("base_model"):
        out.append(("base_model_missing", "error", "base_model"))
    return out


def within_budget(usd_per_hour: float, fx: float, hours: float, cap: float) -> bool:
    if min(usd_per_hour, fx, hours, cap) <= 0:
        raise ValueError("budget inputs must be positive")
    return usd_per_hour * fx * hours <= cap


def enough_storage(free: float, estimate: float, reserve: float | None = None) -> bool:
    """With a reserve, free must exceed both together; without, the estimate by 15 %."""
    return free > estimate + reserve if reserve is not None else free >= estimate * 1.15


def exit_code(states: list[str]) -> int:
    """1 after an error, 2 if anything is blocked or partial, else 0."""
    return 1 if "ERROR" in states else 2 if {"BLOCKED", "PARTIAL"} & set(states) else 0
