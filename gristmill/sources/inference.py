"""What a file's path, a schema registry and small metadata say about its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold, given
from ..operators.records import first_text, text_of, unwrapped

# Split tokens in order, split families, config folders, container keys, field-name markers.
SPLITS = ("eval", "validation", "test", "train")
FAMILY = r"(?:ultra-v\d+_)?((?:code|math|stem)_(?:hi|ja|ko|pt))"
CONFIG_DIRS = ("agent_traces", "openai_chat")
CONTAINERS = ("data", "questions", "examples", "rows", "test", "items")
TEACHER_MARKERS = ("teacher", "model", "generator", "source", "provenance", "annotator", "author", "origin")
IGNORED = r"(?i)(^|/)(\.cache|\.git|__pycache__)/|\.(lock|metadata|pyc)$"


def parent_and_stem(path) -> tuple[Column, Column]:
    p = F.regexp_replace(given(path), "/$", "")
    name = F.lower(F.regexp_replace(p, "^.*/", ""))
    stem = F.when(name.endswith(".jsonl.gz"), F.expr("null")).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))
    return p, F.coalesce(stem, F.regexp_replace(name, r"\.jsonl\.gz$", ""))


def config_of(path) -> Column:
    """The first folder named like a version, else a known one, else default."""
    p = given(path)
    version = F.nullif(F.regexp_extract(p, r"(?i)(?:^|/)(v\d+(?:\.\d+)*)/", 1), F.lit(""))
    known = F.nullif(F.regexp_extract(p, f"(?i)(?:^|/)({'|'.join(CONFIG_DIRS)})/", 1), F.lit(""))
    return F.coalesce(version, known, F.lit("default"))


def split_of(path) -> Column:
    """A split token in the file's stem, else its task family, else the stem."""
    _, stem = parent_and_stem(path)
    family = F.nullif(F.regexp_extract(stem, FAMILY, 1), F.lit(""))
    out = F.coalesce(family, F.nullif(stem, F.lit("")), F.lit("unknown"))
    for token in reversed(SPLITS):
        out = F.when(stem.rlike(rf"(?:^|[-_]){token}(?:[-_.]|$)"), token).otherwise(out)
    return out


def disposition(path, metadata: str, authoritative: str) -> Column:
    """scan for authoritative paths; metadata and other views of the same rows are excluded."""
    p = given(path)
    return F.when(p.rlike(metadata), "excluded_metadata").when(~p.rlike(authoritative), "excluded_derivative").otherwise("scan")


def adapt(rows: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """rows plus schema_adapter from a registry table (key, adapter)."""
    r = registry.select(F.col(key).alias("_k"), "adapter")
    return rows.join(r, rows[key] == r["_k"], "left").withColumn("schema_adapter", F.coalesce("adapter", F.lit("excluded_unregistered_schema"))).drop("_k", "adapter")


def named_fields(raw, content: tuple[str, ...], prompt: tuple[str, ...]) -> tuple[Column, Column]:
    """(content, prompt): the non-empty named fields of a JSON object, joined by newlines."""
    get = lambda keys: F.concat_ws("\n", *[F.nullif(text_of(unwrapped(raw, k), 1), F.lit("")) for k in keys])
    return get(content), get(prompt)


def turns(raw) -> Column:
    """Content of an eval row with turns, or with choices of turns."""
    own = F.try_variant_get(unwrapped(raw, "turns"), "$", "array<string>")
    chosen = F.flatten(F.transform(F.try_variant_get(unwrapped(raw, "choices"), "$", "array<variant>"), lambda c: F.try_variant_get(c, "$.turns", "array<string>")))
    return F.array_join(F.coalesce(own, chosen, F.array().cast("array<string>")), "\n")


def prompt_of(raw) -> Column:
    return first_text(raw, ("prompt", "instruction", "question"))


def container_rows(files: DataFrame, raw: str, schema: str) -> DataFrame:
    """Rows of JSON files: of the first container key that is there, or of a top-level array."""
    one = f"array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in schema.split(','))}>>"
    lists = [F.from_json(F.get_json_object(raw, f"$.{k}"), one) for k in CONTAINERS]
    return files.select(F.explode(F.coalesce(*lists, F.from_json(F.col(raw), one))).alias("row")).select("row.*")


def safe_sample(x, most: int = 160) -> Column:
    t = F.col(x) if isinstance(x, str) else x
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 3), F.lit("..."))).otherwise(t)


def license_flags(licenses) -> tuple[Column, Column]:
    """(mixed, unknown) of an array of license names."""
    n = F.size(F.array_distinct(F.filter(licenses, lambda x: x != "")))
    return (n > 1) | F.exists(licenses, lambda x: F.lower(x).contains("mixed")), n < 1


def revisions(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """One revision a group; several become mixed:a,b."""
    g = rows.groupBy(*by).agg(F.sort_array(F.collect_set(value)).alias("_r"))
    return g.select(*by, F.when(F.size("_r") == 1, F.get("_r", F.lit(0))).when(F.size("_r") > 1, F.concat(F.lit("mixed:"), F.array_join("_r", ","))).alias("revision"))


def match_dirs(policies: DataFrame, dirs: DataFrame, wanted: str, name: str) -> DataFrame:
    """Policies joined to folders by case-insensitive name, then with / read as __."""
    d = dirs.withColumn("_n", F.lower(name))
    p = policies.withColumns({"_a": F.lower(wanted), "_b": F.replace(F.lower(wanted), F.lit("/"), F.lit("__"))})
    first = p.join(d, p["_a"] == d["_n"], "left_semi").join(d, F.col("_a") == F.col("_n"))
    rest = p.join(d, p["_a"] == d["_n"], "left_anti").join(d, F.col("_b") == F.col("_n"), "left")
    return first.unionByName(rest).drop("_a", "_b", "_n")


def teacher_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if any(m in f.name.lower() for m in TEACHER_MARKERS)]


def is_data_file(path) -> Column:
    p = given(path)
    return casefold(p).rlike(r"\.(jsonl|jsonl\.gz|parquet)$") & ~p.rlike(IGNORED)
