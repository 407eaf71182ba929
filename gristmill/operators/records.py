"""Canonical records: from raw JSON of any known shape, from tables of turns, from documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold, char_stats, col, collapse, filled, given, language, strip, token_estimate

MESSAGES = "array<struct<role:string,content:string>>"
# Role aliases, and the keys under which each part of a record may stand, in order of preference.
ROLE_ALIASES = {"developer": "system", "human": "user", "model": "assistant", "tool_result": "tool"}
ROLES = ("system", "user", "assistant", "tool")
TEXT_KEYS = ("content", "text", "value", "output", "answer", "solution")
MESSAGE_KEYS = ("messages", "conversations", "conversation", "dialogue")
USER_KEYS = ("user", "input", "instruction", "prompt", "question", "problem")
ANSWER_KEYS = ("assistant", "output", "response", "answer", "solution")
REASONING_KEYS = ("reasoning", "reasoning_content", "r1_generation", "analysis", "thought")
THINK = (r"(?is)<think>(.*?)</think>", r"(?is)<analysis>(.*?)</analysis>")


def parse(raw) -> Column:
    """VARIANT of a JSON text that is an object or array; null otherwise."""
    text = strip(raw)
    return F.when(text.startswith("{") | text.startswith("["), F.try_parse_json(text))


def once(x: Column, f) -> Column:
    """f(x) with x computed once a row: a lambda's argument is a value, where a name would
    be replaced by its definition at each use."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def unwrapped(raw, path: str) -> Column:
    """The value at a key, from the object itself or else from the JSON text in its row_json."""
    v = parse(raw)
    nested = F.try_parse_json(F.try_variant_get(v, "$.row_json", "string"))
    return F.coalesce(F.try_variant_get(v, f"$.{path}", "variant"), F.try_variant_get(nested, f"$.{path}", "variant"))


def text_of(v: Column, depth: int = 2) -> Column:
    """Text of a variant: a string stripped, of an object its first text key, of an array its lines."""
    leaf = strip(F.try_variant_get(v, "$", "string"))
    if depth == 0:
        return leaf
    kind = F.schema_of_variant(v)
    inner = F.coalesce(*[F.nullif(text_of(F.try_variant_get(v, f"$.{k}", "variant"), depth - 1), F.lit("")) for k in TEXT_KEYS])
    items = F.array_join(F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: text_of(x, depth - 1)), lambda s: s != ""), "\n")
    return F.when(kind.startswith("OBJECT"), inner).when(kind.startswith("ARRAY"), items).otherwise(leaf)


def role_of(x) -> Column:
    r = casefold(strip(given(x)))
    out = r
    for a, b in ROLE_ALIASES.items():
        out = F.when(r == a, b).otherwise(out)
    return out


def messages_of(raw) -> Column:
    """The first list of messages that has any, with known roles and content, else user and answer by their keys."""
    def listed(v):
        items = F.try_variant_get(v, "$", "array<variant>")
        made = F.transform(items, lambda m: F.struct(role_of(F.coalesce(F.try_variant_get(m, "$.role", "string"), F.try_variant_get(m, "$.from", "string"))).alias("role"), F.coalesce(F.nullif(text_of(F.try_variant_get(m, "$.content", "variant"), 2), F.lit("")), text_of(m, 1), F.lit("")).alias("content")))
        good = F.filter(made, lambda m: m["role"].isin(*ROLES) & (m["content"] != ""))
        return F.when(F.size(good) > 0, good)

    pair = F.array(
        F.struct(F.lit("user").alias("role"), first_text(raw, USER_KEYS).alias("content")),
        F.struct(F.lit("assistant").alias("role"), first_text(raw, ANSWER_KEYS).alias("content")),
    )
    pair = F.filter(pair, lambda m: m["content"].isNotNull())
    return F.coalesce(*[listed(unwrapped(raw, k)) for k in MESSAGE_KEYS], pair)


def event_messages(raw) -> Column:
    """Messages of an event stream: an event's nested message, else a typed event with content or text."""
    events = F.try_variant_get(unwrapped(raw, "_event_stream"), "$", "array<variant>")

    def message(e):
        nested, kind = F.try_variant_get(e, "$.message", "variant"), casefold(F.coalesce(F.try_variant_get(e, "$.type", "string"), F.lit("")))
        inner = F.struct(role_of(F.try_variant_get(nested, "$.role", "string")).alias("role"), F.coalesce(text_of(F.try_variant_get(nested, "$.content", "variant"), 1), F.lit("")).alias("content"))
        own = F.coalesce(F.nullif(text_of(F.try_variant_get(e, "$.content", "variant"), 1), F.lit("")), text_of(F.try_variant_get(e, "$.text", "variant"), 0), F.lit(""))
        typed = F.struct(F.when(kind.isin("user", "assistant", "tool", "tool_result"), role_of(kind)).otherwise("").alias("role"), own.alias("content"))
        return F.when(inner["role"].isin(*ROLES) & (inner["content"] != ""), inner).otherwise(typed)

    return F.filter(F.transform(events, message), lambda m: m["role"].isin(*ROLES) & (m["content"] != ""))


def metadata_json(df: DataFrame, columns: list[str]) -> Column:
    """Scalar columns as a JSON object with sorted keys, nulls left out."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))


def first_text(raw, keys) -> Column:
    """The first key with a non-empty text, at the top or under metadata or meta."""

    def of(v):
        def either(nested):
            value = lambda k: F.coalesce(F.try_variant_get(v, f"$.{k}", "variant"), F.try_variant_get(nested, f"$.{k}", "variant"))
            return F.coalesce(*[once(value(k), lambda x: F.nullif(text_of(x, 1), F.lit(""))) for k in keys])

        return once(F.try_parse_json(F.try_variant_get(v, "$.row_json", "string")), either)

    return once(parse(raw), of)


def found_value(raw, keys) -> Column:
    """As first_text, then in metadata, then in meta."""
    inner = [F.nullif(strip(F.try_variant_get(unwrapped(raw, m), f"$.{k}", "string")), F.lit("")) for m in ("metadata", "meta") for k in keys]
    return F.coalesce(first_text(raw, keys), *inner)


def reasoning_split(answer, explicit=None) -> tuple[Column, Column]:
    """(reasoning, final answer): an explicit field, else the first tagged block; blocks leave the answer."""
    a = given(answer)
    think, analysis = (F.nullif(strip(F.regexp_extract(a, p, 1)), F.lit("")) for p in THINK)
    final = strip(F.regexp_replace(F.regexp_replace(a, THINK[0], ""), THINK[1], ""))
    return F.coalesce(*([filled(explicit)] if explicit is not None else []), think, analysis, F.lit("")), final


def said_by(messages, role: str) -> Column:
    return F.array_join(F.transform(F.filter(col(messages), lambda m: m["role"] == role), lambda m: m["content"]), "\n")


def last_of(messages, role: str) -> Column:
    mine = F.filter(col(messages), lambda m: m["role"] == role)
    return F.coalesce(F.get(mine, F.size(mine) - 1)["content"], F.lit(""))


def record_id(dataset, row_id) -> Column:
    return F.sha2(F.concat_ws(":", given(dataset), given(row_id)), 256)


def record_hash(messages) -> Column:
    """SHA-256 of the compact JSON of the messages, content white space collapsed and role casefolded."""
    norm = F.transform(col(messages), lambda m: F.struct(collapse(m["content"]).alias("content"), casefold(m["role"]).alias("role")))
    return F.sha2(F.to_json(norm), 256)


def role_text(messages) -> Column:
    """'<role>:content' lines, white space collapsed, case of the content kept."""
    return F.array_join(F.transform(col(messages), lambda m: F.concat(F.lit("<"), casefold(m["role"]), F.lit(">:"), collapse(m["content"]))), "\n")


def content_text(messages) -> Column:
    return F.array_join(F.transform(col(messages), lambda m: m["content"]), "\n")


def prompt_text(messages) -> Column:
    return F.array_join(F.transform(F.filter(col(messages), lambda m: m["role"].isin("system", "user")), lambda m: m["content"]), "\n")


def template_family(messages) -> Column:
    return F.substring(F.sha2(F.array_join(F.transform(col(messages), lambda m: m["role"]), ","), 256), 1, 16)


def provenance_confidence(revision, license_) -> Column:
    """A literal 'unknown' counts as present for partial, as it does not for high."""
    r, x = given(revision), given(license_)
    return F.when(~r.isin("", "unknown") & ~x.isin("", "unknown"), "high").when((r != "") | (x != ""), "partial").otherwise("unknown")


def record_languages(user="user", answer="assistant_final", reasoning=None, metadata=None) -> dict[str, Column]:
    """Language of each part and of the whole, and the whole's ratios."""
    parts = {"user": given(user), "assistant": given(answer), "reasoning": given(reasoning) if reasoning is not None else F.lit("")}
    out = {f"language_{k}": language(char_stats(c), metadata)["language"] for k, c in parts.items()}
    out["language_reasoning"] = F.when(parts["reasoning"] == "", "unknown").otherwise(out["language_reasoning"])
    stats = char_stats(F.concat_ws("\n", *[F.nullif(c, F.lit("")) for c in parts.values()]))
    whole = language(stats, metadata)
    total = F.greatest(F.lit(1), stats["total"]).cast("double")
    ratio = lambda c: F.bround(F.least(F.lit(1.0), c / total), 6)
    return out | {"language_overall": whole["language"], "japanese_ratio": ratio(stats["hiragana"] + stats["katakana"]), "english_ratio": ratio(stats["latin"]), "code_ratio": whole["code_ratio"]}


def contamination_record(df: DataFrame, raw_col: str = "raw", disposition: str = "disposition") -> DataFrame:
    """record_id, messages, user and assistant_final of rows (dataset_id, source_row_id,
    raw, disposition) that are to be scanned; all others keep their id and are empty."""
    scan = F.col(disposition) == "scan"
    messages = F.when(scan, messages_of(raw_col)).otherwise(F.array().cast(MESSAGES))
    made = df.withColumn("messages", messages)
    return made.select(record_id("dataset_id", "source_row_id").alias("record_id"), F.col("dataset_id").alias("source_dataset"), "source_row_id", "messages", said_by("messages", "user").alias("user"), last_of("messages", "assistant").alias("assistant_final"), F.col(disposition).alias("contamination_scan_disposition"))


def from_turns(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One record a conversation: messages in turn order.  A conversation's turns
    meet in one row, as the record needs them."""
    grouped = turns.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), role_of(F.col(role)).alias("role"), given(text).alias("content")))).alias("m"))
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return grouped.select("conv_id", messages.alias("messages")).withColumns({"system": said_by("messages", "system"), "user": said_by("messages", "user"), "assistant_final": last_of("messages", "assistant")})


def from_documents(docs: DataFrame) -> DataFrame:
    """One record a document: the first line asks, the rest answers."""
    user = F.substring_index(given("text"), "\n", 1)
    answer = F.substr(given("text"), F.length(user) + 2, F.length(given("text")))
    return docs.select(
        "doc_id", record_id("source", F.col("doc_id").cast("string")).alias("record_id"), F.coalesce("source", F.lit("unknown")).alias("source_dataset"),
        F.coalesce("lang", F.lit("unknown")).alias("category"), F.col("doc_id").cast("string").alias("source_row_id"), given("text").alias("text"), user.alias("user"), answer.alias("assistant_final"),
    )


def canonicalize(raw: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Canonical records of (dataset_id, source_row_id, raw JSON text, and optional
    source_config, source_split, category, source_path, source_revision).  A raw text
    that does not parse keeps its row, with parse_error set."""
    have = set(raw.columns)
    opt = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    df = raw.withColumns({"_v": parse(raw_col), "messages": messages_of(raw_col), "_explicit": first_text(raw_col, REASONING_KEYS)})
    df = df.withColumns({"system": said_by("messages", "system"), "user": said_by("messages", "user"), "_answer": last_of("messages", "assistant")})
    reasoning, final = reasoning_split("_answer", F.col("_explicit"))
    df = df.withColumns({"reasoning": reasoning, "assistant_final": final})
    langs = {f"language_{k}": language(char_stats(c), opt("language"))["language"] for k, c in (("user", "user"), ("assistant", "assistant_final"), ("reasoning", "reasoning"))}
    langs["language_reasoning"] = F.when(F.col("reasoning") == "", "unknown").otherwise(langs["language_reasoning"])
    whole = F.concat_ws("\n", *[F.nullif(F.col(c), F.lit("")) for c in ("user", "assistant_final", "reasoning")])
    langs["language_overall"] = language(char_stats(whole), opt("language"))["language"]
    teacher = found_value(raw_col, ("teacher_model", "teacher", "model", "generator"))
    return df.select(
        record_id("dataset_id", "source_row_id").alias("record_id"), F.col("dataset_id").alias("source_dataset"), opt("source_config").alias("source_config"), opt("source_split").alias("source_split"), "source_row_id",
        F.coalesce(opt("source_revision"), F.lit("unknown")).alias("source_revision"), F.coalesce(opt("category"), F.lit("unknown")).alias("category"), "system", "user", "assistant_final", "reasoning", "messages",
        *[c.alias(n) for n, c in langs.items()], F.coalesce(teacher, F.lit("unknown")).alias("teacher_model"), found_value(raw_col, ("license", "license_raw")).alias("license_raw"),
        (F.length("user") + F.length("assistant_final") + F.length("reasoning")).cast("long").alias("char_count"), token_estimate(whole).alias("token_count"), record_hash("messages").alias("record_hash"),
        F.struct(opt("repo").alias("source_repo"), opt("source_path").alias("source_path"), "source_row_id").alias("provenance_raw"), F.when(F.col("_v").isNull(), F.lit("broken JSON")).alias("parse_error"),
    )
