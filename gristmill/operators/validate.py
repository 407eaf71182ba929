"""Conversation validators and turn-safe segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import col, given, strip
from .records import ROLES


def _issues(tests) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(t, F.lit(n)) for t, n in tests]))))


def unpaired_tools(messages) -> Column:
    """How many tool messages do not follow an assistant message."""
    roles = F.transform(col(messages), lambda m: m["role"])
    return F.size(F.filter(F.transform(col(messages), lambda m, i: (m["role"] == "tool") & F.coalesce(F.get(roles, i - 1) != "assistant", F.lit(True))), lambda x: x))


def trace_errors(messages) -> Column:
    m = col(messages)
    has = lambda r: F.exists(m, lambda x: x["role"] == r)
    n = F.size(m)
    return F.when(m.isNull() | (n == 0), F.array(F.lit("messages_missing"))).otherwise(_issues([
        (F.exists(m, lambda x: ~x["role"].isin(*ROLES)), "unknown_role"), (~has("user"), "user_missing"), (~has("assistant"), "assistant_missing"),
        (unpaired_tools(m) > 0, "tool_without_preceding_assistant"), (F.get(m, n - 1)["role"] == "tool", "trace_ends_with_tool_result"),
    ]))


def training_errors(messages, final, system=None, formatted=None, most: int = 4096) -> Column:
    m = col(messages)
    mine = F.filter(m, lambda x: x["role"] == "assistant")
    count = lambda text, mark: F.regexp_count(text, F.lit(mark))
    tests = [
        (F.size(mine) == 0, "assistant_role_missing"), (~F.exists(m, lambda x: x["role"] == "user"), "user_role_missing"),
        (F.exists(m, lambda x: ~x["role"].isin(*ROLES)), "unknown_role"), (~F.exists(mine, lambda x: strip(x["content"]) != ""), "final_answer_missing"),
        (F.exists(mine, lambda x: count(F.lower(x["content"]), "<think>") != count(F.lower(x["content"]), "</think>")), "think_tag_unbalanced"),
        (strip(given(final)) == "", "final_answer_field_missing"), (unpaired_tools(m) > 0, "tool_result_pair_missing"),
        ((count(given(system), r"<\|im_start\|>") > 1 if system is not None else F.lit(False)) | (count(given(final), r"<\|im_end\|>") > 1), "duplicated_bos_or_eos_marker"),
    ]
    if formatted is not None:
        tests.append((F.coalesce(col(formatted) > most, F.lit(False)), "max_sequence_exceeded_without_safe_segmentation"))
    return _issues(tests)


def segment(messages: list[tuple[str, int]], most: int) -> tuple[list[tuple[int, int]], str]:
    """Cut (role, tokens) messages into spans of at most `most` tokens, only after an
    assistant or tool message and never before a tool message; the latest such cut
    is taken.  States: messages_missing, long_trace_unsegmented, segmented,
    single_turn_boundary_safe."""
    if not messages:
        return [], "messages_missing"
    cuts, start, total = [], 0, 0
    for end in range(1, len(messages) + 1):
        total += messages[end - 1][1]
        while total > most:
            cut = next((k for k in range(end - 1, start, -1) if messages[k - 1][0] in ("assistant", "tool") and messages[k][0] != "tool"), None)
            if cut is None:
                return [], "long_trace_unsegmented"
            cuts.append((start, cut))
            total -= sum(n for _, n in messages[start:cut])
            start = cut
    cuts.append((start, len(messages)))
    return cuts, "segmented" if len(cuts) > 1 else "single_turn_boundary_safe"


def segments(records: DataFrame, id_col: str, most: int, tokens=None) -> DataFrame:
    """One row a segment: id_col, state, segment, first, last (exclusive).  The cut
    depends on all that came before it, so it runs in Arrow batches of (role, token
    count) pairs; texts stay on the JVM side."""
    count = tokens or (lambda c: F.greatest(F.lit(1), F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))))
    slim = records.select(F.col(id_col), F.transform("messages", lambda m: F.struct(m["role"].alias("role"), count(m["content"]).cast("int").alias("n"))).alias("m"))

    def cut(batches):
        for part in batches:
            rows = []
            for key, m in zip(part[id_col], part["m"], strict=True):
                spans, state = segment([(x["role"], x["n"]) for x in (m if m is not None else [])], most)
                rows += [(key, state, i, a, b) for i, (a, b) in enumerate(spans)] or [(key, state, -1, 0, 0)]
            import pandas as pd

            yield pd.DataFrame(rows, columns=[id_col, "state", "segment", "first", "last"])

    kind = slim.schema[id_col]
    return slim.mapInPandas(cut, T.StructType([kind, T.StructField("state", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in ("segment", "first", "last")]]))
