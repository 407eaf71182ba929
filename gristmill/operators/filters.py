"""The hard filter: sixteen reasons, evaluated once, marked and never deleted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import col, given, strip, top_line_share

# The patterns of the hard filter.
SECRETS = (
    r"\bsk-[A-Za-z0-9]{20,}\b",
    r"(?i)\b(?:ghp|github_pat|xox[baprs])-[-A-Za-z0-9_]{12,}\b",
    r"\bAKIA[0-9A-Z]{16}\b",
    r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    r"""(?i)\b(?:api[_ -]?key|secret[_ -]?key|access[_ -]?token)\s*[:=]\s*['"]?[A-Za-z0-9_\-/+=]{16,}""",
)
PRIVATE_PATHS = (r"(?i)[A-Z]:\\Users\\[^\\\s]+\\", r"/home/[^/\s]+/", r"/Users/[^/\s]+/")
REFUSAL = r"(?i)(?:I\s+can(?:not|'t)|申し訳ありません|お手伝いできません|対応できません)"
PLACEHOLDER = r"(?i)^(?:n/?a|none|null|todo|tbd|placeholder|未回答|回答なし)[.!。\s]*$"
BENCHMARK = r"(?i)(?:answercarefully|mt[- ]?bench|gsm8k|humaneval|mmlu|private holdout|評価用split)"
STACK = r"(?i)(?:Traceback \(most recent call last\)|Exception:|Error:\s*\w+Error)"
FORBIDDEN_ROLES = ("eval_only", "reference_only", "future_cpt_candidate")
EVAL_SPLITS = ("eval", "test", "validation")
LIMITS = {"refusal_chars": 240, "stack_chars": 1200, "replacement_ratio": 0.01, "control_ratio": 0.02, "repeat_lines": 4, "repeat_share": 0.65, "private_paths": 2}


#: Records with more characters are not tokenized.
OVERSIZE = 1_000_000


def oversize(chars, limit: int = OVERSIZE) -> dict[str, Column]:
    """Columns of a record's tokenization: over the limit it bypasses the tokenizer and
    stands as a row of quality 0, ready for nothing, in the last length bins."""
    big = col(chars) > limit
    return {
        "oversize": big, "quality_score": F.when(big, 0.0).cast("double"), "reasoning_sft_ready": F.when(big, False), "tool_sft_ready": F.when(big, False),
        "length_bin": F.when(big, ">16384"), "assistant_mask_status": F.when(big, "unavailable_oversized_record"),
    }


def reasons(user="user", answer="assistant_final", system=None, reasoning=None, split=None, role=None, error=None, metadata=None, limits=LIMITS) -> Column:
    """array<string> of the reasons that hold, in order, each once.  Arguments are
    columns or names; what is absent counts as empty."""
    has = lambda c: given(c) if c is not None else F.lit("")
    u, a = strip(given(user)), strip(given(answer))
    n = F.greatest(F.length(a), F.lit(1))
    whole = F.concat_ws("\n", *[F.nullif(has(c), F.lit("")) for c in (system, user, answer, reasoning) if c is not None])
    share, lines = top_line_share(a)
    low = F.lower(a)
    any_of = lambda text, patterns: F.greatest(*[text.rlike(p).cast("int") for p in patterns]) == 1
    paths = sum((F.regexp_count(whole, F.lit(p)) for p in PRIVATE_PATHS), F.lit(0))
    said = has(role)
    tests = [
        ("broken_json", F.lit(False) if error is None else col(error).isNotNull()),
        ("empty_user", u == ""),
        ("empty_assistant", a == ""),
        ("eval_split_not_train", F.lower(has(split)).isin(*EVAL_SPLITS)),
        ("forbidden_source_role", said.isin(*FORBIDDEN_ROLES)),
        ("placeholder_answer", a.rlike(PLACEHOLDER)),
        ("refusal_only", (F.length(a) <= limits["refusal_chars"]) & a.rlike(REFUSAL)),
        ("stack_trace_only", a.rlike(STACK) & (F.length(a) < limits["stack_chars"])),
        ("unicode_corruption", (F.length(a) - F.length(F.replace(a, F.lit("�"), F.lit("")))) / n > limits["replacement_ratio"]),
        ("control_character_corruption", F.regexp_count(a, F.lit(r"[\x00-\x08\x0B\x0C\x0E-\x1F]")) / n > limits["control_ratio"]),
        ("meaningless_repetition", (lines >= limits["repeat_lines"]) & (share >= limits["repeat_share"])),
        ("html_navigation_garbage", (F.length(a) > 40) & low.contains("<html") & ~low.contains("</html")),
        ("secret_like_string", any_of(whole, SECRETS)),
        ("private_path_exposure", paths >= limits["private_paths"]),
        ("benchmark_or_eval_signal", has(metadata).rlike(BENCHMARK)),
        ("eval_only_source", said == "eval_only"),
    ]
    return F.array_distinct(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests])))
