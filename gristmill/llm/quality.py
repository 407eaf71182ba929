"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and stores, beside the measurements, one
bit for each rule that fails.  Policies are versioned bitmasks over that ledger;
``judge`` applies one, ``ablation`` says with bitwise aggregation what each rule
rejects alone.  Only DataFrame functions are used.

Null and empty texts have no words and fail FEW_WORDS.  Repeated rows are judged
alike.  Rows without a word break no ratio rule.  Extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, text_of

WINDOW = 5
#: name -> bit.  Bits are never reused; a new rule takes the next one.
RULES = {"few_words": 1, "repeated_words": 2, "word_length": 4, "symbols": 8, "duplicate_lines": 16}
BASE = RULES["few_words"] | RULES["repeated_words"]
#: version -> rules that reject.
POLICIES = {"base": BASE, "v1": BASE | RULES["word_length"] | RULES["symbols"] | RULES["duplicate_lines"]}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines")


def _measure(docs: DataFrame, text_col: str) -> DataFrame:
    """docs plus _gm_* measurement columns.  Each level of select names an array
    that the next one uses in a lambda, so that it is evaluated once a row."""
    text = text_of(text_col)
    df = docs.withColumn("_gm_words", F.array_remove(F.split(text, f"[{WS}]+"), ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WS}]"))
    df = df.withColumns({
        "_gm_n": F.size("_gm_words").cast("long"),
        "_gm_chars": F.length(F.array_join("_gm_words", "")).cast("long"),
        "_gm_sym": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "_gm_lines": lines,
        "_gm_win": F.expr(
            f"transform(slice(_gm_words, 1, greatest(size(_gm_words) - {WINDOW - 1}, 0)), (w, i) -> xxhash64(w, "
            + ", ".join(f"get(_gm_words, i + {k})" for k in range(1, WINDOW)) + "))"
        ),
    })
    # Sorted (hash, position) pairs, for the texts only in which a window repeats.
    df = df.withColumns({
        "_gm_dup": (F.size("_gm_lines") - F.size(F.array_distinct("_gm_lines"))).cast("long"),
        "_gm_nl": F.size("_gm_lines").cast("long"),
        "_gm_pairs": F.expr("case when size(array_distinct(_gm_win)) < size(_gm_win) then sort_array(transform(_gm_win, (h, i) -> struct(h as h, i as i))) end"),
    }).drop("_gm_words", "_gm_lines", "_gm_win")
    df = df.withColumn("_gm_at", F.expr(
        "case when _gm_pairs is not null then sort_array(transform(filter(_gm_pairs, (x, k) -> "
        "(k > 0 and x.h = get(_gm_pairs, k - 1).h) or coalesce(x.h = get(_gm_pairs, k + 1).h, false)), x -> x.i)) end"
    )).drop("_gm_pairs")
    # A word is covered by the window that starts at it or up to four before it.
    return df.withColumn("_gm_rep", F.expr(
        f"case when _gm_at is null then 0L else aggregate(transform(_gm_at, (x, k) -> least({WINDOW}, coalesce(get(_gm_at, k + 1) - x, {WINDOW}))), 0L, (a, b) -> a + b) end"
    )).drop("_gm_at")


def _bits() -> Column:
    n, chars, sym, dup, rep, nl = (F.col(f"_gm_{x}") for x in ("n", "chars", "sym", "dup", "rep", "nl"))
    fails = {
        "few_words": n < 10,
        "repeated_words": 100 * rep > 20 * n,
        "word_length": (chars < 2 * n) | (chars > 30 * n),
        "symbols": sym > n,
        "duplicate_lines": 2 * dup > nl,
    }
    out = F.lit(0)
    for name, bit in RULES.items():
        out = out.bitwiseOR(F.when(fails[name], bit).otherwise(0))
    return out


def ledger(docs: DataFrame, text_col: str = "text", out: str = "ledger") -> DataFrame:
    """docs plus one struct column: the measurements and the int ``failed``."""
    m = _measure(docs, text_col)
    cols = [F.col(f"_gm_{s}").alias(n) for s, n in zip(("n", "chars", "sym", "dup", "rep", "nl"), MEASURES, strict=True)]
    # A filter on the ledger must not be pushed below it: the optimizer would put the
    # definition of every level in place of its name, over and over.  Nothing that
    # reads what a generator puts out is pushed below the generator.
    once = F.explode(F.array(F.struct(*cols, _bits().alias("failed"))))
    return m.select(*[m[c] for c in docs.columns if c != out], once.alias(out))


def judge(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """docs whose texts the policy keeps, with their own columns."""
    led = ledger(docs, text_col, "_gm_ledger")
    return led.where(led["_gm_ledger.failed"].bitwiseAND(POLICIES[policy]) == 0).drop("_gm_ledger")


def ablation(led: DataFrame, policy: str = "v1", out: str = "ledger") -> DataFrame:
    """One row a rule of the policy: how many rows it fails, and how many it
    alone rejects (those that the policy would keep without it)."""
    mask = POLICIES[policy]
    failed = F.col(f"{out}.failed").bitwiseAND(mask)
    patterns = led.groupBy(failed.alias("bits")).count()  # at most 2^rules rows
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in RULES.items() if b & mask])
    return (
        patterns.select("bits", "count", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("rejected_alone"),
        )
    )
