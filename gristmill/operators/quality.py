"""The six-part deterministic quality score, 0 to 100."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import given, strip, top_line_share

METHOD = "deterministic_structural_heuristic_v1"
# Boilerplate openings, and the parts of a category that make a record useful.
BOILERPLATE = "(?i)(?:もちろんです|お手伝いします|以下に|ご紹介します)"
USEFUL = "general|instruction|extraction|math|reason|stem|code|agent|writing|frontier"
KNOWN_ROLES = ("system", "user", "assistant", "tool", "developer")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x))


def parts(user="user", answer="assistant_final", reasoning=None, category=None, vendor=None, messages=None, tools_ok=None) -> dict[str, Column]:
    u, a = strip(given(user)), strip(given(answer))
    r = strip(given(reasoning)) if reasoning is not None else F.lit("")
    whole = F.concat(u, a, r)
    n = F.greatest(F.length(whole), F.lit(1))
    share, lines = top_line_share(a)
    roles = (lambda *names: F.exists(messages, lambda m: m["role"].isin(*names))) if messages is not None else (lambda *names: F.lit(True))
    structural = F.when((u != "") & (a != "") & roles("user") & roles("assistant"), 20.0).otherwise(0.0)
    bad = (F.length(whole) - F.length(F.replace(whole, F.lit("�"), F.lit("")))) / n
    penalty = F.when(lines > 0, F.greatest(F.lit(0.0), F.least(F.lit(10.0), 10 * share - 2))).otherwise(0.0)
    linguistic = clamp(20 - 500 * bad - penalty, 0, 20)
    completeness = F.least(F.lit(20.0), 7 + F.when(F.length(a) >= 40, 6).otherwise(0) + F.when(F.length(a) / F.greatest(F.length(u), F.lit(1)) >= 0.35, 4).otherwise(0) + F.when(r != "", 3).otherwise(0))
    unique = F.size(F.array_distinct(F.filter(F.split(whole, ""), lambda c: c != "")))
    density = clamp(15 * (0.45 + F.least(F.lit(0.55), 2 * unique / n)) - 0.8 * F.regexp_count(whole, F.lit(BOILERPLATE)), 0, 15)
    useful = F.lower(given(category)).rlike(USEFUL) if category is not None else F.lit(False)
    usefulness = clamp(7 + F.when(useful, 8).otherwise(3) - (F.when(vendor, 1).otherwise(0) if vendor is not None else 0), 0, 15)
    odd = F.exists(messages, lambda m: ~m["role"].isin(*KNOWN_ROLES)) if messages is not None else F.lit(False)
    tools = F.lit(True) if tools_ok is None else tools_ok
    integrity = 10.0 - F.when(tools, 0).otherwise(5) - F.when(odd, 5).otherwise(0)
    out = {"structural": structural, "linguistic": linguistic, "completeness": completeness, "density": density, "usefulness": usefulness, "format_integrity": integrity}
    return {k: F.bround(v.cast("double"), 3) for k, v in out.items()}


def total(columns: list[str]) -> Column:
    return F.bround(sum((F.col(c) for c in columns), F.lit(0.0)), 3)
