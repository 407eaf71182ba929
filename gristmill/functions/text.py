"""Scalar text functions as native Columns: normalisation, tokens, character
classes, language."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Unicode and Python see it; the separators U+001C-1F are no Java white space.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: The characters that SPACE matches.
BLANKS = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Texts that NFKC leaves as they are and whose letters fold as ``casefold`` does: ASCII,
#: Latin-1 without its compatibility characters, basic Cyrillic, kana, unified ideographs and plain quotes.
STABLE = "^[\x00-\x7f¡-§©«¬®°±¶·»¿-ÿА-я–—‘’“”、。「」ぁ-ゖァ-ヺー一-鿿]*$"
# The character classes and code markers of the language classifier.
LATIN = "[A-Za-z]"
HIRAGANA = "[぀-ゟ]"
KATAKANA = "[゠-ヿㇰ-ㇿ]"
CJK = "[㐀-䶿一-鿿]"
CODE = r"(?i)```|</?[A-Za-z][^>]*>|\b(def|class|import|function|const|SELECT|FROM)\b|[{};]"


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def given(x) -> Column:
    """Null as empty."""
    return F.coalesce(col(x), F.lit(""))


def strip(x) -> Column:
    return F.btrim(col(x), F.lit(BLANKS))


def collapse(x) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(x), SPACE, " "))


def casefold(x) -> Column:
    """Case folding; exact wherever sharp s is the only letter that folds to two."""
    return F.replace(F.lower(col(x)), F.lit("ß"), F.lit("ss"))


def normal(s: str) -> str:
    """normalize of one text."""
    return " ".join((s if s.isascii() else unicodedata.normalize("NFKC", s)).casefold().split())


@F.pandas_udf(T.StringType())
def normalize_nfkc(x: pd.Series) -> pd.Series:
    """NFKC, casefold, collapse, for any text.  Spark has no NFKC."""
    return x.map(lambda s: None if s is None else normal(s))


def normalize(x) -> Column:
    """NFKC, casefold, collapse.  Texts that NFKC leaves alone stay in the JVM; only the
    others are sent to Python."""
    text = given(x)
    stable = text.rlike(STABLE)
    return F.when(stable, collapse(casefold(text))).otherwise(normalize_nfkc(F.when(~stable, text)))


def staged(df, **columns):
    """df plus columns that are computed once a row.  The optimizer puts definitions in
    place of names, once for each use, but not across a generator."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns], made.alias("_staged")).select(*[F.col(f"`{c}`") for c in df.columns], "_staged.*")


def filled(x) -> Column:
    """Null where the stripped text is empty."""
    return F.nullif(strip(x), F.lit(""))


def token_estimate(x) -> Column:
    n = F.length(given(x))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.ceil(n / 2))).cast("long")


def char_stats(x) -> dict[str, Column]:
    text = given(x)
    compact = F.regexp_replace(text, SPACE, "")
    count = lambda c, p: F.regexp_count(c, F.lit(p)).cast("long")
    return {"total": F.length(compact).cast("long"), "latin": count(compact, LATIN), "hiragana": count(compact, HIRAGANA), "katakana": count(compact, KATAKANA), "cjk": count(compact, CJK), "code_markers": count(text, CODE)}


def language(stats: dict[str, Column], metadata=None) -> dict[str, Column]:
    """Label and ratios from char_stats columns."""
    total = F.greatest(F.lit(1), stats["total"]).cast("double")
    ja, cjk, en = (stats["hiragana"] + stats["katakana"]) / total, stats["cjk"] / total, stats["latin"] / total
    code = F.least(F.lit(1.0), stats["code_markers"] / F.greatest(F.lit(1.0), total / 80))
    said = casefold(given(metadata)) if metadata is not None else F.lit("")
    parts = F.split(said, "-")
    said_ja = said.isin("ja", "jp", "japanese") | F.array_contains(parts, "ja")
    said_en = said.isin("en", "english") | F.array_contains(parts, "en")
    japanese = F.when(en >= 0.15, "mixed").otherwise("japanese")
    label = (
        F.when(said_ja & ((ja >= 0.03) | (cjk >= 0.08)), japanese)
        .when((ja >= 0.08) | ((ja >= 0.03) & (cjk >= 0.15)), japanese)
        .when((code >= 0.45) & (en >= 0.10), "code-heavy")
        .when(said_en | (en >= 0.35), "english")
        .otherwise("unknown")
    )
    ratio = lambda c: F.bround(c, 6)
    return {"language": label, "japanese_ratio": ratio(F.least(F.lit(1.0), ja + 0.25 * cjk)), "english_ratio": ratio(F.least(F.lit(1.0), en)), "code_ratio": ratio(code)}


def top_line_share(x) -> tuple[Column, Column]:
    """Share of the most frequent non-empty stripped line, and how many such lines there are.
    Sorted lines with equal neighbours make runs, so no line is compared with all others."""
    lines = F.array_sort(F.filter(F.transform(F.split(given(x), "\n"), strip), lambda s: s != ""))
    start = F.struct(F.lit("").alias("line"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(acc, line):
        run = F.when(acc["line"] == line, acc["run"] + 1).otherwise(1)
        return F.struct(line.alias("line"), run.alias("run"), F.greatest(acc["most"], run).alias("most"))

    most = F.aggregate(lines, start, step, lambda acc: acc["most"])
    n = F.size(lines)
    return F.when(n > 0, most / n).otherwise(F.lit(0.0)), n


def estimate_of_roles(messages, role: str) -> Column:
    return F.array_join(F.transform(F.filter(col(messages), lambda m: m["role"] == role), lambda m: m["content"]), "\n")
