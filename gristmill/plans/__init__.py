"""Registered queries over the driver's tables, each with its oracle beside it."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame, and the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Oracle form of operators.records.from_documents.
REC = """
rec as (select *, substr(text, length(usr) + 2) as answer from (select doc_id, sha256(coalesce(source, '') || ':' || doc_id::varchar) as record_id, coalesce(source, 'unknown') as source_dataset,
  coalesce(lang, 'unknown') as category, doc_id::varchar as source_row_id, coalesce(text, '') as text, split_part(coalesce(text, ''), chr(10), 1) as usr from documents))"""
#: Normal form of text, for text that NFKC leaves as it is.
NORM = "trim(regexp_replace(replace(lower(coalesce({0}, '')), 'ß', 'ss'), '\\s+', ' ', 'g'))"


def norm(x: str) -> str:
    return NORM.format(x)


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
