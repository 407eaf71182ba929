"""Sinks.  Spark's committers make each write all or nothing."""

from __future__ import annotations

import csv
import io
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.audits import require_no_text


def write_audit(df: DataFrame, path: str) -> None:
    """Content-free audit rows as gzipped JSON lines, a folder a dataset."""
    require_no_text(df).write.mode("overwrite").partitionBy("source_dataset").option("compression", "gzip").json(path)


def write_candidates(df: DataFrame, path: str) -> None:
    """Parquet (zstd) with nested columns as JSON text."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map", "variant")]
    out = df.select(*[F.to_json(c).alias(f"{c}_json") if c in nested else F.col(c) for c in df.columns])
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def commit_chunk(df: DataFrame, path: str, chunk: int) -> None:
    """Write one chunk so that writing it again replaces it and nothing else."""
    df.withColumn("chunk", F.lit(chunk)).write.mode("overwrite").partitionBy("chunk").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)


def write_output(df: DataFrame, path: str, kind: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    w.option("compression", "gzip").json(path) if kind == "jsonl.gz" else w.parquet(path)


def append_fingerprints(df: DataFrame, path: str) -> None:
    require_no_text(df).write.mode("append").json(path)


def atomic_write(path: str, text: str) -> None:
    """A small driver-side file, replaced in one step."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    tmp = f"{path}.tmp{os.getpid()}"
    with open(tmp, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(tmp, path)


def report_rows(df: DataFrame, most: int = 10_000) -> tuple[list[str], list[list]]:
    """Rows of an aggregate for a report; more than `most` is an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report table has at most {most} rows")
    return df.columns, [list(r) for r in rows]


def to_csv(df: DataFrame) -> str:
    names, rows = report_rows(df)
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(names)
    w.writerows(rows)
    return out.getvalue()


def to_markdown(title: str, df: DataFrame) -> str:
    names, rows = report_rows(df)
    cell = lambda x: str("" if x is None else x).replace("|", "\\|").replace("\n", " ")
    return "\n".join([f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "---|" * len(names), *("| " + " | ".join(map(cell, r)) + " |" for r in rows), ""])


def to_html(title: str, df: DataFrame) -> str:
    from html import escape

    names, rows = report_rows(df)
    body = "".join("<tr>" + "".join(f"<td>{escape(str('' if x is None else x))}</td>" for x in r) + "</tr>" for r in rows)
    return f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1><table><tr>" + "".join(f"<th>{escape(n)}</th>" for n in names) + f"</tr>{body}</table>"


def eval_registry(entries: DataFrame) -> str:
    """The evaluation registry as JSON: whitelisted metadata alone, by id."""
    from ..operators.governance import eval_metadata

    kept = eval_metadata(entries)
    names, rows = report_rows(kept.orderBy("id"))
    evals = [{k: v for k, v in zip(names, r, strict=True) if v is not None} for r in rows]
    return json.dumps({"schema_version": 1, "training_forbidden": True, "evaluations": evals}, sort_keys=True, ensure_ascii=False)


def manifest(df: DataFrame, source: str, mass: str) -> str:
    """Candidate manifest: mass and share by source, as JSON with sorted keys."""
    from ..operators.audits import shares

    _, rows = report_rows(shares(df, [source], mass).orderBy(F.desc("mass"), source))
    return json.dumps({"sources": [{"id": a, "mass": b, "percent": c} for a, b, c in rows]}, sort_keys=True, ensure_ascii=False)


def drop_samples(value):
    """A nested inventory without any `samples` entry."""
    if isinstance(value, dict):
        return {k: drop_samples(v) for k, v in value.items() if k != "samples"}
    return [drop_samples(v) for v in value] if isinstance(value, list) else value
