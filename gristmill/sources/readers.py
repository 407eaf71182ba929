"""Readers: JSON lines (plain or gzip), JSON documents, Parquet, event files; each
row with its lineage (source_path, row_index, source_row_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip
from .inference import IGNORED, container_rows, is_data_file


def relative(path: Column, root: str) -> Column:
    """A file's path below root; the scheme does not matter."""
    clean = lambda c: F.regexp_replace(F.regexp_replace(c, "^[a-z0-9]+:/+", "/"), "/+", "/")
    base = clean(F.lit(root.rstrip("/") + "/"))
    return F.replace(clean(path), base, F.lit(""))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(source_path, suffix, bytes) of the data files below root, by case-folded path.  File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    rel = relative(F.col("path"), root)
    out = files.select(rel.alias("source_path"), F.regexp_extract(F.lower(rel), r"\.(jsonl\.gz|jsonl|parquet)$", 0).alias("suffix"), F.col("length").alias("bytes"))
    return out.where(is_data_file("source_path")).orderBy(F.lower("source_path"))


def numbered_lines(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """(source_path, line, value) with 0-based line numbers by file.  Lines are
    counted by file block, blocks add up to offsets, and a line's number is its
    place in its block plus that offset; no file needs to pass through one task."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    return numbered(raw.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")), root or path)


def numbered(raw: DataFrame, root: str) -> DataFrame:
    """As numbered_lines, of rows (value, _file, _block) that come straight from a text source."""
    lines = raw.withColumn("_at", F.monotonically_increasing_id())
    blocks = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("_before", before).select("_file", "_block", "_first", "_before")
    # ids rise by one within a task, and a block is read by one task
    joined = lines.join(F.broadcast(blocks) if blocks.limit(200_001).count() <= 200_000 else blocks, ["_file", "_block"])
    return joined.select(relative(F.col("_file"), root).alias("source_path"), (F.col("_before") + F.col("_at") - F.col("_first")).cast("long").alias("line"), "value")


def read_jsonl(spark: SparkSession, path: str, dataset_id: str, root: str | None = None) -> DataFrame:
    """One row a non-blank line: raw is the JSON text of an object; a line that does
    not parse has _parse_error, one that is no object _invalid_row.  Blank lines
    are left out but count in line numbers."""
    lines = numbered_lines(spark, path, root).where(strip("value") != "")
    v = F.try_parse_json("value")
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return lines.select(
        F.lit(dataset_id).alias("dataset_id"), "source_path", F.concat_ws("#", "source_path", (F.col("line") + 1).cast("string")).alias("source_row_id"), F.col("line").alias("row_index"),
        F.when(is_object, F.col("value")).alias("raw"), F.when(v.isNull(), F.lit("invalid JSON")).alias("_parse_error"), F.when(v.isNotNull() & ~is_object, F.lit("not an object")).alias("_invalid_row"),
    )


def first_rows(df: DataFrame, most: int | None) -> DataFrame:
    """The first `most` rows in the order of files and rows (a row limit of a reader); all if None."""
    return df if most is None else df.orderBy(F.lower("source_path"), "row_index").limit(most)


def read_audit(spark: SparkSession, path: str, datasets: list[str] | None = None) -> DataFrame:
    """Audit rows as written by ``sinks.write_audit``, of some datasets or all; the
    others' folders are not read."""
    df = spark.read.json(path)
    return df.where(F.col("source_dataset").isin(datasets)) if datasets is not None else df


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Token rows, as Parquet or else as JSON lines; a broken line is an error."""
    if path.endswith((".jsonl", ".jsonl.gz", ".json")):
        return spark.read.option("mode", "FAILFAST").json(path)
    return spark.read.parquet(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of whole JSON documents: arrays, or objects with a known container key."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return container_rows(files, "value", schema)


def read_parquet(spark: SparkSession, path: str, dataset_id: str, root: str | None = None, start_row: int = 0) -> DataFrame:
    """Rows with raw as JSON text of all columns; start_row skips rows of each file by the reader's own row index."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    rel = relative(F.col("_metadata.file_path"), root or path)
    out = df.select(F.lit(dataset_id).alias("dataset_id"), rel.alias("source_path"), F.col("_metadata.row_index").alias("row_index"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("raw"))
    out = out.withColumn("source_row_id", F.concat_ws("#", "source_path", (F.col("row_index") + 1).cast("string")))
    return out.where(F.col("row_index") >= start_row) if start_row else out


def after_cursor(rows: DataFrame, cursor: str | None) -> DataFrame:
    """Rows after a path#n cursor, in file order; an unknown cursor is an error."""
    if not cursor:
        return rows
    path, _, n = cursor.rpartition("#")
    if not path or not n.isdigit():
        raise ValueError(f"invalid cursor: {cursor}")
    if not rows.where((F.col("source_path") == path) & (F.col("source_row_id") == cursor)).limit(1).count():
        raise ValueError(f"cursor not found: {cursor}")
    key = F.lower("source_path")
    return rows.where((key > path.lower()) | ((F.col("source_path") == path) & (F.col("row_index") >= int(n))))


def logical_files(files: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Of a dataset with agent_traces/*.jsonl files, only those; else all."""
    traces = F.col("source_path").rlike(r"(?i)(^|/)agent_traces/[^/]*\.jsonl")
    any_ = F.max(traces.cast("int")).over(W.partitionBy(*(by or [F.lit(1)])))
    return files.withColumn("_any", any_).where(traces | (F.col("_any") == 0)).drop("_any")


def event_files(rows: DataFrame) -> DataFrame:
    """One row a file: its raw events in row order, as one JSON array."""
    g = rows.where("raw is not null").groupBy("dataset_id", "source_path").agg(F.sort_array(F.collect_list(F.struct("row_index", "raw"))).alias("_e"))
    raw = F.concat(F.lit('{"_event_stream":['), F.array_join(F.transform("_e", lambda e: e["raw"]), ","), F.lit("]}"))
    return g.select("dataset_id", "source_path", F.concat_ws("#", "source_path", F.lit("1")).alias("source_row_id"), F.size("_e").alias("n_events"), raw.alias("raw"))


def dataset_card(spark: SparkSession, path: str) -> dict[str, str]:
    """Scalar front-matter entries of a README."""
    rows = spark.read.text(path, wholetext=True).limit(1).collect()
    text = rows[0]["value"] if rows else ""
    if not text.startswith("---"):
        return {}
    head = text.split("---", 2)[1]
    return {k.strip(): v.strip().strip("'\"") for k, _, v in (line.partition(":") for line in head.splitlines()) if v.strip() and not k.startswith((" ", "-", "#"))}


def inventory(rows: DataFrame) -> DataFrame:
    """Rows, files, configs and splits by dataset, from lineage columns alone."""
    from .inference import config_of, split_of

    r = rows.withColumns({"_c": config_of("source_path"), "_s": split_of("source_path")})
    return r.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source_path").alias("files"), F.sort_array(F.collect_set("_c")).alias("configs"), F.sort_array(F.collect_set("_s")).alias("splits"))


__all__ = ["IGNORED", "after_cursor", "dataset_card", "event_files", "inventory", "list_files", "logical_files", "numbered_lines", "read_json", "read_jsonl", "read_parquet"]
