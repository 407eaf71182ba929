"""Resumable ingestion: Structured Streaming over a drop folder, run until what is
there has been read; and event-time windows.

Progress lives in the checkpoint, so a run that dies goes on where it was, and a
batch that is written again replaces itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import canonicalize
from ..sources.readers import numbered
from ..sources.sinks import commit_chunk


def json_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Streaming lines (value, _file, _block) of a drop folder.  A file is read whole by one batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def rows_of(lines: DataFrame, root: str, dataset_id: str) -> DataFrame:
    """A batch's non-blank lines as (dataset_id, source_row_id, raw); the id is file#line,
    so equal lines are rows of their own and a batch that runs again has the same ids."""
    n = numbered(lines, root).where(F.trim("value") != "")
    return n.select(F.lit(dataset_id).alias("dataset_id"), F.concat_ws("#", "source_path", (F.col("line") + 1).cast("string")).alias("source_row_id"), F.col("value").alias("raw"))


def ingest(spark: SparkSession, source: str, dataset_id: str, out: str, checkpoint: str, files_per_batch: int = 1000) -> int:
    """Canonicalize all new lines below source into Parquet chunks; the number of rows there now."""
    stream = json_lines(spark, source, files_per_batch)
    q = stream.writeStream.foreachBatch(lambda df, n: commit_chunk(canonicalize(rows_of(df, source, dataset_id)), out, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).count()


def dedup_stream(stream: DataFrame, ts: str, key: str, delay: str = "1 hour") -> DataFrame:
    """First row of each key within the watermark; state older than it is dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def best_stream(stream: DataFrame, ts: str, key: str, rank: Column, id_col: str, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """The best row (greatest rank) of each key in each window, and how many there were;
    a running aggregation, whose state is one row a key until its window closes."""
    s = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    g = s.groupBy(F.window(ts, window).alias("w"), key).agg(F.max_by(F.col(id_col), rank).alias("winner_id"), F.count(F.lit(1)).alias("copies"))
    return g.select(F.col("w.start").alias("window_start"), key, "winner_id", "copies")


def tumbling(events: DataFrame, ts: str, by: list[str], size: str = "1 hour", delay: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts by window; late rows within the delay are counted."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    e = events.withWatermark(ts, delay) if events.isStreaming else events
    return e.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, ts: str, by: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    e = events.withWatermark(ts, delay) if events.isStreaming else events
    s = e.groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return s.select(by, F.col("w.start").alias("session_start"), "n")
