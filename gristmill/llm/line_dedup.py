"""Line dedup with two Bloom filters.

A first pass over all texts sends the 64-bit hashes of each document's line keys to
owners, whose once-seen filters tell which were met before; these make the
twice-seen filter (see ``blooms``).  A second pass sends only keys that pass the
twice-seen filter through a shuffle, where whole keys are counted exactly and the
largest doc_id is chosen.  The third pass rewrites the texts.

Filters are sized from what they hold.  A key on a third of all lines costs the
first shuffle a row or two for 1,000 documents, and the second one a row a task.
Null texts are one empty line.  Very long texts are read whole, and one line may be
any length.  Rows that repeat a doc_id are documents of their own: each holds its
lines, and all rows of the largest doc_id keep theirs.  Rows with a null doc_id
never keep such a line while another doc_id holds it.  An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blooms
from .common import discard, materialize, slices, text_of, utf8

LEAST_CHARS, LEAST_DOCS = 20, 3
#: The table of repeated lines is broadcast up to so many bytes, and joined beyond.
BROADCAST_BYTES = 48 << 20
STRIP = b" \t\n\x0b\x0c\r"


def key_of(line: bytes) -> bytes:
    return line.strip(STRIP).lower()


def long_enough(key: bytes) -> bool:
    """At least LEAST_CHARS code points."""
    return len(key) >= LEAST_CHARS and (len(key) >= 4 * LEAST_CHARS or len(key.decode("utf-8", "replace")) >= LEAST_CHARS)


def keys_of(text: bytes) -> set[bytes]:
    return {k for line in text.split(b"\n") if long_enough(k := key_of(line))}


def hashes_of(keys) -> np.ndarray:
    from xxhash import xxh3_64_digest

    return np.frombuffer(b"".join(map(xxh3_64_digest, keys)), ">i8").astype(np.int64)


def _hashes(batches):
    """A row for each key of 1,000 documents, and a second one if two of them hold it."""
    for batch in slices(batches):
        seen: set[bytes] = set()
        again: set[bytes] = set()
        for text in utf8(batch.column("text")):
            keys = keys_of(text)
            again |= keys & seen
            seen |= keys
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(hashes_of([*seen, *again]))], ["h"])


def suspects(slim: DataFrame) -> DataFrame:
    """(id, key) of the keys that more than one document may hold, a row for each
    document and key.  slim has columns id and text."""
    # a key and its line end take LEAST_CHARS + 1 bytes at least
    most = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    repeated = materialize(blooms.repeats(slim.select("text").mapInArrow(_hashes, "h long"), most // (LEAST_CHARS + 1)), "repeated-hashes")
    log2, bits = blooms.twice_seen(repeated)
    discard(repeated)
    shared = slim.sparkSession.sparkContext.broadcast(bits)

    def task(batches):
        twice = log2, np.frombuffer(shared.value, np.uint8)
        for batch in slices(batches):
            ids, keys = [], []
            for i, text in enumerate(utf8(batch.column("text"))):
                own = list(keys_of(text))
                keys += own
                ids += [i] * len(own)
            if keys:
                hit = np.flatnonzero(blooms.passes(twice, hashes_of(keys)))
                if len(hit):
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array([ids[i] for i in hit], pa.int64())), pa.array([keys[i] for i in hit], pa.binary())], ["id", "key"])

    return slim.mapInArrow(task, T.StructType([slim.schema["id"], T.StructField("key", T.BinaryType())]))


def repeated_lines(slim: DataFrame) -> DataFrame:
    """(key, last) of every key in at least LEAST_DOCS documents: last is the
    largest id that holds it."""
    return suspects(slim).groupBy("key").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= LEAST_DOCS).select("key", "last")


OUT = "n_lines long, n_dropped long, kept_sha256 string, kept string"


def _rewrite(text: bytes, doc_id, last_of) -> tuple[int, int, bytes]:
    """Lines, dropped lines and kept text; last_of(key) is a 1-tuple or None."""
    lines, kept = text.split(b"\n"), []
    for line in lines:
        if len(line) >= LEAST_CHARS:
            k = key_of(line)
            if long_enough(k) and (hit := last_of(k)) is not None and hit[0] != doc_id:
                continue
        kept.append(line)
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _emit(ids, rows, kind, with_text):
    n, dropped, kept = zip(*rows, strict=True) if rows else ((), (), ())
    cols = [ids, pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
    names = ["id", "n_lines", "n_dropped", "kept_sha256"]
    if with_text:
        cols.append(pa.array([x.decode("utf-8", "replace") for x in kept], pa.string()))
        names.append("kept")
    return pa.RecordBatch.from_arrays(cols, names)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row a document: id_col, n_lines, n_dropped, kept_sha256 and, with
    with_text, kept (the text without its dropped lines)."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    lines = materialize(repeated_lines(slim), "lines")
    fields = [slim.schema["id"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    schema = T.StructType(fields + ([T.StructField("kept", T.StringType())] if with_text else []))
    size = lines.agg(F.sum(F.length("key") + 150)).first()[0] or 0
    if size <= broadcast_bytes:
        table = spark.sparkContext.broadcast({bytes(r["key"]): (r["last"],) for r in lines.toLocalIterator()})

        def task(batches):
            get = table.value.get
            for batch in slices(batches):
                ids = batch.column("id")
                rows = [_rewrite(t, i, get) for t, i in zip(utf8(batch.column("text")), ids.to_pylist(), strict=True)]
                yield _emit(ids, rows, fields[0], with_text)

        return slim.mapInArrow(task, schema).withColumnRenamed("id", id_col)
    return _joined(slim, lines, schema, fields, with_text).withColumnRenamed("id", id_col)


def _joined(slim: DataFrame, lines: DataFrame, schema, fields, with_text) -> DataFrame:
    """The same where the table of repeated lines is too large to broadcast:
    occurrences meet it in a join, and each document gets its own part of it."""
    from .common import hot_join

    def occurrences(batches):
        for batch in slices(batches):
            ids, keys = [], []
            for i, text in enumerate(utf8(batch.column("text"))):
                own = list(keys_of(text))
                keys += own
                ids += [i] * len(own)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(ids, pa.int64())), batch.column("h").take(pa.array(ids, pa.int64())), pa.array(keys, pa.binary())], ["id", "h", "key"])

    hashed = slim.withColumn("h", F.xxhash64("text"))
    every = materialize(hashed.mapInArrow(occurrences, T.StructType([slim.schema["id"], T.StructField("h", T.LongType()), T.StructField("key", T.BinaryType())])), "occurrences")
    counts = every.groupBy("key").count()
    table = materialize(lines.join(counts, "key"), "counted-lines")
    total = table.agg(F.sum("count")).first()[0] or 0
    met = hot_join(every.join(table.select("key"), "key", "left_semi"), table, "key", "count", total)
    # one document's own lines: distinct, so that equal rows do not add up
    drops = met.where(~F.col("id").eqNullSafe(F.col("last"))).groupBy(F.col("id").alias("i2"), F.col("h").alias("h2")).agg(F.collect_set("key").alias("keys"))
    rows = hashed.join(drops, hashed["id"].eqNullSafe(drops["i2"]) & (hashed["h"] == drops["h2"]), "left").select("id", "text", "keys")

    def task(batches):
        for batch in slices(batches):
            ids = batch.column("id")
            made = []
            for text, keys in zip(utf8(batch.column("text")), batch.column("keys").to_pylist(), strict=True):
                mine = dict.fromkeys(keys or (), (object(),))
                made.append(_rewrite(text, None, mine.get))
            yield _emit(ids, made, fields[0], with_text)

    return rows.mapInArrow(task, schema)
