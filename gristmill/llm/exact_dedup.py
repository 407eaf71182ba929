"""Exact dedup by a Golomb-coded fingerprint exchange.

Each block of rows (a sender) sorts short fingerprints of its texts and sends
them, Golomb-Rice coded, to the owners of fingerprint ranges.  An owner merges
what it gets and answers each sender with a bitmap of the fingerprints that
others hold too.  Only rows so marked are suspects; their texts alone are
shuffled and compared byte by byte.

A sender sends each distinct fingerprint once, so a text that fills a third of
the corpus costs an owner one entry a sender.  Null texts count as empty; rows
that repeat a doc_id are rows of their own, and of equal rows one stays; a null
doc_id sorts below all others.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, hot_join, keep_rows, materialize, text_of

#: Rows of one sender block; a task with more rows makes several.
BLOCK_ROWS = 1 << 18
#: Mean fingerprints of an owner, and most owners.
OWNER_ROWS, MAX_OWNERS_LOG2 = 1 << 14, 12
#: Bits of a fingerprint beyond log2 of the number of rows: one unique text in
#: 2^SLACK_BITS becomes a suspect for nothing.
SLACK_BITS = 8


def rice_encode(values: np.ndarray, k: int) -> bytes:
    """Sorted distinct uint64 values as Golomb-Rice codes of their gaps."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    q = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(q + 1 + k)
    bits = np.zeros(int(ends[-1]), np.uint8)
    # unary part: q ones and a zero; the ones are filled by a difference array
    starts = ends - (q + 1 + k)
    step = np.zeros(len(bits) + 1, np.int8)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + q, -1)
    bits[:] = np.cumsum(step[:-1])
    for j in range(k):
        bits[starts + q + 1 + j] = ((gaps >> np.uint64(k - 1 - j)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).tobytes()


def rice_decode(data: bytes, n: int, k: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    stops = np.where(bits == 0, np.arange(len(bits)), len(bits))
    stops = np.minimum.accumulate(stops[::-1])[::-1].tolist()  # the first zero at or after each bit
    at, q, pos = np.empty(n, np.int64), np.empty(n, np.int64), 0
    for i in range(n):
        stop = stops[pos]
        q[i], at[i] = stop - pos, stop + 1
        pos = stop + 1 + k
    gaps = q.astype(np.uint64) << np.uint64(k)
    for j in range(k):
        gaps |= bits[at + j].astype(np.uint64) << np.uint64(k - 1 - j)
    return np.cumsum(gaps, dtype=np.uint64)


def rice_parameter(universe: float, n: int) -> int:
    return max(0, int(np.floor(np.log2(max(1.0, universe / max(1, n) * 0.69)))))


def _sender(bits: int, owner_bits: int):
    """Task function: blocks of (doc_id, sha, h) to one row an owner."""

    def send(batches):
        import pyspark

        pid, k, held, n = pyspark.TaskContext.get().partitionId(), 0, [], 0

        def block(tables, number):
            t = pa.Table.from_batches(tables)
            h = t["h"].to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            order = np.argsort(h, kind="stable")
            h, t = h[order], t.take(pa.array(order))
            own = (h >> np.uint64(bits - owner_bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(h)], strict=True):
                values, counts = np.unique(h[a:b], return_counts=True)
                low = values - (np.uint64(own[a]) << np.uint64(bits - owner_bits))
                rice = rice_parameter(2.0 ** (bits - owner_bits), len(low))
                part = t.slice(a, b - a)
                as_list = lambda name, kind: pa.array([part[name].to_pylist()], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], kind) for x, kind in ((number, pa.int64()), (int(own[a]), pa.int64()), (len(low), pa.int32()), (rice, pa.int32()), (rice_encode(low, rice), pa.binary()), (counts.astype("<i4").tobytes(), pa.binary()))]
                    + [as_list("id", part["id"].type), as_list("sha", part["sha"].type)],
                    ["block", "owner", "n", "rice", "codes", "counts", "ids", "shas"],
                )

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield from block(held, (pid << 24) | k)
                held, n, k = [], 0, k + 1
        if n:
            yield from block(held, (pid << 24) | k)

    return send


def _own(key, table):
    """An owner's answer to each sender: bit i is set if another sender holds its i-th fingerprint."""
    rows = table.to_pylist()
    values = [rice_decode(r["codes"], r["n"], r["rice"]) for r in rows]
    every, inverse, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    flags, at, maps = counts[inverse] > 1, 0, []
    for v in values:
        maps.append(np.packbits(flags[at : at + len(v)]).tobytes())
        at += len(v)
    return pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()), "owner": pa.array([r["owner"] for r in rows], pa.int64()), "shared": pa.array(maps, pa.binary())})


def _marked(batches):
    """Rows of each sender's message with its own verdict and the owner's."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            counts = np.frombuffer(row["counts"].as_py(), "<i4")
            shared = np.unpackbits(np.frombuffer(row["shared"].as_py(), np.uint8))[: len(counts)].astype(bool)
            suspect = np.repeat(shared | (counts > 1), counts)
            yield pa.RecordBatch.from_arrays([row["ids"].values, row["shas"].values, pa.array(suspect)], ["id", "sha", "suspect"])


def fingerprint_exchange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, sha (hex SHA-256 of the text) and suspect.  Equal
    texts are always suspects; few others are."""
    total = docs.count()
    owner_bits = min(MAX_OWNERS_LOG2, max(0, int(np.ceil(np.log2(max(1, total / OWNER_ROWS))))))
    bits = min(56, max(owner_bits + 1, int(np.ceil(np.log2(max(2, total)))) + SLACK_BITS))
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha"), F.xxhash64(text).alias("h"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("owner", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("rice", T.IntegerType()),
        T.StructField("codes", T.BinaryType()), T.StructField("counts", T.BinaryType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("shas", T.ArrayType(T.StringType())),
    ])
    sent = materialize(rows.mapInArrow(_sender(bits, owner_bits), schema), "exchange")
    answers = sent.select("block", "owner", "n", "rice", "codes").groupBy("owner").applyInArrow(_own, "block long, owner long, shared binary")
    flagged = sent.join(answers, ["block", "owner"]).select("counts", "ids", "shas", "shared")
    out = T.StructType([T.StructField("id", kind), T.StructField("sha", T.StringType()), T.StructField("suspect", T.BooleanType())])
    return flagged.mapInArrow(_marked, out)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id_col, keep_id, group_size, kept, text_sha256."""
    marked = materialize(fingerprint_exchange(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "marked")
    suspects = marked.where("suspect")
    n = suspects.count()
    ids = suspects.select(F.col("id").alias("_gm_id")).distinct()
    ids = F.broadcast(ids) if n <= BROADCAST_ROWS else ids
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # Byte verification: grouping compares whole texts; equal ones meet on the map side first.
    verified = (
        slim.join(ids, slim["id"].eqNullSafe(ids["_gm_id"]), "left_semi")
        .groupBy("text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
        .select(F.sha2("text", 256).alias("sha"), "keep_id", "size")
    )
    last = suspects.groupBy("sha").agg(F.max(F.struct("id", "uid"))["uid"].alias("keep_uid"))
    groups = materialize(verified.join(last, "sha"), "groups")
    joined = hot_join(suspects, groups, "sha", "size", n)
    shape = lambda df, keep, size, kept: df.select(F.col("id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))
    single = shape(marked.where("not suspect"), F.col("id"), F.lit(1).cast("long"), F.lit(True))
    return single.unionByName(shape(joined, F.col("keep_id"), F.col("size"), F.col("uid") == F.col("keep_uid")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the copies, with their own columns."""
    groups = materialize(exact_groups(docs, id_col, text_col), "exact")
    gone = groups.where("not kept").select(F.col(id_col).alias("_gm_id"), F.col("text_sha256").alias("_gm_h"), F.col("keep_id").eqNullSafe(F.col(id_col)).alias("same"))
    return keep_rows(docs, gone.where("not same"), gone.where("same"), F.sha2(text_of(text_col), 256), id_col)
