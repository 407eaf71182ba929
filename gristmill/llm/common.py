"""Shared plumbing: scratch tables in the cluster's shared folder, skew-proof
joins and row removal.  Every helper works on columns it names itself, so extra
input columns never clash."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java regex class body.
WS = r"\x20\x09-\x0D"
#: A side is broadcast only when its counted rows are at most this many.
BROADCAST_ROWS = 500_000
#: A key is hot when it holds more than 1/HOT_SHARE of all rows, so at most
#: HOT_SHARE keys are hot and a table of them is safe to broadcast.
HOT_SHARE = 1024

_made: list[tuple[SparkSession, str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, or a local one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return "file:///tmp/checkpoints"


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _clean_up() -> None:
    for spark, path in _made:
        try:
            delete_path(spark, path)
        except Exception:  # the session may be gone at interpreter exit
            return


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.  This cuts the
    lineage, and the files outlive any executor."""
    spark = df.sparkSession
    if not _made:
        atexit.register(_clean_up)
    path = f"{scratch_root(spark)}/gristmill/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized frame that nothing needs any more."""
    for spark, path in list(_made):
        if any(path.rsplit("/", 1)[1] in f for f in df.inputFiles()[:1]):
            delete_path(spark, path)
            _made.remove((spark, path))


def slices(batches, rows: int = 1000):
    """Arrow batches of at most so many rows, whatever the session puts into one
    (64 MB by default, which Spark's own setting bounds)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column, null as empty, without decoding."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_of(name: str) -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def hot_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Left join on one key that may hold a third of all rows.  right has one row
    a key and the number of left rows of that key in column weight.  Keys over
    total / HOT_SHARE are at most HOT_SHARE many: they are broadcast, and only
    the others are shuffled.  left should be cheap to read twice."""
    limit = max(1, total // HOT_SHARE)
    hot = right.where(F.col(weight) > limit).withColumn("_gm_hot", F.lit(True))
    both = left.join(F.broadcast(hot), key, "left")
    met = both.where(F.col("_gm_hot").isNotNull()).drop("_gm_hot")
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right.where(F.col(weight) <= limit), key, "left")
    return met.unionByName(rest)


def keep_rows(docs: DataFrame, lost: DataFrame, twice: DataFrame, digest: Column, id_col: str = "doc_id") -> DataFrame:
    """docs without the rows that lost names by (_gm_id, _gm_h), h being digest of
    the row, and with those that twice names kept once each.  Both frames are
    counted first: one with few rows is broadcast, one with many is shuffled, and
    one with none (the common case for twice) costs nothing."""
    out = docs.withColumn("_gm_digest", digest)

    def split(df, keys, n, how):
        keys = keys.select("_gm_id", "_gm_h").distinct()
        keys = F.broadcast(keys) if n <= BROADCAST_ROWS else keys
        return df.join(keys, df[id_col].eqNullSafe(keys["_gm_id"]) & (df["_gm_digest"] == keys["_gm_h"]), how)

    if n := lost.count():
        out = split(out, lost, n, "left_anti")
    if n := twice.count():
        once = split(out, twice, n, "left_semi").dropDuplicates([id_col, "_gm_digest"])
        out = split(out, twice, n, "left_anti").unionByName(once)
    return out.select(*docs.columns)
