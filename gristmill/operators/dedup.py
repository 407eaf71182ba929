"""Keep-best exact dedup, SimHash edges by banding, and greedy near dedup."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hashing
from ..functions.text import given


def winner_rank(order_col: str = "seq") -> Column:
    """Greater is better: revision known, license known, schema complete, quality,
    dataset, row id; of equals the row that comes first."""
    known = lambda c: (given(c) != "").cast("int") * (given(c) != "unknown").cast("int")
    parts = [known("source_revision"), known("license_raw"), F.coalesce(F.col("schema_complete").cast("int"), F.lit(0)), F.coalesce(F.col("quality_score").cast("double"), F.lit(0.0)), given("source_dataset"), given("source_row_id"), -F.col(order_col)]
    return F.struct(*[p.alias(f"_{i}") for i, p in enumerate(parts)])


def exact_deduplicate(records: DataFrame, order_col: str = "seq", id_col: str = "record_id") -> DataFrame:
    """Eligible records plus duplicate_cluster, copies, winner_id, is_winner and
    duplicate_of (null for winners): of each content_hash the record of the best
    winner_rank stays.  The winner is one aggregation that combines on the map side;
    its table is joined back by AQE, which splits skewed hashes."""
    eligible = records.where(F.coalesce(F.col("eligibility"), F.lit(False)))
    best = eligible.groupBy(F.col("content_hash").alias("_h")).agg(F.max_by(F.col(id_col), winner_rank(order_col)).alias("winner_id"), F.count(F.lit(1)).alias("copies"))
    out = eligible.join(best, F.col("content_hash") == F.col("_h")).drop("_h")
    won = F.col("winner_id") == F.col(id_col)
    return out.withColumns({"duplicate_cluster": F.concat(F.lit("exact:"), F.col("content_hash")), "is_winner": won, "duplicate_of": F.when(~won, F.col("winner_id"))})


def keep_best(df: DataFrame, key: str, best: list[tuple[str, bool]], id_col: str) -> DataFrame:
    """df plus winner_id and is_winner.  best names the ranking columns, True for
    descending.  The winner is one aggregation with partial sums on the map side;
    a key that a third of the rows share costs its reducer one row a task."""
    rank = F.struct(*[(F.col(c) if desc else -F.col(c)).alias(f"_{i}") for i, (c, desc) in enumerate(best)])
    winners = df.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.col(id_col), rank).alias("winner_id"), F.count(F.lit(1)).alias("copies"))
    joined = df.join(winners, df[key] == F.col("_key"), "left").drop("_key")
    return joined.withColumn("is_winner", F.col("winner_id") == F.col(id_col))


def running_winner(df: DataFrame, key: str, rank: list[Column], order: str, id_col: str) -> DataFrame:
    """df plus duplicate_of: the best row of the key among the rows before it, null for the first."""
    before = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    best = F.max(F.struct(*[c.alias(f"_r{i}") for i, c in enumerate(rank)], (-F.col(order)).alias("_o"), F.col(id_col).alias("id"))).over(before)
    return df.withColumn("duplicate_of", best["id"])


def simhash(df: DataFrame, id_col: str, text: Column, **how) -> DataFrame:
    """(id_col, simhash) of each row: hashing.simhash of the text."""
    return df.select(F.col(id_col), hashing.simhash(given(text), **how).alias("simhash"))


def simhash_text(df: DataFrame, id_col: str, text: Column, digest: str = "blake2b") -> DataFrame:
    """The published document signature: NFKC, the ends of texts over 4,096 characters, 256 grams, BLAKE2b."""
    return simhash(df, id_col, text, nfkc=True, window=4096, digest=digest, of_empty=True)


def near_edges(sigs: DataFrame, id_col: str, limit: int = 3) -> DataFrame:
    """Pairs (sig_a, sig_b) of distinct signatures at most `limit` bits apart,
    sig_a < sig_b.  They meet on three of six blocks, about 32 bits, of which some
    three are untouched, and count where the first three meet.  Copies of a
    signature are one row here."""
    if limit > 3:
        raise ValueError("three of six blocks find pairs up to three bits apart")
    distinct = sigs.select("simhash").distinct()
    keyed = distinct.select("simhash", F.explode(hashing.block_keys("simhash")).alias("k")).select("simhash", "k.triple", "k.value")
    # Spark takes the keys for as small as the signatures they are made of, and would broadcast them.
    keyed = keyed.hint("merge")
    other = keyed.select(F.col("simhash").alias("sig_b"), "triple", "value")
    pairs = keyed.withColumnRenamed("simhash", "sig_a").join(other, ["triple", "value"]).where("sig_a < sig_b")
    return pairs.where((hashing.hamming("sig_a", "sig_b") <= limit) & hashing.first_triple("sig_a", "sig_b", "triple")).select("sig_a", "sig_b", hashing.hamming("sig_a", "sig_b").alias("distance"))


def greedy_near(sigs: DataFrame, id_col: str, limit: int = 3) -> DataFrame:
    """Greedy near dedup in id order: a row is accepted unless an accepted earlier
    row is within `limit` bits.  Returns id_col, accepted and duplicate_of (the
    earliest accepted row within reach).

    Rows of one signature stand and fall with their first, so the greedy runs over
    signatures in the order of their first ids: each round accepts those without
    an undecided or accepted earlier neighbour and rejects those with an accepted
    one, until none is undecided.  Only signatures with a neighbour take part.
    Rounds are checkpointed to the shared folder, and all tables, which grow with
    the input, meet in merge joins: a broadcast would gather them on the driver."""
    spark = sigs.sparkSession
    ensure_checkpoint_dir(spark)
    sigs = sigs.select(id_col, "simhash").checkpoint()  # read three times below
    first = sigs.groupBy("simhash").agg(F.min(id_col).alias("pos")).checkpoint()
    a, b = first.select(F.col("simhash").alias("sig_a"), F.col("pos").alias("pa")), first.select(F.col("simhash").alias("sig_b"), F.col("pos").alias("pb"))
    edges = near_edges(sigs, id_col, limit).join(a.hint("merge"), "sig_a").join(b.hint("merge"), "sig_b").select(F.least("pa", "pb").alias("u"), F.greatest("pa", "pb").alias("v")).checkpoint()
    state = edges.select(F.explode(F.array("u", "v")).alias("pos")).distinct().select("pos", F.lit(0).alias("s")).checkpoint()  # 0 undecided, 1 accepted, 2 rejected
    while state.where("s = 0").limit(1).count():
        seen = edges.join(state.select(F.col("pos").alias("u"), F.col("s").alias("su")).hint("merge"), "u").groupBy("v").agg(F.max((F.col("su") == 1).cast("int")).alias("hit"), F.max((F.col("su") == 0).cast("int")).alias("open"))
        nxt = state.join(seen.hint("merge"), state["pos"] == seen["v"], "left")
        state = nxt.select("pos", F.when(F.col("s") != 0, F.col("s")).when(F.col("hit") == 1, 2).when(F.col("open") == 1, 0).otherwise(1).alias("s")).checkpoint()
    reach = edges.join(state.where("s = 1").select(F.col("pos").alias("u")).hint("merge"), "u").groupBy("v").agg(F.min("u").alias("by"))
    verdict = first.join(state.hint("merge"), "pos", "left").join(reach.hint("merge"), F.col("pos") == F.col("v"), "left").select("simhash", "pos", F.coalesce("s", F.lit(1)).alias("s"), "by")
    joined = sigs.select(id_col, "simhash").join(verdict.hint("merge"), "simhash")
    accepted = (F.col("s") == 1) & (F.col(id_col) == F.col("pos"))
    return joined.select(id_col, accepted.alias("accepted"), F.when(~accepted, F.when(F.col("s") == 1, F.col("pos")).otherwise(F.col("by"))).alias("duplicate_of"))


def ensure_checkpoint_dir(spark) -> None:
    """spark.checkpoint.dir, which the session applies itself; a local folder only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if named := spark.conf.get("spark.checkpoint.dir", None):
            sc.setCheckpointDir(named)
            return
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(f"/tmp/checkpoints/{uuid.uuid4().hex}")
