"""Mixing sources to target weights by the cube method.

A source's target over its size says how often each of its documents is taken:
so many whole times, and once more with the fraction left as an inclusion
probability.  The flight phase of the cube method decides the once-mores: it walks
the probabilities of a block of documents along directions in the null space of
the constraints (words and documents), so both totals stay as they are, until at
most two documents of the block are undecided.  Those of all blocks of a source
form new blocks, level after level, until a source has one block; the last one or
two documents land on the rounding nearest to both totals.

Blocks hold BLOCK documents of one source at most on average, dealt by a hash, so
a source that holds a third of the corpus is many blocks.  All randomness is a
hash of doc_id, so reruns agree.  Null and wordless texts have size 0 and take 0
words; a null source is a source of its own, the last; repeated rows are
documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WS, hot_join, materialize, text_of

WEIGHTS, MOST = (1, 2, 3), 3
#: Mean documents of a block.
BLOCK = 192
EPS = 1e-9


def flight(p: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """The flight phase: probabilities of which at most two are still between 0
    and 1, with the sums of p and of p * sizes unchanged."""
    p = p.copy()
    open_ = [i for i in range(len(p)) if EPS < p[i] < 1 - EPS]
    p[[i for i in range(len(p)) if not EPS < p[i] < 1 - EPS]] = np.round(p[[i for i in range(len(p)) if not EPS < p[i] < 1 - EPS]])
    held, rest = open_[:3], open_[3:]
    rest.reverse()
    values = p.tolist()
    size = sizes.tolist()
    draw = draws.tolist()
    turn = 0
    while len(held) == 3:
        a, b, c = held
        # the direction with u_a + u_b + u_c = 0 and its size-weighted sum 0
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if u == (0, 0, 0):
            u = (1, -1, 0)
        up = min((1 - values[i]) / x if x > 0 else values[i] / -x for i, x in zip(held, u, strict=True) if x)
        down = min(values[i] / x if x > 0 else (1 - values[i]) / -x for i, x in zip(held, u, strict=True) if x)
        step = up if draw[turn % len(draw)] * (up + down) < down else -down
        turn += 1
        for i, x in zip(held, u, strict=True):
            values[i] += step * x
            if values[i] <= EPS:
                values[i] = 0.0
            elif values[i] >= 1 - EPS:
                values[i] = 1.0
        held = [i for i in held if 0 < values[i] < 1]
        while len(held) < 3 and rest:
            held.append(rest.pop())
    return np.array(values)


def land(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Round the one or two open probabilities, nearest to the sum of p * sizes
    and then of p; of equals, the first in binary order."""
    p = p.copy()
    open_ = [i for i in range(len(p)) if EPS < p[i] < 1 - EPS]
    best = None
    for pick in range(1 << len(open_)):
        take = [(pick >> k) & 1 for k in range(len(open_))]
        words = abs(sum((t - p[i]) * sizes[i] for t, i in zip(take, open_, strict=True)))
        docs = abs(sum(t - p[i] for t, i in zip(take, open_, strict=True)))
        if best is None or (words, docs) < best[0]:
            best = ((words, docs), take)
    for t, i in zip(best[1] if best else [], open_, strict=True):
        p[i] = t
    return np.round(p) if best else p


def _fly(table: pa.Table) -> pa.Table:
    t = table.sort_by([("draw", "ascending"), ("id", "ascending"), ("size", "ascending"), ("uid", "ascending")])
    sizes = t["size"].to_numpy().astype(np.float64)
    draws = (t["draw"].to_numpy().view(np.uint64) >> np.uint64(11)).astype(np.float64) / 2.0**53
    p = flight(t["p"].to_numpy(), sizes, draws)
    if t["blocks"][0].as_py() == 1:
        p = land(p, sizes)
    return t.set_column(t.schema.get_field_index("p"), "p", pa.array(p))


def targets(sources: DataFrame) -> DataFrame:
    """sources (source, source_size, n) plus target: weights 1, 2, 3 repeating by
    code point order, null last, and no target above MOST times its source's
    size.  The shared rate is found from prefix sums in the order in which
    sources reach their cap, over one row a source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int")).cast("double"))
    s = s.withColumns({"cap": (MOST * F.col("source_size")).cast("double"), "total": F.sum("source_size").over(W.partitionBy()).cast("double")})
    caps = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    s = s.withColumns({"before": F.coalesce(F.sum("cap").over(caps.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)), "after": F.sum("w").over(caps.rowsBetween(0, W.unboundedFollowing))})
    s = s.withColumn("rate", (F.col("total") - F.col("before")) / F.col("after"))
    # the first source in this order whose cap is not below its share sets the rate for all after it
    s = s.withColumn("fits", F.col("rate") <= F.col("cap") / F.col("w"))
    s = s.withColumn("shared", F.first(F.when(F.col("fits"), F.col("rate")), ignorenulls=True).over(caps.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return s.select("source", "source_size", "n", F.least("cap", F.coalesce(F.col("shared") * F.col("w"), F.col("cap"))).alias("target"))


def sizes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.regexp_count(text_of(text_col), F.lit(f"[^{WS}]+")).cast("long").alias("size"), F.xxhash64(text_of(text_col)).alias("h"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: id_col, h (xxhash64 of the text), size, source_size,
    target (of its source), taken (words) and copies."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key")
    rows = materialize(sizes_of(docs, id_col, text_col, source_col).withColumn("uid", F.monotonically_increasing_id()).withColumn("key", key), "sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    sources = materialize(sources.withColumn("key", key).drop("source"), "targets")
    head = sources.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rate = F.least(rate, F.lit(float(MOST)))
    rate = F.when(F.abs(rate - F.round(rate)) < EPS, F.round(rate)).otherwise(rate)
    joined = hot_join(rows, sources, "key", "n", head["total"] or 0).withColumn("rate", rate)
    # Equal rows draw alike; uid orders them only among themselves.
    joined = joined.withColumns({"whole": F.floor("rate"), "p": F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(F.lit(0.0)), "draw": F.xxhash64("id", "h", "size")})
    done, left, level = [], (head["most"] or 0), 0
    fractional = joined
    while True:
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("long")
        dealt = fractional.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("draw", F.lit(level)), F.col("blocks")))
        flown = materialize(dealt.groupBy("key", "block").applyInArrow(_fly, dealt.schema), f"flight{level}")
        open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
        done.append(flown.where(~open_))
        if left <= BLOCK:
            break
        fractional = flown.where(open_)
        counts = fractional.groupBy("key").count()
        most = counts.agg(F.max("count")).first()[0]
        if not most:
            break
        left, level = most, level + 1
        fractional = hot_join(fractional.drop("n"), materialize(counts.withColumnRenamed("count", "n"), "open"), "key", "n", fractional.count())
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    copies = (F.col("whole") + F.round("p")).cast("long")
    return every.select(F.col("id").alias(id_col), "h", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long").alias("copies"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with its own
    columns.  Documents are told apart by id and text; rows equal in both are
    taken as often as all of them together."""
    made = mix(docs, id_col, text_col, source_col)
    taken = materialize(made.groupBy(F.col(id_col).alias("_gm_id"), F.col("h").alias("_gm_h")).agg(F.sum("copies").alias("_gm_sum"), F.count(F.lit(1)).alias("_gm_rows")), "copies")
    from .common import BROADCAST_ROWS

    small = taken.count() <= BROADCAST_ROWS
    taken = F.broadcast(taken) if small else taken
    marked = docs.withColumn("_gm_hash", F.xxhash64(text_of(text_col)))
    joined = marked.join(taken, marked[id_col].eqNullSafe(taken["_gm_id"]) & (marked["_gm_hash"] == taken["_gm_h"]))
    one = joined.where("_gm_rows = 1")
    rows = one.withColumn("_gm_copy", F.explode(F.array_repeat(F.lit(0), F.col("_gm_sum").cast("int"))))
    many = joined.where("_gm_rows > 1")
    many = many.dropDuplicates([id_col, "_gm_hash"]).withColumn("_gm_copy", F.explode(F.array_repeat(F.lit(0), F.col("_gm_sum").cast("int"))))
    return rows.select(*docs.columns).unionByName(many.select(*docs.columns))
