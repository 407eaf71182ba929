"""SimHash near-dedup by a self-join of binary tries.

Every text gets a 64-bit SimHash of its word shingles.  The distinct fingerprints
form a trie; the join walks pairs of its nodes together, adds up the bits in which
the two paths differ, and prunes a pair as soon as the Hamming budget is spent.

Two tries share the work: of two fingerprints at most 4 bits apart, either the
first halves differ in at most 2 bits, or the second halves in at most 1.  So one
trie reads the first half first with a budget of 2 there, the other the second
half first with a budget of 1, and each prunes far earlier than one trie could.

The node pairs at a depth that grows with the number of fingerprints are rows of a
table, each walked on by one task.  A node with too many fingerprints is cut into
chunks, and each pair of chunks is a row.  A row returns a spanning forest of its
links, not the links, so a group of near copies costs as many rows as it has
fingerprints.  Components come from alternating large-star and small-star steps.

Null and wordless texts have the fingerprint 0.  Equal rows have equal results; a
null doc_id counts for a component only if it has no other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, discard, hot_join, keep_rows, materialize, slices, text_of, utf8

SHINGLE, SEED, BUDGET = 4, 42, 4
#: Budgets within the first 32 bits of each trie, by rotation.
HALF_BUDGETS = (2, 1)
#: Mean fingerprints of a node of the table, and most of one chunk.
NODE_ROWS, CHUNK_ROWS = 1024, 4096
#: Node pairs of the walk, and candidate pairs, that are in memory at once.
FRONTIER, CANDIDATES = 1 << 18, 1 << 20
#: Node pairs of so few comparisons are compared outright.
LEAF = 24


def simhash(text: bytes) -> int:
    """SimHash of one UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxh64_intdigest(b" ".join(words), SEED)
    votes, n = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for at in range(0, n, 32768):
        part = words[at : at + 32768 + SHINGLE - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(SHINGLE)], strict=False))
        h = np.array([xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(len(h), 64)
        whole = len(h) // 255 * 255  # bytes hold sums of up to 255 rows
        votes += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64) + bits[whole:].sum(0, dtype=np.uint8)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, h (xxhash64 of the text) and fp of every row."""
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("h"), text_of(text_col).alias("text"))

    def task(batches):
        for batch in slices(batches):
            fps = np.array([simhash(x) for x in utf8(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), pa.array(fps, pa.int64())], ["id", "h", "fp"])

    return slim.mapInArrow(task, T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("h", T.LongType()), T.StructField("fp", T.LongType())]))


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component, for nodes 0 to n - 1."""
    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        open_ = a != b
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (further := label[label]).tobytes() != label.tobytes():
            label = further
    return label


def _expand(la, ha, lb, hb):
    """All index pairs of node pairs, CANDIDATES at a time."""
    na, nb = ha - la, hb - lb
    size = na * nb
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CANDIDATES, "right")))
        s = size[at:stop]
        k = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
        width = np.repeat(nb[at:stop], s)
        yield np.repeat(la[at:stop], s) + k // width, np.repeat(lb[at:stop], s) + k % width
        at = stop


def walk(a: np.ndarray, b: np.ndarray, same: bool, depth: int, half_budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the sorted uint64 arrays a and b (same: b is a), as a spanning
    forest: indices into a, then b if not same.  All of a share their first depth
    bits, and all of b theirs."""
    start = 0 if same else len(a)
    label = np.arange(start + len(b))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def settle():
        nonlocal label, found, held
        if found:
            u, v = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = label != np.arange(len(label))
            label = components(len(label), np.concatenate([u, np.flatnonzero(keep)]), np.concatenate([v, label[keep]]))
            found, held = [], 0

    def compare(la, ha, lb, hb):
        nonlocal held
        for i, j in _expand(la, ha, lb, hb):
            if same:
                i, j = i[i < j], j[i < j]
            open_ = label[i] != label[j + start]  # linked already: nothing new to learn
            i, j = i[open_], j[open_]
            near = np.bitwise_count(a[i] ^ b[j]) <= BUDGET
            if near.any():
                found.append((i[near], j[near] + start))
                held += int(near.sum())
                if held >= CANDIDATES // 4:
                    settle()

    one = np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)])
    spent = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    stack = [(depth, *one, np.array([spent]))]
    ones: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    while stack:
        d, la, ha, lb, hb, err = stack.pop()
        small = ((ha - la) * (hb - lb) <= LEAF) | (d == 64)
        if small.any():
            compare(la[small], ha[small], lb[small], hb[small])
            la, ha, lb, hb, err = (x[~small] for x in (la, ha, lb, hb, err))
        if not len(la):
            continue
        if len(la) > FRONTIER:
            cut = len(la) // 2
            stack += [(d, *(x[:cut] for x in (la, ha, lb, hb, err))), (d, *(x[cut:] for x in (la, ha, lb, hb, err)))]
            continue
        if d not in ones:
            bit = np.uint64(63 - d)
            ones[d] = tuple(np.concatenate([[0], np.cumsum((x >> bit) & np.uint64(1)).astype(np.int64)]) for x in (a, b))
        ca, cb = ones[d]
        ma, mb = ha - (ca[ha] - ca[la]), hb - (cb[hb] - cb[lb])
        own = (la == lb) & (ha == hb) & same
        parts = ((la, ma, lb, mb, err, None), (ma, ha, mb, hb, err, None), (la, ma, mb, hb, err + 1, None), (ma, ha, lb, mb, err + 1, ~own))
        most = half_budget if d < 32 else BUDGET
        kept = []
        for pla, pha, plb, phb, e, extra in parts:
            ok = (pla < pha) & (plb < phb) & (e <= most)
            ok = ok if extra is None else ok & extra
            kept.append((pla[ok], pha[ok], plb[ok], phb[ok], e[ok]))
        stack.append((d + 1, *(np.concatenate(x) for x in zip(*kept, strict=True))))
    settle()
    other = np.flatnonzero(label != np.arange(len(label)))
    return label[other], other


def _walk_rows(half_budgets, depth):
    def task(batches):
        for batch in slices(batches, 64):
            for r, a, b, same in zip(batch.column("r").to_pylist(), batch.column("xs").to_pylist(), batch.column("ys").to_pylist(), batch.column("same").to_pylist(), strict=True):
                xs = np.sort(np.array(a, np.int64).view(np.uint64))
                ys = xs if same else np.sort(np.array(b, np.int64).view(np.uint64))
                u, v = walk(xs, ys, same, depth, half_budgets[r])
                if len(u):
                    nodes = xs if same else np.concatenate([xs, ys])
                    if r:
                        nodes = (nodes << np.uint64(32)) | (nodes >> np.uint64(32))
                    nodes = nodes.view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[u]), pa.array(nodes[v])], ["u", "v"])

    return task


def trie_links(fps: DataFrame) -> DataFrame:
    """Links (u, v) between the distinct fingerprints in column fp: a forest that
    connects exactly those that links within the budget connect."""
    total = fps.count()
    depth = max(0, int(np.ceil(np.log2(max(1, total / NODE_ROWS)))))
    swapped = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    both = fps.select(F.explode(F.array(F.struct(F.lit(0).alias("r"), F.col("fp").alias("x")), F.struct(F.lit(1).alias("r"), swapped.alias("x")))).alias("s")).select("s.*")
    both = both.withColumn("node", F.shiftrightunsigned("x", 64 - depth) if depth else F.lit(0).cast("long"))
    sizes = both.groupBy("r", "node").count().where(F.col("count") > CHUNK_ROWS).select("r", "node", F.ceil(F.col("count") / (CHUNK_ROWS // 2)).cast("long").alias("chunks"))
    sizes = materialize(sizes, "large-nodes")  # only nodes that are too large, at most total / CHUNK_ROWS
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    both = both.join(sizes, ["r", "node"], "left").withColumn("chunk", F.pmod(F.xxhash64("x"), F.coalesce("chunks", F.lit(1))))
    blocks = materialize(both.groupBy("r", "node", "chunk").agg(F.collect_list("x").alias("xs")), "blocks")
    nodes = blocks.groupBy("r", "node").agg((F.max("chunk") + 1).alias("chunks"))
    masks = [[sum(1 << k for k in c) for e in range(most + 1) for c in combinations(range(min(depth, 32)), e)] for most in HALF_BUDGETS]
    if depth > 32:
        raise ValueError("more than 2^42 fingerprints")
    mask = F.explode(F.when(F.col("r") == 0, F.array(*map(F.lit, masks[0])).cast("array<long>")).otherwise(F.array(*map(F.lit, masks[1])).cast("array<long>")))
    left = nodes.select("r", "node", "chunks", mask.alias("mask")).select("r", "node", "chunks", F.col("node").bitwiseXOR(F.col("mask")).alias("node2")).where("node <= node2")
    pairs = left.join(nodes.select("r", F.col("node").alias("node2"), F.col("chunks").alias("chunks2")), ["r", "node2"])
    pairs = pairs.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    pairs = pairs.withColumn("chunk2", F.explode(F.sequence(F.when(F.col("node") == F.col("node2"), F.col("chunk")).otherwise(F.lit(0).cast("long")), F.col("chunks2") - 1)))
    rows = pairs.select("r", "node", "chunk", "node2", "chunk2").join(blocks, ["r", "node", "chunk"])
    rows = rows.join(blocks.select("r", F.col("node").alias("node2"), F.col("chunk").alias("chunk2"), F.col("xs").alias("ys")), ["r", "node2", "chunk2"])
    rows = rows.select("r", "xs", F.when((F.col("node") != F.col("node2")) | (F.col("chunk") != F.col("chunk2")), F.col("ys")).otherwise(F.array().cast("array<long>")).alias("ys"), ((F.col("node") == F.col("node2")) & (F.col("chunk") == F.col("chunk2"))).alias("same"))
    links = materialize(rows.mapInArrow(_walk_rows(HALF_BUDGETS, depth), "u long, v long").distinct(), "links")
    return links


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (u, v), root being the least node of
    its component; links must be materialized."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
        total = least.agg(F.sum("n")).first()[0] or 0
        large = hot_join(both.where("v > u"), least, "u", "n", total).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialize(small, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(least)
        discard(large)
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = tuple(now)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id_col, h, fp, component_id (the smallest id that links
    reach from it), root (a fingerprint that names the component) and
    component_size in rows."""
    made = materialize(fingerprints(docs, id_col, text_col), "simhash")
    fps = materialize(made.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct-simhash")
    roots = connected(trie_links(fps))
    known = materialize(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    groups = known.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("size"))
    groups = materialize(groups, "components")
    total = known.count()
    named = hot_join(known, groups, "root", "m", total).select("fp", "n", "root", "component_id", "size")
    named = materialize(named, "named")
    total = named.agg(F.sum("n")).first()[0] or 0
    out = hot_join(made, named, "fp", "n", total)
    return out.select(F.col("id").alias(id_col), "h", "fp", "component_id", "root", F.col("size").alias("component_size"))


def hex_of(name: str):
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component, that of the least doc_id, and
    their own columns.  Where rows share that doc_id, the one of the least
    xxhash64 stays."""
    groups = materialize(near_groups(docs, id_col, text_col), "near")
    named = groups.where(F.col(id_col).eqNullSafe(F.col("component_id")) & (F.col("component_size") > 1))
    lost = groups.where(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_gm_id"), F.col("h").alias("_gm_h"))
    shared = named.groupBy(F.col(id_col).alias("id"), F.col("root").alias("of")).agg(F.min("h").alias("best"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = materialize(shared, "shared-ids")  # none where doc_id is unique
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    clash = named.join(shared, named[id_col].eqNullSafe(shared["id"]) & (named["root"] == shared["of"])).select(F.col(id_col).alias("_gm_id"), F.col("h").alias("_gm_h"), "best")
    lost = materialize(lost.unionByName(clash.where("_gm_h <> best").select("_gm_id", "_gm_h")), "lost")
    return keep_rows(docs, lost, clash.where("_gm_h = best").select("_gm_id", "_gm_h"), F.xxhash64(text_of(text_col)), id_col)
