"""LM scoring by a hashed maximum-entropy model.

The probability of a token is that of its class given the history, times that of
the token within its class given the history, and both are softmaxes.  The class is
a softmax over CLASSES classes.  Within a class the tokens are the leaves of a
binary tree, and each inner node is a softmax over its two sides.  The logits add up
one weight for each hashed feature of the history: for the class the last token, the
last two as a pair, and the token before the last (a skip feature); within the class
the last token with the node.  Features hash the bytes of
tokens, so the history knows every token, however rare.  All weights start where
the model is the unigram model; gradient steps move them.

Everything is learnt from training texts alone: counts, classes, trees, weights.
The model is as large as the training tokens ask, within documented bounds: HEAD
tokens have leaves of their own (a bounded table, broadcast), and all others, unknown
ones included, share leaves by the shape of their last bytes.  Their counts reach the
texts through a join, so the vocabulary may grow without bound.  Classes come from
what stands before a token: counts of preceding very frequent tokens, gathered from
all training texts, clustered by a mixture of multinomials.

Training is distributed and synchronous.  Texts are dealt to shards by hash, a shard
having about SHARD tokens at any input size.  In each of ROUNDS rounds its shards
start from the same weights, follow the gradient over their own texts in the order of
a hash, and the weights are averaged by how often each was touched.  So neither the
partitions of the input nor the number of executors change the model, and the longest
task does not grow.  Texts are scored in sparse numpy batches: a batch of tokens is a
list of weights to add, never a dense feature matrix.

Null and empty texts are one token, the end; a null id counts as a training text.
Repeated rows are scored alike.  Very long texts are read whole; a text is one
element of a batch.  Tokens of equal count are ordered by their bytes.  With no
training texts every token has the share of an unknown one; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from copy import copy
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, slices, text_of, utf8

FOLDS, HELD_OUT = 5, 1
#: Most tokens with leaves of their own, least training count of one, and leaves that all others share.
HEAD, LEAST, SHAPES = 1 << 18, 2, 1 << 10
#: Contexts that classes are made from, classes, and classes that the most frequent tokens have for themselves.
CONTEXTS, CLASSES, OWN = 48, 16, 2
#: Items that are clustered at once, and items of one block on its way between tasks.
BLOCK, ITEMS = 1 << 14, 1 << 11
#: Rounds of training, tokens of a shard, least shards.
ROUNDS, SHARD, SHARDS = 4, 1 << 22, 8
#: Rates of the gradient steps (class, tree), what their divisors start from, and tokens of one step.
RATE, TREE_RATE, PRIOR, TREE_PRIOR, STEP = 0.25, 0.5, 1.0, 4.0, 1 << 12
#: Rows of a class feature and weights of the tree: one for so many training tokens, between two powers of two.
ROW_TOKENS, ROW_LOG2 = 1 << 7, (12, 14)
SLOT_TOKENS, SLOT_LOG2 = 1 << 1, (16, 21)
#: Class weight rows and tree weights of one block on its way between tasks; tree weights go in half precision, their averaging weights on a scale.
LINES, SLOTS, SCALE = 1 << 8, 1 << 12, 16
#: Distinct tokens that a counting task holds before it sends them on.
FLUSH = 400_000
END = b""
#: Odd factors of the feature hashes.
MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)]


def tokens_of(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def held_out(ids: list) -> list[bool]:
    return [zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT if i is not None else False for i in ids]


def shape_of(token: bytes) -> int:
    """The shared leaf of a token without one of its own."""
    return zlib.crc32(token[-3:]) % SHAPES


def hash_of(token: bytes) -> int:
    return zlib.crc32(token) ^ 0x5BD1E995


def _count(batches):
    """(token, training count)."""
    from collections import Counter

    train = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(train.keys(), pa.binary()), pa.array(train.values(), pa.int64())], ["token", "c"])
        train.clear()
        return out

    for batch in slices(batches):
        for out, text in zip(held_out(batch.column("id").to_pylist()), utf8(batch.column("text")), strict=True):
            if not out:
                train.update(tokens_of(text))
                if len(train) >= FLUSH:
                    yield flush()
    if train:
        yield flush()


class Items:
    """The leaves: tokens of their own, by count and then bytes, then SHAPES shared
    ones.  weight is what a leaf has of the total `whole`; share is, for a shared
    leaf, what each of its tokens' c + 0.5 is divided by."""

    def __init__(self, tokens: list[bytes], c: np.ndarray, types: np.ndarray, rest: np.ndarray):
        self.tokens = tokens
        self.share = rest + 0.5 * types + 0.5  # 0.5 for an unknown token
        self.weight = np.concatenate([c + 0.5, self.share])
        self.whole = float(self.weight.sum())
        self.hashes = np.array([hash_of(t) for t in tokens] + [0] * SHAPES, np.uint32)


def items_of(counts: DataFrame, most: int) -> Items:
    """The most frequent tokens, `most` at most: all whose count reaches a threshold
    (LEAST or more), which a histogram of counts of a few hundred rows sets."""
    octave = F.floor(F.log2("c") * 64)
    bars = sorted(((r["b"], r["n"], r["least"]) for r in counts.where(F.col("c") >= LEAST).groupBy(octave.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()), reverse=True)
    n, least = 0, None
    for _, k, low in bars:
        if n + k > most:
            break
        n, least = n + k, low
    tokens, c = [], np.zeros(0)
    if least is not None:
        got = counts.where(F.col("c") >= least).toArrow()
        names, sizes = got["token"].to_pylist(), got["c"].to_numpy()
        order = sorted(range(len(names)), key=lambda i: (-sizes[i], names[i]))
        tokens, c = [names[i] for i in order], sizes[order].astype(np.float64)
    others = counts if least is None else counts.where(F.col("c") < least)
    shape = F.pmod(F.crc32(F.when(F.length("token") <= 3, F.col("token")).otherwise(F.substring("token", -3, 3))), F.lit(SHAPES))
    types, rest = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in others.groupBy(shape.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect():
        types[r["s"]], rest[r["s"]] = r["n"], r["c"]
    return Items(tokens, c, types, rest)


def _to_ids(shared):
    """Items of each text, the hashes of tokens without a leaf of their own, and these tokens."""

    def task(batches):
        index = dict(zip(shared.value, range(len(shared.value)), strict=True))
        other, get = len(index), index.get
        for batch in slices(batches):
            ids, hashes, tails, sizes = [], [], [], []
            for text in utf8(batch.column("text")):
                words = tokens_of(text)
                own = np.fromiter(map(get, words, repeat(other)), "<i4", len(words))
                at = np.flatnonzero(own == other)
                tail = [words[i] for i in at.tolist()]
                own[at] += [shape_of(w) for w in tail] if tail else 0
                ids.append(own.tobytes())
                hashes.append(np.array([hash_of(w) for w in tail], "<u4").tobytes())
                tails.append(tail)
                sizes.append(len(words))
            doc = batch.column("id")
            cols = [doc, pa.array(held_out(doc.to_pylist())), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(hashes, pa.binary()), pa.array(tails, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(cols, ["id", "held_out", "n_tokens", "ids", "hashes", "tail"])

    return task


def _before(n_items, ends):
    """Counts of the two preceding tokens that are contexts, by item: rows (block of
    ITEMS, places and counts).  The end of a text is no context, so texts may be joined."""

    def task(batches):
        table = np.zeros(n_items * CONTEXTS, np.int32)
        for batch in batches:
            for ids, _, _ in _joined_texts(zip(batch.column("ids").to_pylist(), repeat(b"")), 1 << 16):
                for gap in (1, 2):
                    a, b = ids[:-gap], ids[gap:]
                    ok = a < CONTEXTS
                    for e in ends:  # the end of the text before
                        ok &= (a != e) & (ids[1:-1] != e if gap == 2 else True)
                    np.add.at(table, b[ok] * CONTEXTS + a[ok], 1)
        width = ITEMS * CONTEXTS
        for at in range(0, len(table), width):
            part = table[at : at + width]
            hit = np.flatnonzero(part)
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array([at // width], pa.int64()), pa.array([np.stack([hit, part[hit]]).astype("<i4").tobytes()], pa.binary())], ["row", "data"])

    return task


def _dense(_, data):
    hit, n = np.frombuffer(data, "<i4").reshape(2, -1)
    out = np.zeros(ITEMS * CONTEXTS, np.int32)
    out[hit] = n
    return out


def _summed(decode):
    """Rows come sorted by row and then shard; the arrays of a row add up in that order."""

    def task(batches):
        row = total = None
        done_r, done_t = [], []

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(done_r, pa.int64()), pa.array(done_t, pa.binary())], ["row", "data"])
            done_r.clear()
            done_t.clear()
            return out

        for batch in batches:
            for r, d in zip(batch.column("row").to_pylist(), batch.column("data").to_pylist(), strict=True):
                d = decode(r, d)
                if r == row:
                    total = total + d
                    continue
                if row is not None:
                    done_r.append(row)
                    done_t.append(total.tobytes())
                    if len(done_r) >= 100:
                        yield flush()
                row, total = r, d
        if row is not None:
            done_r.append(row)
            done_t.append(total.tobytes())
            yield flush()

    return task


def _gather(rows: DataFrame, order: list[str], decode, dtype):
    """(row, sum of the tasks' arrays): as many rows as the model has, 50 MB at most."""
    parts = max(1, min(64, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sorted_ = rows.repartition(parts, "row").sortWithinPartitions(*order).select("row", "data")
    got = sorted_.mapInArrow(_summed(decode), "row long, data binary").toArrow()
    for batch in got.to_batches():
        for r, d in zip(batch.column("row").to_pylist(), batch.column("data"), strict=True):
            yield r, np.frombuffer(d.as_buffer(), dtype)


def classes_of(items: Items, before: np.ndarray, rounds: int = 12) -> np.ndarray:
    """The class of each item: some of the most frequent have one for themselves, the
    end has CLASSES - 1, and all others are clustered by their contexts."""
    n, free = len(before), CLASSES - 1 - OWN
    share = before.sum(0) + 1.0
    share /= share.sum()
    # mixture of multinomials, started from the rows of evenly spaced frequent tokens
    picks = np.unique(np.linspace(0, max(0, min(n, 512) - 1), free).astype(int))
    theta = np.log((before[picks] + 20 * share) / (before[picks].sum(1, keepdims=True) + 20))
    prior = np.zeros(len(picks))
    label = np.zeros(n, np.int64)
    for _ in range(rounds):
        sums = np.zeros(theta.shape)
        for at in range(0, n, BLOCK):
            counts = before[at : at + BLOCK].astype(np.float64)
            own = np.argmax(counts @ theta.T + prior, 1)
            label[at : at + BLOCK] = own
            sums += (own == np.arange(len(picks))[:, None]).astype(np.float64) @ counts
        sizes = np.bincount(label, minlength=len(picks)) + 1.0
        theta = np.log((sums + 20 * share) / (sums.sum(1, keepdims=True) + 20))
        prior = np.log(sizes / sizes.sum())
    out = OWN + label
    own = [i for i, t in enumerate(items.tokens[: OWN + 1]) if t != END][:OWN]
    out[own] = range(len(own))
    if END in items.tokens:
        out[items.tokens.index(END)] = CLASSES - 1
    return out


class Tree:
    """A binary tree over the items of each class, halved by weight.  first and depth
    give an item's way down, step its nodes and sides (node * 2 + side); bias the
    logit of side 1 at each node, so that with no other weights a leaf has its share
    of the class's weight."""

    def __init__(self, label: np.ndarray, weight: np.ndarray):
        n = len(label)
        order = np.lexsort((np.arange(n), label))  # items come by count, so alike counts stand together
        total = np.append(0.0, np.cumsum(weight[order]))
        low = np.flatnonzero(np.diff(label[order], prepend=-1))
        high = np.append(low[1:], n)
        items, steps, bias, n_nodes = [], [], [], 0
        while (open_ := high - low > 1).any():
            low, high = low[open_], high[open_]
            mid = np.clip(np.searchsorted(total, (total[low] + total[high]) / 2), low + 1, high - 1)
            bias.append(np.log((total[high] - total[mid]) / (total[mid] - total[low])))
            k = high - low
            at = np.arange(k.sum()) + np.repeat(low - (np.cumsum(k) - k), k)
            items.append(order[at])
            steps.append(np.repeat(np.arange(n_nodes, n_nodes + len(low)), k) * 2 + (at >= np.repeat(mid, k)))
            n_nodes += len(low)
            low, high = np.stack([low, mid], 1).ravel(), np.stack([mid, high], 1).ravel()
        item = np.concatenate(items) if items else np.zeros(0, np.int64)
        self.step = (np.concatenate(steps) if steps else item)[np.argsort(item, kind="stable")].astype(np.uint32)
        self.depth = np.bincount(item, minlength=n).astype(np.int8)
        self.first = (np.cumsum(self.depth, dtype=np.int64) - self.depth).astype(np.int32)
        self.bias = np.concatenate(bias or [np.zeros(1)]).astype(np.float32)

    def way(self, y: np.ndarray):
        """How many decisions each of y has, and the node and side of each."""
        k = self.depth[y].astype(np.int64)
        at = np.repeat(self.first[y] - (np.cumsum(k) - k), k)
        at += np.arange(len(at))
        step = self.step[at]
        return k, step >> np.uint32(1), (step & np.uint32(1)).astype(np.float32)


class Model:
    """Class weights (a row a feature and the bias last), tree weights, labels and tree."""

    def __init__(self, items: Items, label: np.ndarray, n_train: int):
        size = lambda tokens, bounds: int(np.clip(np.round(np.log2(max(1, n_train) / tokens)), *bounds))
        self.row_log2, self.slot_log2 = size(ROW_TOKENS, ROW_LOG2), size(SLOT_TOKENS, SLOT_LOG2)
        self.label, self.hashes, self.n_head = label, items.hashes, len(items.tokens)
        self.tree = Tree(label, items.weight)
        self.w = np.zeros((3 * (1 << self.row_log2) + 1, CLASSES), np.float32)
        mass = np.bincount(label, items.weight, CLASSES)
        # a class without tokens has no probability
        self.w[-1] = np.where(mass > 0, np.log(np.maximum(mass, 1e-300) / items.whole), -1e4)
        self.t = np.zeros(1 << self.slot_log2, np.float32)

    def history(self, ids: np.ndarray, tail: np.ndarray, starts: np.ndarray):
        """Hashes of the last token and of the one before it, at each position; before
        a text stands 0."""
        h = self.hashes[ids]
        h[ids >= self.n_head] = tail
        p1, p2 = np.zeros(len(h), np.uint32), np.zeros(len(h), np.uint32)
        p1[1:], p2[2:] = h[:-1], h[:-2]
        p1[starts] = 0
        p2[starts] = 0
        second = starts + 1
        p2[second[second < len(h)]] = 0
        return p1, p2

    def rows(self, p1, p2) -> list[np.ndarray]:
        """Class weight rows of each position: last, pair and skip."""
        down, n = np.uint32(32 - self.row_log2), 1 << self.row_log2
        hash_ = lambda x: (((x ^ (x >> np.uint32(15))) * MIX[0]) >> down).astype(np.int64)
        return [hash_(p1), hash_((p1 * MIX[2]) ^ p2) + n, hash_(p2 * MIX[4]) + 2 * n]

    def slots(self, p1, k, node) -> np.ndarray:
        """The tree weight of each decision: of the last token with the node."""
        x = np.repeat(p1 * MIX[0], k)
        x ^= node * MIX[1]
        x ^= x >> np.uint32(15)
        x *= MIX[2]
        x >>= np.uint32(32 - self.slot_log2)
        return x.astype(np.int64)

    def logits(self, rows) -> np.ndarray:
        """Logits of the classes at each position, the largest 0."""
        z = self.w[rows[0]]
        for r in rows[1:]:
            z += self.w[r]
        z += self.w[-1]
        most = z[:, 0].copy()
        for c in range(1, CLASSES):
            np.maximum(most, z[:, c], out=most)
        z -= most[:, None]
        return z

    def log_probability(self, ids, p1, p2) -> np.ndarray:
        """Natural log probability of each item."""
        z = self.logits(self.rows(p1, p2))
        out = z[np.arange(len(ids)), self.label[ids]].astype(np.float64)
        np.exp(z, out=z)
        out -= np.log(z.sum(1))
        k, node, side = self.tree.way(ids)
        z = self.tree.bias[node]
        z += self.t[self.slots(p1, k, node)]
        side *= -2
        side += 1
        z *= side  # against the side taken
        np.exp(np.minimum(z, np.float32(80), out=z), out=z)
        z += 1
        np.log(z, out=z)
        total = np.append(0.0, np.cumsum(z, dtype=np.float64))
        ends = np.cumsum(k)
        return out - (total[ends] - total[ends - k])


def _owned(x):
    """x with arrays of numpy's own types: numpy scatters into those that come out of a
    pickle, whose type objects are others, by a path two to three times slower."""
    x = copy(x)
    for k, v in vars(x).items():
        if isinstance(v, np.ndarray):
            setattr(x, k, np.empty(v.shape, v.dtype.str))
            getattr(x, k)[...] = v
        elif isinstance(v, Tree):
            setattr(x, k, _owned(v))
    return x


def _joined_texts(texts, most=STEP):
    """Items and tail hashes of joined texts, about `most` tokens or one text at a time, and starts."""
    ids, tails, n = [], [], 0
    for raw, tail in texts:
        ids.append(np.frombuffer(raw, "<i4").astype(np.int64))
        tails.append(np.frombuffer(tail, "<u4"))
        n += len(ids[-1])
        if n >= most:
            yield _joined(ids, tails)
            ids, tails, n = [], [], 0
    if ids:
        yield _joined(ids, tails)


def _joined(ids, tails):
    sizes = np.array([len(x) for x in ids])
    return np.concatenate(ids), np.concatenate(tails), np.cumsum(sizes) - sizes


class Learner:
    """One shard's way along the gradient, from a model's weights.  A class row's
    step shrinks with its squared gradients, a tree row's with the curvature it has
    seen; both also say how much a shard knows of a row when shards average."""

    def __init__(self, model: Model):
        self.m, self.start_w, self.start_t = model, model.w, model.t
        self.w, self.t = model.w.copy(), model.t.copy()
        self.square, self.bend = np.full(len(self.w), PRIOR, np.float32), np.full(len(self.t), TREE_PRIOR, np.float32)

    def text(self, ids, tail, starts) -> None:
        m = self.m
        m.w, m.t = self.w, self.t
        p1, p2 = m.history(ids, tail, starts)
        for at in range(0, len(ids), STEP):
            cut = slice(at, at + STEP)
            self._step(ids[cut], p1[cut], p2[cut])
        m.w, m.t = self.start_w, self.start_t

    def _step(self, ids, p1, p2) -> None:
        m = self.m
        rows = m.rows(p1, p2)
        g = m.logits(rows)
        np.exp(g, out=g)
        g /= g.sum(1, keepdims=True)
        g[np.arange(len(ids)), m.label[ids]] -= 1
        norm = np.einsum("ij,ij->i", g, g)
        for r in rows:
            np.add.at(self.square, r, norm)
        for r in rows:
            _add_rows(self.w, r, g, -RATE / np.sqrt(self.square[r]))
        k, node, side = m.tree.way(ids)
        slots = m.slots(p1, k, node)
        p = 1 / (1 + np.exp(-(m.tree.bias[node] + self.t[slots])))
        np.add.at(self.bend, slots, p - p * p)
        np.add.at(self.t, slots, (side - p) * np.float32(TREE_RATE) / self.bend[slots])

    def changes(self):
        """(block, packed sums): of class weight rows, each change times its weight in
        the average, and these weights; of tree weights, blocks numbered from -1 down."""
        known = self.square - np.float32(PRIOR)
        data = np.concatenate([(self.w - self.start_w) * known[:, None], known[:, None]], 1)
        for at in range(0, len(known), LINES):
            if known[at : at + LINES].any():
                yield at // LINES, data[at : at + LINES].tobytes()
        change, known = (self.t - self.start_t).astype(np.float16), ((self.bend - np.float32(TREE_PRIOR)) / SCALE).astype(np.float16)
        for at in range(0, len(change), SLOTS):
            if known[at : at + SLOTS].any():
                yield -1 - at // SLOTS, change[at : at + SLOTS].tobytes() + known[at : at + SLOTS].tobytes()


def _add_rows(table: np.ndarray, rows: np.ndarray, add: np.ndarray, scale: np.ndarray) -> None:
    """table[rows] += add * scale, repeated rows adding up; one flat scatter, which numpy does fastest."""
    width = table.shape[1]
    at = rows[:, None] * width + np.arange(width)
    np.add.at(table.ravel(), at.ravel(), (add * scale[:, None]).ravel())


def _gradient(shared):
    def task(batches):
        static, w, t = (x.value for x in shared)
        static.w, static.t = w, t
        model = _owned(static)

        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "ids", "hashes")), strict=True)

        for shard, texts in groupby(rows(), lambda x: x[0]):  # whatever the batches, a shard's steps are the same
            learner = Learner(model)
            for ids, tail, starts in _joined_texts((t[1:] for t in texts), 4 * STEP):
                learner.text(ids, tail, starts)
            made = list(learner.changes())
            for at in range(0, len(made), 100):
                r, d = zip(*made[at : at + 100], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array([shard] * len(r), pa.int32()), pa.array(d, pa.binary())], ["row", "shard", "data"])

    return task


def _decode(block, data):
    if block >= 0:
        return np.frombuffer(data, np.float32)
    x = np.frombuffer(data, np.float16).astype(np.float32)
    x[:SLOTS] *= x[SLOTS:]
    return x


def train(texts: DataFrame, model: Model, n_train: int, rounds: int = ROUNDS) -> None:
    """Moves the model's weights along the gradient over texts (id, ids, hashes).
    Each round has shards of its own and starts from the average of the round before."""
    spark = texts.sparkSession
    shards = -(-max(SHARDS, -(-n_train // SHARD)) // rounds) * rounds
    dealt = texts.select(F.pmod(F.xxhash64("id", "ids"), F.lit(shards)).cast("int").alias("shard"), F.xxhash64("ids", "hashes").alias("h"), "ids", "hashes")
    put = spark.sparkContext.broadcast
    static = copy(model)
    static.w = static.t = None
    static = put(static)
    for k in range(rounds):
        shared = static, put(model.w), put(model.t)
        part = dealt.where(F.pmod("shard", F.lit(rounds)) == k).repartition(4 * shards // rounds, "shard").sortWithinPartitions("shard", "h", "ids")
        moved = part.select("shard", "ids", "hashes").mapInArrow(_gradient(shared), "row long, shard int, data binary")
        for r, total in _gather(moved, ["row", "shard"], _decode, np.float32):
            if r >= 0:
                total = total.reshape(-1, CLASSES + 1)
                model.w[r * LINES : (r + 1) * LINES] += total[:, :-1] / np.maximum(total[:, -1:], 1e-30)
            else:
                model.t[(-1 - r) * SLOTS : -r * SLOTS] += total[:SLOTS] / np.maximum(total[SLOTS:], 1e-30)
        for x in shared[1:]:
            x.destroy()  # the round is over, and its sums are here
    static.destroy()


def _score(shared):
    """Sums over each text: the base of its items with leaves of their own, and the
    model's log10 probability of all leaves, shared ones divided among their tokens."""

    def task(batches):
        model, base, inner = shared.value
        model = _owned(model)
        for batch in slices(batches):
            b, s, k = [], [], []
            for ids, tail, starts in _joined_texts(zip(batch.column("ids").to_pylist(), batch.column("hashes").to_pylist(), strict=True), 4 * STEP):
                p1, p2 = model.history(ids, tail, starts)
                own = inner[ids]
                for at in range(0, len(ids), 2 * STEP):
                    cut = slice(at, at + 2 * STEP)
                    own[cut] += model.log_probability(ids[cut], p1[cut], p2[cut]) / np.log(10)
                s += np.add.reduceat(own, starts).tolist()
                b += np.add.reduceat(base[ids], starts).tolist()
                k += np.add.reduceat((ids < model.n_head).astype(np.int64), starts).tolist()
            keep = [batch.column(c) for c in ("uid", "id", "held_out", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(k, pa.int64()), pa.array(b, pa.float64()), pa.array(s, pa.float64())], ["uid", "id", "held_out", "n_tokens", "k", "b", "s"])

    return task


def fit(made: DataFrame, items: Items, n_train: int, rounds: int) -> Model:
    """Classes, trees and weights from the training rows of made."""
    learn = made.where("not held_out")
    n = len(items.weight)
    ends = frozenset(i for i, t in enumerate(items.tokens[:CONTEXTS]) if t == END)
    before = np.zeros((-(-n // ITEMS), ITEMS * CONTEXTS), np.int32)
    for r, total in _gather(learn.select("ids").mapInArrow(_before(n, ends), "row long, data binary"), ["row"], _dense, np.int32):
        before[r] = total
    before = before.reshape(-1, CONTEXTS)[:n]
    model = Model(items, classes_of(items, before), n_train)
    del before
    train(learn, model, n_train, rounds)
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_rows: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """One row a document: id_col, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10 probabilities of the whole text."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    counts = materialize(slim.mapInArrow(_count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")), "tokens")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_train, v = int(total[0]), int(total[1])
    items = items_of(counts, head_rows)
    n = len(items.tokens)
    shared = spark.sparkContext.broadcast(items.tokens)
    id_field = slim.schema["id"]
    kind = lambda **c: T.StructType([id_field if k == "id" else T.StructField(k, t) for k, t in c.items()])
    made = kind(id=None, held_out=T.BooleanType(), n_tokens=T.LongType(), ids=T.BinaryType(), hashes=T.BinaryType(), tail=T.ArrayType(T.BinaryType()))
    made = materialize(slim.mapInArrow(_to_ids(shared), made).withColumn("uid", F.monotonically_increasing_id()), "ids")
    model = fit(made, items, n_train, rounds)
    whole = n_train + 0.5 * (v + 1)
    base = np.append(np.log10(items.weight[:n] / whole), np.zeros(SHAPES))
    inner = np.append(np.zeros(n), -np.log10(items.share))
    shared = spark.sparkContext.broadcast((model, base, inner))
    out = kind(uid=T.LongType(), id=None, held_out=T.BooleanType(), n_tokens=T.LongType(), k=T.LongType(), b=T.DoubleType(), s=T.DoubleType())
    first = materialize(made.select("uid", "id", "held_out", "n_tokens", "ids", "hashes").mapInArrow(_score(shared), out), "scores")
    # The tokens without a leaf of their own: none of them holds more than one token in HEAD of the corpus.
    tail = made.select("uid", F.explode("tail").alias("token")).join(counts, "token", "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    tail = tail.groupBy("uid").agg(F.sum(F.log10(c + 0.5)).alias("logs"), F.count(F.lit(1)).alias("m"), F.count("c").alias("mk"))
    every = first.join(tail, "uid", "left")
    m, logs = F.coalesce("m", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return every.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("k") + F.coalesce("mk", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("b") + logs - m * float(np.log10(whole))).alias("base_score"), (F.col("s") + logs).alias("score"),
    )
