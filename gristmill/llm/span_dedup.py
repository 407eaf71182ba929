"""Substring dedup over sliding spans of pieces of sentences.

A text is cut into sentences, and each sentence into pieces: of any CUT words in a
row within a sentence, it is cut after the one of the least hash.  So a piece has
CUT words at most, whatever the words are, and a passage pasted into any sentence
is cut alike wherever it stands, but for CUT - 1 words at either end.  From every
piece a span runs on until it has PIECES pieces and WORDS words, and then to the end
of its sentence if that is at most CUT words away, so that whole sentences go whole.
Spans are hashed (128 bits) by their words and joined globally; every piece covered
by a repeated span is removed, except where the span is first: in the first document
(by doc_id, null last, and then by the text's hash), at its first place there.  A repeated passage of 51 words always holds a
whole span, wherever it stands.

A first pass hashes the spans and writes them down; their hashes alone go to owners,
whose once-seen filters tell which were met before, and these make the twice-seen
filter (see ``blooms``).  Only spans that pass it are shuffled, counted by whole hash
and joined.  A passage in a third of all documents costs the count a row a task, and
the join broadcasts it.

Null texts count as empty; texts shorter than a span lose nothing; very long texts are
cut and hashed whole; rows equal in doc_id and text count as one document and lose the
same; rows that share only a doc_id, or have none, are documents of their own.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blooms
from .common import BROADCAST_ROWS, discard, hot_join, materialize, slices, text_of, utf8

PIECES, WORDS = 3, 20
CUT = 6
SENTENCE = re.compile(rb"[^.!?\n]*(?:[.!?]+(?=\s|$)|\n|$|[.!?]+)")
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: Odd factors of the two halves of a span's hash, and their inverses modulo 2^64.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D)
INVERSES = tuple(pow(f, -1, 1 << 64) for f in FACTORS)


def _ends(text: bytes) -> list[int]:
    """Where the sentences end."""
    out = []
    for m in SENTENCE.finditer(text):
        a, b = m.span()
        if a < b < len(text) and text[b - 1] != 10 and text[b : b + 1].strip():
            continue  # a stop inside a word ends nothing
        if a < b:
            out.append(b)
    return out


def _pieces(text: bytes):
    """Starts and ends of the pieces, the number of words up to each end and up to
    the end of its sentence, and the hashes of all words (as two uint64)."""
    from xxhash import xxh3_128_digest

    words = text.lower().split()
    n = len(words)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros((0, 2), np.uint64)
    h = np.frombuffer(b"".join(map(xxh3_128_digest, words)), "<u8").reshape(-1, 2)
    edge = np.flatnonzero(np.diff(SPACE[np.frombuffer(text, np.uint8)], prepend=True, append=True))
    first, last = edge[::2], edge[1::2]
    ends = np.array(_ends(text), np.int64)
    of = np.searchsorted(ends, first, "right")
    closes = np.append(of[1:] != of[:-1], True)  # the last words of sentences
    cut = closes.copy()
    if n >= CUT:
        # the last of the least in each window of CUT words that is within a sentence
        least, at = h[: n - CUT + 1, 0].copy(), np.arange(n - CUT + 1)
        for k in range(1, CUT):
            x = h[k : n - CUT + 1 + k, 0]
            lower = x <= least
            least[lower] = x[lower]
            at[lower] = np.flatnonzero(lower) + k
        cut[at[of[: n - CUT + 1] == of[CUT - 1 :]]] = True
    stop = np.flatnonzero(cut)
    b = np.where(closes[stop], ends[np.minimum(of[stop], len(ends) - 1)], last[stop])
    closing = np.flatnonzero(closes)
    return np.append(0, b[:-1]), b, stop + 1, closing[np.searchsorted(closing, stop)] + 1, h


def sentences(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, words) of the pieces of sentences that have a word; together
    with the white space around them they make up the text."""
    a, b, upto, _, _ = _pieces(text)
    return list(zip(a.tolist(), b.tolist(), np.diff(upto, prepend=0).tolist(), strict=True))


def spans(text: bytes) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """Pieces, the 128-bit hash of the span from each (as two uint64), and the
    piece after its last; the arrays end where no span fits any more."""
    a, b, upto, sentence, h = _pieces(text)
    n = len(a)
    parts = list(zip(a.tolist(), b.tolist(), np.diff(upto, prepend=0).tolist(), strict=True))
    before = np.append(0, upto)  # words before each piece
    stops = np.maximum(np.arange(n) + PIECES, np.searchsorted(before, before[:-1] + WORDS))
    stops = stops[stops <= n]
    end = sentence[stops - 1]
    stops = np.where(end - before[stops] <= CUT, np.searchsorted(before, end), stops)
    i, j = before[: len(stops)], before[stops]
    hashes = np.empty((len(stops), 2), np.uint64)
    with np.errstate(over="ignore"):
        for k in (0, 1):
            power, inverse = (np.cumprod(np.append(np.uint64(1), np.full(len(h), f, np.uint64)), dtype=np.uint64) for f in (FACTORS[k], INVERSES[k]))
            total = np.append(np.uint64(0), np.cumsum(h[:, k] * power[:-1], dtype=np.uint64))
            x = (total[j] - total[i]) * inverse[i] + (j - i).astype(np.uint64)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            hashes[:, k] = x ^ (x >> np.uint64(32))
    return parts, hashes, stops


def _sent(batches):
    """(id, h, h1, h2, k) of the distinct spans of each text, k being the number of the
    span's first place; a text that repeats a span within itself has one more row,
    without a hash."""
    for batch in slices(batches):
        at, every, places, own = [], [], [], []
        for i, text in enumerate(utf8(batch.column("text"))):
            _, h, _ = spans(text)
            if n := len(h):
                h, k = np.unique(h, axis=0, return_index=True) if n > 1 else (h, np.zeros(1, np.int64))
                if len(h) < n:
                    own.append(i)
                at.append(np.full(len(h), i))
                every.append(h)
                places.append(k)
        if every:
            h, rows = np.concatenate(every).view(np.int64), pa.array(np.concatenate([*at, np.array(own, np.int64)]))
            made = [pa.concat_arrays([pa.array(x), pa.nulls(len(own), x.dtype.name)]) for x in (h[:, 0], h[:, 1], np.concatenate(places).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), batch.column("h").take(rows), *made], ["id", "h", "h1", "h2", "k"])


def _passing(shared):
    def task(batches):
        log2, raw = shared.value
        twice = log2, np.frombuffer(raw, np.uint8)
        for batch in batches:
            hit = blooms.passes(twice, batch.column("h1").to_numpy())
            if hit.any():
                yield batch.filter(pa.array(hit))

    return task


def removed(text: bytes, places) -> tuple[bytes, int, int, list[tuple[int, int]]]:
    """Kept text, sentences, removed ones and the removed byte spans.  places are the
    numbers of the spans that are first elsewhere; repeats within the text are found
    here."""
    parts, h, stops = spans(text)
    if not len(h):
        return text, len(parts), 0, []
    _, first, inverse = np.unique(h, axis=0, return_index=True, return_inverse=True)
    first = first[inverse.ravel()]
    bad = np.zeros(len(h), bool)
    bad[np.asarray(places, np.int64)] = True
    bad = bad[first] | (first != np.arange(len(h)))
    if not bad.any():
        return text, len(parts), 0, []
    cover = np.zeros(len(parts) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(bad), 1)
    np.add.at(cover, stops[bad], -1)
    gone = np.cumsum(cover[:-1]) > 0
    kept, cut, at = [], [], 0
    for k in np.flatnonzero(gone).tolist():
        a, b, _ = parts[k]
        kept.append(text[at:a])
        at = b
        if cut and cut[-1][1] == a:
            cut[-1] = (cut[-1][0], b)
        else:
            cut.append((a, b))
    kept.append(text[at:])
    return b"".join(kept), len(parts), int(gone.sum()), cut


NAMES = ("n_sentences", "n_removed", "kept_sha256", "text")


def _rows(ids, made):
    kept, n, gone, _ = zip(*made, strict=True) if made else ((), (), (), ())
    return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array([x.decode("utf-8", "replace") for x in kept], pa.string())], ["id", *NAMES])


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row a document: id_col, n_sentences, n_removed, kept_sha256 and text
    without the removed sentences.  Texts that lose nothing are never shuffled as
    long as the ids of those that do are few enough to broadcast."""
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("h"), text_of(text_col).alias("text"))
    long = T.LongType()
    sent = slim.mapInArrow(_sent, T.StructType([slim.schema["id"], T.StructField("h", long), T.StructField("h1", long), T.StructField("h2", long), T.StructField("k", T.IntegerType())]))
    sent = materialize(sent, "spans")
    shared = sent.where("h1 is not null")
    repeated = materialize(blooms.repeats(shared.select(F.col("h1").alias("h")), shared.count()), "repeated-hashes")
    twice = blooms.twice_seen(repeated)
    discard(repeated)
    passing = materialize(shared.mapInArrow(_passing(docs.sparkSession.sparkContext.broadcast(twice)), shared.schema), "suspects")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    table = passing.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("h2", "g2")
    table = materialize(table, "repeated")
    total = table.agg(F.sum("n")).first()[0] or 0
    # h1 alone is the join key; two spans that share it are told apart by the other half
    elsewhere = ~(F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.h") == F.col("h")))
    hits = hot_join(passing, table, "h1", "n", total).where((F.col("h2") == F.col("g2")) & elsewhere)
    hits = hits.select("id", "h", "k").unionByName(sent.where("h1 is null").select("id", "h", "k"))
    drops = materialize(hits.groupBy(F.col("id").alias("i2"), F.col("h").alias("hh")).agg(F.collect_set("k").alias("ks")), "drops")
    schema = T.StructType([slim.schema["id"], T.StructField("n_sentences", long), T.StructField("n_removed", long), T.StructField("kept_sha256", T.StringType()), T.StructField("text", T.StringType())])
    touched = drops.select("i2", "hh")
    touched = F.broadcast(touched) if touched.count() <= broadcast_rows else touched
    same = lambda other: slim["id"].eqNullSafe(other["i2"]) & (slim["h"] == other["hh"])

    def rewrite(batches):
        for batch in slices(batches):
            made = []
            for text, places in zip(utf8(batch.column("text")), batch.column("ks").to_pylist(), strict=True):
                made.append(removed(text, places))
            yield _rows(batch.column("id"), made)

    def as_it_is(batches):
        for batch in slices(batches):
            yield _rows(batch.column("id"), [(text, len(_pieces(text)[0]), 0, []) for text in utf8(batch.column("text"))])

    # Each text goes to exactly one of the two.
    whole = slim.join(touched, same(touched), "left_anti").select("id", "text").mapInArrow(as_it_is, schema)
    cut = slim.join(touched, same(touched), "left_semi")
    cut = cut.join(drops, cut["id"].eqNullSafe(drops["i2"]) & (cut["h"] == drops["hh"])).select("id", "text", "ks").mapInArrow(rewrite, schema)
    return whole.unionByName(cut).withColumnRenamed("id", id_col)
