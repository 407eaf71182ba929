"""Contamination of candidate texts by evaluation texts: the four-reason scan, and
the classifier with precedence exact, prompt, long substring, near.

The evaluation side is counted before any of it is broadcast: up to
BROADCAST_EVAL rows go to every executor, and beyond that joins shuffle."""

from __future__ import annotations

from collections import Counter
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.hashing import PRIME, grams, hamming, md5_60, minhash, minhash_similarity, permutations, simhash_of, windows
from ..functions.hashing import simhash as simhash_column
from ..functions.text import given, normal, normalize, strip
from .dedup import ensure_checkpoint_dir
from .selection import bottom_k

# Benchmark names, by generation of the scan, and the thresholds of the near check.
SIGNALS_1 = ("answercarefully", "mt-bench", "mt bench", "llm-jp instruction", "private holdout", "gsm8k", "humaneval", "mmlu")
SIGNALS_2 = ("mt-bench", "mt bench", "answercarefully", "answer carefully", "llm-jp-instructions", "japanese mt-bench")
GRAM, LEAST_SUBSTRING, WINDOW, WINDOW_STEP, PROBE = 13, 40, 80, 40, 24
NEAR = {"shorter": 40, "minhash": 0.35, "minhash_ratio": 0.50, "simhash": 0.90, "simhash_ratio": 0.80, "quarantine": 0.80, "matches": 16}
ELIGIBLE = ("clean", "not_checked_missing_eval_source", "not_scanned")
BROADCAST_EVAL = 20_000


def small(df: DataFrame, most: int = BROADCAST_EVAL) -> DataFrame:
    """df, marked for broadcast if it was counted to be small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: Most keys that ``probe`` broadcasts (8 bytes each), and code points that it hashes at once.
PROBE_KEYS, PROBE_CHARS = 2_000_000, 1 << 20
#: Most characters of eval texts that stand in every task, and rows that a task works on at once.
SWEEP_CHARS, SWEEP_ROWS = 500_000, 500


class EmptyContent(ValueError):
    """An evaluation row without content cannot be fingerprinted."""


def _rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all windows of `size` code points, from those of 1, 2, 4, ... code points."""
    base, part, width, h, done = 0x9E3779B97F4A7C15, codes, 1, None, 0
    while True:
        if size & width:  # the windows so far, then this part behind them
            h = part if h is None else h[: len(codes) - done - width + 1] * np.uint64(pow(base, width, 1 << 64)) + part[done:]
            done += width
        if done == size:
            break
        part = part[:-width] * np.uint64(pow(base, width, 1 << 64)) + part[width:]
        width *= 2
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def _codes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return raw.astype(np.uint64)


class Keys:
    """Distinct texts of `size` code points, or whole shorter ones, to be found in other texts."""

    def __init__(self, keys, size: int):
        self.size, self.known = size, frozenset(k for k in keys if k)
        self.hashes = np.unique(np.array([_rolling(_codes(k), len(k))[0] for k in self.known], np.uint64))
        self.down = np.uint64(64 - int(np.clip(np.ceil(np.log2(max(1, len(self.hashes)))) + 5, 12, 26)))

    def find(self, text: str) -> set[str]:
        """The keys among the windows of a text, and a shorter text itself if it is one."""
        if not text or not self.known:
            return set()
        if "maybe" not in self.__dict__:  # made in the task: tells nearly all windows apart without a search
            self.maybe = np.zeros(1 << (64 - int(self.down)), bool)
            self.maybe[(self.hashes >> self.down).astype(np.int64)] = True
        width, out = min(self.size, len(text)), set()
        for start in range(0, len(text) - width + 1, PROBE_CHARS):
            h = _rolling(_codes(text[start : start + PROBE_CHARS + width - 1]), width)
            at = np.flatnonzero(self.maybe[(h >> self.down).astype(np.int64)])
            if len(at):
                place = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
                out.update(text[start + p : start + p + width] for p in at[self.hashes[place] == h[at]].tolist())
        return out & self.known


def held(evals: DataFrame, columns=("id", "norm")) -> list | None:
    """The eval rows, if they are few and short enough to stand in every task."""
    n, chars = evals.agg(F.count(F.lit(1)), F.sum(F.length("norm"))).first()
    return evals.select(*columns).collect() if n <= BROADCAST_EVAL and (chars or 0) <= SWEEP_CHARS else None


def sweep(cand: DataFrame, state, find, fields: str, *more: str) -> DataFrame:
    """(id, fields): what find(state, norm, *more) yields of each candidate, in one pass.
    Candidates are (id, norm), or (id, text) to be normalised on the way."""
    shared = cand.sparkSession.sparkContext.broadcast(state)
    ready = "norm" in cand.columns
    types = T._parse_datatype_string(fields)

    def task(batches):
        own = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, SWEEP_ROWS):
                batch, rows, found = whole.slice(at, SWEEP_ROWS), [], []
                for i, values in enumerate(zip(*[batch.column(k).to_pylist() for k in range(1, batch.num_columns)], strict=True)):
                    norm = [v or "" if ready else normal(v or "") for v in values]
                    for hit in find(own, *norm):
                        rows.append(i)
                        found.append(hit)
                if rows:
                    made = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*found, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made], ["id", *types.names])

    return cand.select("id", "norm" if ready else "text", *more).mapInArrow(task, T.StructType([cand.schema["id"], *types]))


def normed(df: DataFrame) -> DataFrame:
    return df if "norm" in df.columns else df.withColumn("norm", normalize("text"))


def all_grams(text: str, size: int) -> list[str]:
    """The grams of functions.hashing.grams, with repeats."""
    return [text[i : i + size] for i in range(len(text) - size + 1)] if len(text) > size else [text] if text else []


class Held:
    """Eval texts of a scan: their grams, and the texts of at least LEAST_SUBSTRING characters by their first gram."""

    def __init__(self, evals, size: int = GRAM):
        self.grams = Keys((g for _, t in evals for g in all_grams(t, size)), size)
        self.exact = frozenset(t for _, t in evals)
        self.long = [(i, t) for i, t in evals if len(t) >= LEAST_SUBSTRING]
        self.longest = max((len(t) for _, t in self.long), default=0)
        self.heads: dict[str, list] = {}
        for i, t in self.long:
            self.heads.setdefault(t[:size], []).append((i, t))

    def inside(self, norm: str, grams: set[str]) -> set:
        """Ids of the long eval texts that hold norm or that norm holds; grams are those of norm."""
        size = self.grams.size
        out = {i for g in grams for i, t in self.heads.get(g, ()) if t in norm}
        if len(norm) <= self.longest and (len(norm) < size or norm[:size] in grams):
            out.update(i for i, t in self.long if norm in t)
        return out


def _find_pairs(own: Held, norm: str):
    return [(i,) for i in own.inside(norm, own.grams.find(norm))]


def _find_gram(own: Keys, norm: str):
    return [(1,)] if own.find(norm) else []


def _find_reasons(own: Held, norm: str):
    grams = own.grams.find(norm)
    return [(k,) for k, t in ((1, norm in own.exact), (2, own.inside(norm, grams)), (3, grams)) if t]


def probe(cand: DataFrame, keys: DataFrame, size: int, most: int = PROBE_KEYS) -> DataFrame:
    """(id, k): the distinct windows of `size` characters of candidates (id, norm), and
    whole shorter texts, that are among the keys k, or seldom share a hash with one; a
    join on k settles it.  Up to `most` keys are counted and their hashes broadcast, so
    windows are tested where they stand and only the few that hit ever leave their row;
    beyond that, windows meet the keys in a shuffle."""
    distinct = keys.select("k").distinct()
    if distinct.limit(most + 1).count() > most:
        return cand.select("id", F.explode(grams("norm", size)).alias("k")).join(distinct, "k", "left_semi")

    def hashed(batches):
        for batch in batches:
            h = [_rolling(c, len(c))[0] for c in map(_codes, batch.column("k").to_pylist()) if len(c)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(h, np.uint64).view(np.int64))], ["h"])

    known = np.unique(distinct.where("k is not null").mapInArrow(hashed, "h long").toArrow()["h"].to_numpy().view(np.uint64))
    log2 = int(np.clip(np.ceil(np.log2(max(1, len(known)))) + 5, 12, 26))
    shared = cand.sparkSession.sparkContext.broadcast(known.tobytes())

    def task(batches):
        sorted_ = np.frombuffer(shared.value, np.uint64)
        down = np.uint64(64 - log2)
        maybe = np.zeros(1 << log2, bool)  # tells nearly all windows apart without a search
        maybe[(sorted_ >> down).astype(np.int64)] = True

        def hits(h):
            at = np.flatnonzero(maybe[(h >> down).astype(np.int64)])
            if not len(at):
                return at
            place = np.minimum(np.searchsorted(sorted_, h[at]), len(sorted_) - 1)
            return at[sorted_[place] == h[at]]

        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column("norm").to_pylist() if len(sorted_) else []):
                if not text:
                    continue
                codes, mine = _codes(text), set()
                width = min(size, len(codes))
                for start in range(0, len(codes) - width + 1, PROBE_CHARS):
                    part = codes[start : start + PROBE_CHARS + width - 1]
                    mine.update(text[start + p : start + p + width] for p in hits(_rolling(part, width)).tolist())
                rows += [i] * len(mine)
                found += mine
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], ["id", "k"])

    return cand.select("id", "norm").mapInArrow(task, T.StructType([cand.schema["id"], T.StructField("k", T.StringType())]))


def signal(text: Column, names=SIGNALS_1) -> Column:
    low = F.lower(given(text))
    return F.greatest(*[low.contains(n).cast("int") for n in names]) == 1


def shared_keys(cand: DataFrame, evals: DataFrame, size: int) -> DataFrame:
    """k: the distinct grams of `size` characters of eval texts that are in any candidate."""
    if (few := held(evals)) is not None:
        keys = Keys((g for _, t in few for g in all_grams(t, size)), size)
        return sweep(cand, keys, _find_keys, "k string").select("k").distinct()
    k = evals.select(F.explode(grams("norm", size)).alias("k")).distinct()
    return k.join(probe(normed(cand), k, size).select("k").distinct(), "k", "left_semi")


def _find_keys(own: Keys, norm: str):
    new = own.find(norm) - own.__dict__.setdefault("told", set())  # once a task is enough
    own.told |= new
    return [(k,) for k in new]


def shared_counts(cand: DataFrame, evals: DataFrame, size: int) -> DataFrame:
    """(id, eval_id, shared): how many distinct grams of `size` characters candidate and eval text share."""
    evals = evals.where(F.length("norm") >= size)
    if (few := held(evals)) is not None:
        posts: dict[str, list] = {}
        for i, t in few:
            for g in set(all_grams(t, size)):
                posts.setdefault(g, []).append(i)
        made = sweep(cand, (Keys(posts, size), posts), _find_counts, f"eval_id {evals.schema['id'].dataType.simpleString()}, n long")
        return made.groupBy("id", "eval_id").agg(F.sum("n").alias("shared"))
    e = evals.select(F.col("id").alias("eval_id"), F.explode(grams("norm", size)).alias("k"))
    return probe(normed(cand), e, size).join(small(e, 200_000), "k").groupBy("id", "eval_id").agg(F.count(F.lit(1)).alias("shared"))


def _find_counts(own, norm: str):
    keys, posts = own
    return Counter(i for g in keys.find(norm) for i in posts[g]).items()


def substring_pairs(cand: DataFrame, evals: DataFrame) -> DataFrame:
    """(id, eval_id) where one normalised text holds the other and the eval text
    has at least LEAST_SUBSTRING characters.  A text that holds another holds the
    other's first LEAST_SUBSTRING characters, so pairs meet on those in an
    equi-join and only they are compared; few eval texts are compared in the task."""
    n = LEAST_SUBSTRING
    if (few := held(evals)) is not None:
        return sweep(cand, Held(few), _find_pairs, f"eval_id {evals.schema['id'].dataType.simpleString()}").distinct()
    cand = normed(cand)
    e = evals.where(F.length("norm") >= n)
    head = e.select(F.col("id").alias("eval_id"), F.substring("norm", 1, n).alias("k"))
    # Only ids travel with the windows that hit; texts are attached to the few pairs that meet.
    meet = probe(cand, head, n).join(small(head), "k").select("id", "eval_id")
    # a candidate inside an eval text: of full length by its own first characters, shorter ones by all of theirs
    long = cand.where(F.length("norm") >= n).select("id", F.substring("norm", 1, n).alias("k"))
    parts = e.select(F.col("id").alias("eval_id"), F.explode(grams("norm", n)).alias("k"))
    meet = meet.unionByName(long.join(small(parts), "k").select("id", "eval_id")).distinct()
    texts = e.select(F.col("id").alias("eval_id"), F.col("norm").alias("eval_norm"))
    pairs = meet.join(small(texts), "eval_id").join(cand.select("id", "norm"), "id")
    checked = pairs.where(F.col("norm").contains(F.col("eval_norm")) | F.col("eval_norm").contains(F.col("norm"))).select("id", "eval_id")
    tiny = cand.where((F.length("norm") < n) & (F.length("norm") > 0)).select("id", F.col("norm").alias("k"), F.length("norm").alias("len"))
    pieces = e.select(F.col("id").alias("eval_id"), "norm", F.explode(F.sequence(F.lit(1), F.lit(n - 1))).alias("len"))
    pieces = pieces.select("eval_id", "len", F.explode(F.transform(F.sequence(F.lit(1), F.length("norm") - F.col("len") + 1), lambda i: F.substr("norm", i, F.col("len")))).alias("k")).distinct()
    short = tiny.join(pieces, ["len", "k"]).select("id", "eval_id")
    # an empty text is inside every eval text: its pairs are as many as the result has
    empty = cand.where(F.length("norm") == 0).select("id", F.lit(0).alias("k")).join(small(e.select(F.col("id").alias("eval_id"), F.lit(0).alias("k"))), "k").select("id", "eval_id")
    return checked.unionByName(short).unionByName(empty).distinct()


def gram_overlap(cand: DataFrame, evals: DataFrame, size: int = GRAM) -> DataFrame:
    """ids of candidates that share a character gram with any eval text."""
    if (few := held(evals)) is not None:
        return sweep(cand, Keys((g for _, t in few for g in all_grams(t, size)), size), _find_gram, "k int").select("id").distinct()
    cand = normed(cand)
    k = evals.select(F.explode(grams("norm", size)).alias("k")).distinct()
    return probe(cand, k, size).join(small(k, 200_000), "k", "left_semi").select("id").distinct()


def scan(cand: DataFrame, evals: DataFrame) -> DataFrame:
    """First-generation scan of (id, text) against (id, text): id, status, reasons."""
    c = cand.select("id", given("text").alias("text"), normalize("text").alias("norm"))
    e = evals.select("id", normalize("text").alias("norm"))
    if not e.limit(1).count():
        return c.select("id", F.lit("not_checked_missing_eval_source").alias("status"), F.array().cast("array<string>").alias("reasons"))
    if (few := held(e)) is not None:
        hits = sweep(cand.select("id", "text"), Held(few), _find_reasons, "k int")
        return _reasons(cand.select("id", given("text").alias("text")), hits)
    hashes = small(e.select(F.sha2("norm", 256).alias("h")).distinct())
    exact = c.select("id", F.sha2("norm", 256).alias("h")).join(hashes, "h", "left_semi").select("id", F.lit(1).alias("k"))
    sub = substring_pairs(c, e).select("id").distinct().select("id", F.lit(2).alias("k"))
    gram = gram_overlap(c, e).select("id", F.lit(3).alias("k"))
    return _reasons(c, exact.unionByName(sub).unionByName(gram))


def _reasons(c: DataFrame, hits: DataFrame) -> DataFrame:
    """id, status and reasons of candidates (id, text), from the kinds of hits (id, k)."""
    hits = hits.groupBy("id").agg(F.collect_set("k").alias("hits"))
    out = c.select("id", signal(F.col("text")).alias("named")).join(hits, "id", "left")
    has = lambda k: F.coalesce(F.array_contains("hits", k), F.lit(False))
    named = [(has(1), "exact_eval_match"), (has(2), "substring_eval_match"), (has(3), "ngram_eval_match"), (F.col("named"), "benchmark_name_signal")]
    out = out.withColumn("reasons", F.array_compact(F.array(*[F.when(t, F.lit(n)) for t, n in named])))
    return out.select("id", F.when(F.size("reasons") > 0, "quarantine_contamination").otherwise("clear").alias("status"), "reasons")


def fingerprints(evals: DataFrame) -> DataFrame:
    """Content-free eval fingerprints: id, content_norm_hash, normalized_length."""
    n = evals.select("id", normalize("text").alias("norm"))
    return n.select("id", F.sha2("norm", 256).alias("content_norm_hash"), F.length("norm").cast("long").alias("normalized_length"))


def by_head(evals) -> tuple[Keys, dict]:
    """The aligned windows of eval texts, by their first PROBE characters."""
    heads: dict[str, list] = {}
    for i, t in evals:
        for at in range(0, len(t) - WINDOW + 1, WINDOW_STEP):
            heads.setdefault(t[at : at + PROBE], []).append((i, t[at : at + WINDOW]))
    return Keys(heads, PROBE), heads


def _find_windows(own, norm: str):
    keys, heads = own
    return [(i,) for i in {i for k in keys.find(norm) for i, w in heads[k] if w in norm}]


def window_matches(cand: DataFrame, evals: DataFrame, exhaustive: bool = True) -> DataFrame:
    """(id, eval_id) pairs that share an 80-character window.  Aligned windows miss
    a passage that moved by a character; the exhaustive probe reads every offset of
    the candidate against the aligned windows of the eval text."""
    if exhaustive and (few := held(evals)) is not None:
        return sweep(cand, by_head(few), _find_windows, f"eval_id {evals.schema['id'].dataType.simpleString()}").distinct()
    cand = normed(cand)
    e = evals.select(F.col("id").alias("eval_id"), F.explode(windows("norm", WINDOW, WINDOW_STEP)).alias("w"))
    if not exhaustive:
        c = cand.select("id", F.explode(F.array_distinct(windows("norm", WINDOW, WINDOW_STEP))).alias("w"))
        return c.join(small(e), "w").select("id", "eval_id").distinct()
    # A text that holds a window holds its first PROBE characters: pairs meet on those, and only they are compared.
    e = e.withColumn("k", F.substring("w", 1, PROBE))
    meet = probe(cand, e, PROBE).join(small(e), "k").select("id", "eval_id", "w").distinct()
    return meet.join(cand.select("id", "norm"), "id").where(F.col("norm").contains(F.col("w"))).select("id", "eval_id").distinct()


def fingerprint_simhash(norm, digest: str = "seeded") -> Column:
    """The published signature of normalised text: distinct 3-grams, at most 256, 0 of an empty text."""
    return simhash_column(norm, digest=digest, distinct=True)


def fingerprint_index(evals: DataFrame) -> DataFrame:
    """One row an evaluation text (id, text, prompt) without its content: hashes,
    MinHash, SimHash and length, to be written as Parquet and read by later scans.  A
    row without content is an error."""
    n = evals.select("id", normalize("text").alias("norm"), normalize("prompt").alias("pnorm"))
    require_content(n)
    sig = n.withColumn("hs", F.transform(grams("norm", GRAM, 64), md5_60))
    return sig.select(
        "id", F.sha2("norm", 256).alias("content_hash"), F.when(F.col("pnorm") != "", F.sha2("pnorm", 256)).otherwise("").alias("prompt_hash"), minhash("hs").alias("minhash"),
        F.lower(F.lpad(F.hex(fingerprint_simhash("norm")), 16, "0")).alias("simhash"), F.length("norm").cast("long").alias("normalized_length"),
    )


def require_content(normalized: DataFrame) -> None:
    if normalized.where("norm = ''").limit(1).count():
        raise EmptyContent("empty normalized content is forbidden for a fingerprint")


def _find_signature(own, norm: str):
    """Length, SimHash and MinHash of a text of a length between the bounds, of all its
    distinct grams; no MinHash of one that shares no gram with the keys, if there are any."""
    least, most, keys = own
    if not least <= len(norm) <= most:
        return
    sig = simhash_of(norm, most=len(norm), digest="seeded", distinct=True)
    if keys and not keys.find(norm):
        yield len(norm), sig, None
        return
    h = np.array([int(md5(g.encode()).hexdigest()[:15], 16) % PRIME for g in set(all_grams(norm, GRAM))], np.int64)
    factor, shift = (np.array(x, np.int64)[:, None] for x in zip(*permutations(128), strict=True))
    mh = np.full(128, PRIME, np.int64)
    for at in range(0, len(h), 4096):
        mh = np.minimum(mh, ((h[at : at + 4096] * factor + shift) % PRIME).min(1))
    yield len(norm), sig, mh.tolist()


def near_pairs(cand: DataFrame, evals: DataFrame) -> DataFrame:
    """(id, eval_id, similarity, evidence) of near matches: MinHash of all 13-grams and
    SimHash of all 3-grams, each with its length ratio.  No pair is lost: lengths beyond
    the ratios cannot match, signatures that agree in 45 of 128 places agree in one of
    the first 84, and those up to six bits apart share one of seven blocks.  Candidates
    are (id, norm), or (id, text) to be normalised on the way."""
    lo, hi = evals.where(F.length("norm") >= NEAR["shorter"]).agg(F.min(F.length("norm")), F.max(F.length("norm"))).first()
    ratio_least = min(NEAR["minhash_ratio"], NEAR["simhash_ratio"])
    bounds = (max(NEAR["shorter"], int(lo * ratio_least)), int(hi / ratio_least) + 1) if lo else (1, 0)
    few = held(evals)
    keys = Keys((g for _, t in few for g in all_grams(t, GRAM)), GRAM) if few else None
    ensure_checkpoint_dir(cand.sparkSession)

    def signed(df, state):
        made = sweep(df, state, _find_signature, "len int, simhash long, mh array<int>").persist(StorageLevel.DISK_ONLY)  # a checkpoint computes its rows twice
        out = made.checkpoint()
        made.unpersist()
        return out

    a, b = signed(cand, (*bounds, keys)), signed(evals.select("id", "norm"), (NEAR["shorter"], 1 << 31, None)).withColumnRenamed("id", "eval_id")
    places = 128 - int(np.ceil(128 * NEAR["minhash"])) + 1
    by_place = lambda df, id_: df.select(id_, F.posexplode(F.slice("mh", 1, places)).alias("place", "v"))
    pairs = by_place(a, "id").join(small(by_place(b, "eval_id"), 200_000), ["place", "v"]).select("id", "eval_id")
    bits = int(64 * (1 - NEAR["simhash"]))
    edge = [64 * i // (bits + 1) for i in range(bits + 2)]
    cut = F.array(*[F.shiftrightunsigned("simhash", f).bitwiseAND((1 << (t - f)) - 1) for f, t in zip(edge, edge[1:], strict=False)])
    block = lambda df, id_: df.select(id_, F.col("simhash").alias(f"{id_}_s"), F.posexplode(cut).alias("place", "v"))
    near = block(a, "id").join(small(block(b, "eval_id"), 200_000), ["place", "v"]).where(hamming("id_s", "eval_id_s") <= bits)
    pairs = pairs.unionByName(near.select("id", "eval_id")).distinct()
    rename = lambda df, p: df.select(*[F.col(c).alias(c if c in ("id", "eval_id") else p + c) for c in df.columns])
    j = pairs.join(rename(a, "a_"), "id").join(rename(b, "b_"), "eval_id")
    ratio = F.least("a_len", "b_len") / F.greatest("a_len", "b_len", F.lit(1))
    mh, sh = minhash_similarity("a_mh", "b_mh"), 1 - hamming("a_simhash", "b_simhash") / 64
    by_mh, by_sh = (mh >= NEAR["minhash"]) & (ratio >= NEAR["minhash_ratio"]), (sh >= NEAR["simhash"]) & (ratio >= NEAR["simhash_ratio"])
    j = j.where((F.least("a_len", "b_len") >= NEAR["shorter"]) & (by_mh | by_sh))
    evidence = F.array_compact(F.array(F.when(by_mh, "minhash_similarity_ge_0_35"), F.when(by_sh, "simhash_similarity_ge_0_90_length_ratio_ge_0_80")))
    return j.select("id", "eval_id", F.bround(F.greatest(mh, sh), 6).alias("similarity"), evidence.alias("evidence"))


def top_matches(pairs: DataFrame, most: int = NEAR["matches"], id_col: str = "id", eval_col: str = "eval_id") -> DataFrame:
    """The `most` matches of highest similarity of each candidate, ties by eval id, with
    their rank.  Spark keeps that many a candidate before the shuffle."""
    return bottom_k(pairs, [id_col], [F.desc("similarity"), eval_col], most)


def _kinds(c: DataFrame, e: DataFrame, exhaustive: bool) -> DataFrame:
    """(id, rank, eval_id) of the exact kinds, by joins, for any number of eval texts."""
    full = c.select("id", F.col("norm").alias("k")).join(small(e.select(F.col("id").alias("eval_id"), F.col("norm").alias("k"))), "k")
    prompt = c.where("pnorm <> ''").select("id", F.col("pnorm").alias("k")).join(small(e.where("pnorm <> ''").select(F.col("id").alias("eval_id"), F.col("pnorm").alias("k"))), "k")
    parts = [p.select("id", F.lit(k).alias("rank"), "eval_id") for k, p in ((1, full), (2, prompt), (3, window_matches(c, e, exhaustive)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _find_kinds(own, norm: str, prompt: str):
    full, prompts, heads = own
    yield from ((1, i) for i in full.get(norm, ()))
    yield from ((2, i) for i in prompts.get(prompt, ()))
    yield from ((3, i) for (i,) in _find_windows(heads, norm))


def classify(cand: DataFrame, evals: DataFrame, exhaustive: bool = True, near: bool = True) -> DataFrame:
    """Statuses of (id, text, prompt) against evals (id, text, prompt): id, status,
    reasons (array), similarity, matched_eval_ids (sorted).  Empty candidates are
    excluded_empty_projection; an eval row without content is an error.  Only rows that
    no exact key settles go on to the near check."""
    e = evals.select("id", normalize("text").alias("norm"), normalize("prompt").alias("pnorm"))
    require_content(e)
    kinds = [(1, "full_content_sha256"), (2, "prompt_sha256"), (3, "long_substring_ge_80")]
    if exhaustive and (few := held(e, ("id", "norm", "pnorm"))) is not None:
        full, prompts = {}, {}
        for i, t, p in few:
            full.setdefault(t, []).append(i)
            prompts.setdefault(p, []).append(i)
        prompts.pop("", None)
        hits = sweep(cand.select("id", "text", "prompt"), (full, prompts, by_head([(i, t) for i, t, _ in few])), _find_kinds, f"rank int, eval_id {e.schema['id'].dataType.simpleString()}", "prompt")
    else:
        hits = _kinds(cand.select("id", normalize("text").alias("norm"), normalize("prompt").alias("pnorm")), e, exhaustive)
    # white space alone is what NFKC and casefold leave nothing of
    c = cand.select("id", (strip(given("text")) == "").alias("empty"), signal(F.col("text"), SIGNALS_2).alias("named"))
    best = hits.groupBy("id", "rank").agg(F.sort_array(F.collect_set("eval_id")).alias("ids")).groupBy("id").agg(F.min_by("ids", "rank").alias("ids"), F.min("rank").alias("rank"))
    out = c.join(best, "id", "left")
    if near:
        n = near_pairs(cand.select("id", "text"), e.select("id", "norm")).join(best.select("id"), "id", "left_anti")
        top = top_matches(n).groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("neg"), "eval_id", "evidence"))).alias("t"))
        out = out.join(top, "id", "left").withColumns({"similarity": F.coalesce(-F.get("t", F.lit(0))["neg"], F.lit(0.0)), "near_ids": F.transform("t", lambda x: x["eval_id"]), "tags": F.sort_array(F.array_distinct(F.flatten(F.transform("t", lambda x: x["evidence"]))))})
    else:
        out = out.withColumns({"similarity": F.lit(0.0), "near_ids": F.lit(None).cast("array<long>"), "tags": F.lit(None).cast("array<string>")})
    base = F.when(F.col("empty"), "excluded_empty_projection").when(F.col("rank").isNotNull(), "quarantine_exact").when(F.col("near_ids").isNotNull(), F.when(F.col("similarity") >= NEAR["quarantine"], "quarantine_near").otherwise("requires_manual_review")).otherwise("clean")
    reason = F.when(F.col("empty"), F.array().cast("array<string>"))
    for rank, name in kinds:
        reason = reason.when(F.col("rank") == rank, F.array(F.lit(name)))
    reason = reason.otherwise(F.coalesce("tags", F.array().cast("array<string>")))
    named = F.col("named") & ~F.col("empty")
    return out.withColumns({"_base": base, "_reason": reason}).select(
        "id", F.when((F.col("_base") == "clean") & named, "requires_manual_review").otherwise(F.col("_base")).alias("status"),
        F.when(named, F.concat("_reason", F.array(F.lit("benchmark_or_source_metadata_signal")))).otherwise(F.col("_reason")).alias("reasons"),
        "similarity", F.coalesce("ids", "near_ids", F.array().cast("array<long>")).alias("matched_eval_ids"),
    )


def gate(classified: DataFrame, required_missing: bool, have_index: bool = True) -> DataFrame:
    """Fail closed: with no index nothing is checked; with a required eval missing no row is clean."""
    missing = F.lit(required_missing) if have_index else F.lit(True)
    hit = (F.col("status") == "clean") & missing
    return classified.withColumns({"status": F.when(hit, "not_checked_missing_eval_source").otherwise(F.col("status")), "reasons": F.when(hit, F.concat("reasons", F.array(F.lit("required_eval_source_missing")))).otherwise(F.col("reasons"))})
