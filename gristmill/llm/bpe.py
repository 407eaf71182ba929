"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regex.  Code points become symbols of a small alphabet
(class, with what follows where the pattern looks ahead); a finite automaton over
the symbols says where tokens begin.  Its transition functions compose, so the
states of a whole batch come from a blocked scan: compose the functions inside
all blocks side by side, scan the few block results, then replay each block from
its now known state.  The slices between boundaries are merged pair by pair once
and cached.  encode(with_ends=True) keeps the ids' byte offsets, which decode_slice
uses; digests() and the pipeline decode nothing by offsets.

Null texts count as empty and have no ids.  Whole texts are encoded; repeated
rows are encoded alike.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, utf8

# The White_Space code points of Unicode.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
# Letters and numbers that Unicode 16.0 added, for a Python whose tables are older.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
OTHER, LETTER, NUMBER, SPACE = range(4)
# Symbols of the automaton.
S_OTHER, S_LETTER, S_NUMBER, S_MID, S_LAST_SPACE, S_LAST, S_QUOTE1, S_QUOTE2, S_RESET = range(9)
# States: nothing open, after a space that joins what follows, in letters, in
# numbers, in others, in white space, one and two letters before a contraction ends.
FREE, JOIN, LETTERS, NUMBERS, OTHERS, SPACES, LEFT1, LEFT2 = range(8)
#: Merged slices kept by one task at most; beyond that the cache starts anew.
CACHE_SLICES = 200_000
#: Slices of at most so many bytes are merged by a scan of their pairs, longer ones by a heap.
SHORT = 100
#: Code points that are scanned at once.
SCAN_CHARS = 1 << 19
_LOG_BLOCK = 8


def codepoint_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            table[i] = LETTER
        elif kind == "N":
            table[i] = NUMBER
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for a, b in ranges:
            table[a : b + 1] = kind
    table[WHITE_SPACE] = SPACE
    return table


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """next_state[symbol, state] and whether a token begins[symbol, state]."""
    nxt, begins = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for symbol, run in ((S_LETTER, LETTERS), (S_NUMBER, NUMBERS), (S_OTHER, OTHERS), (S_QUOTE1, OTHERS), (S_QUOTE2, OTHERS)):
        nxt[symbol] = run
        begins[symbol, [JOIN, run]] = False
    for symbol, left in ((S_QUOTE1, LEFT1), (S_QUOTE2, LEFT2)):  # an apostrophe that opens a token opens a contraction
        nxt[symbol, [s for s in range(8) if s not in (JOIN, OTHERS)]] = left
    nxt[S_LETTER, LEFT2], nxt[S_LETTER, LEFT1] = LEFT1, FREE
    begins[S_LETTER, [LEFT1, LEFT2]] = False
    nxt[S_MID] = SPACES
    begins[S_MID, SPACES] = False
    nxt[S_LAST_SPACE], nxt[S_LAST], nxt[S_RESET] = JOIN, FREE, FREE
    return nxt, begins


NEXT, BEGINS = automaton()


def symbols(cps: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbols of code points in which 0 ends each text."""
    kind = classes[cps]
    ends = cps == 0
    out = kind.copy()  # S_OTHER, S_LETTER and S_NUMBER are the classes' own numbers
    after = np.append(kind[1:], np.uint8(OTHER))
    after_end = np.append(ends[1:], True)
    space = kind == SPACE
    last = space & (after != SPACE) & ~after_end
    out[space] = S_MID
    out[last] = S_LAST
    out[last & (cps == 32)] = S_LAST_SPACE
    for i in np.flatnonzero(cps == 39).tolist():
        a = int(cps[i + 1]) if i + 1 < len(cps) else 0
        b = int(cps[i + 2]) if i + 2 < len(cps) else 0
        if a in (115, 116, 109, 100):  # s t m d
            out[i] = S_QUOTE1
        elif (a, b) in ((114, 101), (118, 101), (108, 108)):  # re ve ll
            out[i] = S_QUOTE2
    out[ends] = S_RESET
    return out


def boundaries(sym: np.ndarray) -> np.ndarray:
    """Where tokens begin, from a blocked scan of the transition functions."""
    n, width = len(sym), 1 << _LOG_BLOCK
    rows = -(-n // width)
    grid = np.full(rows * width, S_RESET, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)  # grid[j] is the j-th symbol of every block
    flat = NEXT.ravel()
    maps = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8)).copy()
    for j in range(width):
        maps = flat[(grid[j].astype(np.uint8) << 3)[:, None] | maps]
    state, starts = FREE, np.empty(rows, np.uint8)
    for i, f in enumerate(maps.tolist()):
        starts[i] = state
        state = f[state]
    out, cells, state = np.empty((width, rows), bool), BEGINS.ravel(), starts
    for j in range(width):
        at = (grid[j] << 3) | state
        out[j] = cells[at]
        state = flat[at]
    return out.T.ravel()[:n]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the lowest-ranked adjacent pair is merged, leftmost
    first, until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    return _merge_short(piece, ranks) if len(piece) <= SHORT else _merge_long(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """With a list of the pairs' ranks, of which the least is looked up each time."""
    none, get = 1 << 60, ranks.get
    cuts = list(range(len(piece) + 1))
    pair = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pair and (least := min(pair)) != none:
        i = pair.index(least)
        del cuts[i + 1], pair[i]
        if i < len(pair):
            pair[i] = get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            pair[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """With a heap over a linked list, which keeps a slice of n bytes at n log n."""
    n = len(piece)
    end, prev, nxt = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or end[j] != stop or not alive[i]:
            continue
        end[i], alive[j], nxt[i] = stop, False, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        for a in (prev[i], i):
            b = nxt[a] if a >= 0 else n
            if b < n and (r := ranks.get(piece[a : end[b]])) is not None:
                heapq.heappush(heap, (r, a, end[b]))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a tiktoken file's content."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], classes: np.ndarray):
        self.ranks, self.classes = ranks, classes
        top = max(ranks.values()) + 1
        self.tokens = [b""] * top
        for token, i in ranks.items():
            self.tokens[i] = token
        self.sizes = np.array([len(x) for x in self.tokens], np.int64)
        self.cache: dict[bytes, bytes] = {}

    def _merged(self, piece: bytes) -> bytes:
        if len(self.cache) >= CACHE_SLICES:
            self.cache.clear()
        self.cache[piece] = ids = np.array(merge(piece, self.ranks), "<u4").tobytes()
        return ids

    def encode_group(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts, as little-endian unsigned 32-bit integers."""
        joined = b"\0".join(texts) + b"\0"
        cps = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
        sym = symbols(cps, self.classes)
        if joined.count(b"\0") != len(texts):  # a text holds code point 0 itself: only the ends reset
            real = np.zeros(len(cps), bool)
            real[np.cumsum([len(t.decode("utf-8", "replace")) + 1 for t in texts]) - 1] = True
            odd = cps.copy()
            odd[(cps == 0) & ~real] = 1  # a control character of the same class
            sym = symbols(odd, self.classes)
        size = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
        offset = np.cumsum(size) - size
        starts = offset[boundaries(sym)].tolist()
        pieces = [joined[a:b] for a, b in zip(starts, [*starts[1:], len(joined)], strict=True)]
        get, merged, out, at = self.cache.get, self._merged, [], 0
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.searchsorted(np.array(starts), text_ends - 1).tolist()  # the piece that is each text's end mark
        for stop in cuts:
            out.append(b"".join([get(p) or merged(p) for p in pieces[at:stop]]))
            at = stop + 1
        return out

    def encode(self, texts: list[bytes]):
        """Ids of each text; texts are scanned in groups of about SCAN_CHARS bytes."""
        group, held = [], 0
        for t in texts:
            group.append(t)
            held += len(t)
            if held >= SCAN_CHARS:
                yield from self.encode_group(group)
                group, held = [], 0
        if group:
            yield from self.encode_group(group)

    def offsets(self, ids: bytes) -> np.ndarray:
        """The byte at which each token ends."""
        return np.cumsum(self.sizes[np.frombuffer(ids, "<u4")])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_slice(self, ids: bytes, offsets: np.ndarray, start: int, stop: int) -> bytes:
        """Bytes [start, stop) of the text, decoding only the tokens that hold them."""
        a, b = int(np.searchsorted(offsets, start, "right")), int(np.searchsorted(offsets, stop, "left")) + 1
        base = int(offsets[a - 1]) if a else 0
        return self.decode(ids[4 * a : 4 * b])[start - base : stop - base]


def _shared(spark, vocabulary: str):
    """A broadcast of the vocabulary (its file is under 1 MB) and the class table
    (1.1 MB), both read on the driver, so that executors need neither."""
    with open(vocabulary, "rb") as f:
        data = f.read()
    return spark.sparkContext.broadcast((data, codepoint_classes().tobytes()))


def _codec(shared) -> Codec:
    data, classes = shared.value
    return Codec(load_ranks(data), np.frombuffer(classes, np.uint8))


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", keep: list[str] | None = None, with_ends: bool = True) -> DataFrame:
    """docs (or its columns keep) plus ``ids`` array<int> and, with_ends, ``ends``
    array<long>, the byte offset at which each token ends; columns of these names
    are replaced."""
    shared = _shared(docs.sparkSession, vocabulary)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "ends")]
    slim = docs.select(*kept, F.col(text_col).alias("_gm_text"))
    made = [("ids", pa.list_(pa.int32()), T.ArrayType(T.IntegerType()))] + [("ends", pa.list_(pa.int64()), T.ArrayType(T.LongType()))] * with_ends
    schema = T.StructType([*slim.schema.fields[:-1], *[T.StructField(n, kind) for n, _, kind in made]])

    def task(batches):
        codec = _codec(shared)
        for batch in slices(batches):
            columns = [[], []]
            for x in codec.encode(utf8(batch.column("_gm_text"))):
                columns[0].append(np.frombuffer(x, "<i4"))
                if with_ends:
                    columns[1].append(codec.offsets(x))
            arrays = [pa.array(x, kind) for x, (_, kind, _) in zip(columns, made, strict=False)]
            fields = [batch.schema.field(i) for i in range(len(kept))] + [(n, kind) for n, kind, _ in made]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], schema=pa.schema(fields))

    return slim.mapInArrow(task, schema)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """encoded plus the bytes of its ids."""
    shared = _shared(encoded.sparkSession, vocabulary)
    slim = encoded.select(*[c for c in encoded.columns if c != out])
    schema = T.StructType([*slim.schema.fields, T.StructField(out, T.BinaryType())])

    def task(batches):
        codec = _codec(shared)
        for batch in slices(batches):
            made = [codec.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], schema=pa.schema([*batch.schema, (out, pa.binary())]))

    return slim.mapInArrow(task, schema)


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: n_tokens, the digest of its ids and, after decoding
    them again, of the decoded bytes.  Ids stay on the executor."""
    spark = docs.sparkSession
    shared = _shared(spark, vocabulary)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", slim.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def task(batches):
        codec = _codec(shared)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            rows = [(len(x) // 4, sha(x), sha(codec.decode(x))) for x in codec.encode(texts)]
            n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return slim.mapInArrow(task, schema)
