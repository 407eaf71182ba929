"""Hash families and signatures as native Columns.

Every 64-bit value is a long with the same bits.  MinHash compares values, so its
hashes keep 60 bits and are never negative."""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col


def md5_60(x) -> Column:
    """The first 15 hex digits of MD5 as a number."""
    return F.conv(F.substring(F.md5(col(x)), 1, 15), 16, 10).cast("long")


def md5_64(x) -> Column:
    """The first 16 hex digits of MD5, as a long with those bits."""
    return F.conv(F.substring(F.md5(col(x)), 1, 16), 16, -10).cast("long")


def stride(count: Column, most: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / most)).cast("int")


def grams(x, size: int, most: int | None = None, distinct: bool = True) -> Column:
    """Character n-grams, at most `most` of them at an even stride; a shorter text is its own gram, an empty one has none."""
    text = col(x)
    n = F.length(text) - (size - 1)
    if most:
        long = F.transform(F.sequence(F.lit(1), n, stride(n, most)), lambda i: F.substr(text, i, F.lit(size)))
    else:  # one pass over the text; substrings by position would each count code points from its start
        long = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1))
    every = F.when(n > 1, long).when(F.length(text) > 0, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(every) if distinct else every


def windows(x, size: int = 80, step: int = 40) -> Column:
    """Substrings of `size` at every `step`, none of a shorter text."""
    text = col(x)
    n = F.length(text) - (size - 1)
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n, F.lit(step)), lambda i: F.substr(text, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


#: 8-byte digests of a gram, by name: the first half of MD5, BLAKE2b, and BLAKE2b with the seed 0 before the gram.
DIGESTS = {
    "md5": lambda b: hashlib.md5(b).digest()[:8],
    "blake2b": lambda b: hashlib.blake2b(b, digest_size=8).digest(),
    "seeded": lambda b: hashlib.blake2b(bytes(8) + b, digest_size=8).digest(),
}

#: Digests of the grams seen last, by name: most return in many texts.
_SEEN: dict[str, dict[str, bytes]] = {}


def simhash_of(text: str, size: int = 3, most: int = 256, window: int = 0, digest: str = "md5", distinct: bool = False, of_empty: bool = False) -> int:
    """64-bit SimHash of a text's character grams, at most `most` at an even stride; a
    shorter text is its own gram, an empty one too if of_empty, else it has 0.  Of a
    text longer than `window` (if any) its ends count, joined by a marker.  A bit is
    set on a tie."""
    if window and len(text) > window:
        text = text[: window // 2] + "\n<simhash-window>\n" + text[-(window // 2) :]
    n = len(text) - size + 1
    cut = [text[i : i + size] for i in range(0, n, max(1, -(-n // most)))] if n > 0 else [text] if text or of_empty else []
    cut = set(cut) if distinct else cut
    if not cut:
        return 0
    hash_, seen = DIGESTS[digest], _SEEN.setdefault(digest, {})
    if len(seen) > 1 << 16:
        seen.clear()
    for g in cut:
        if g not in seen:
            seen[g] = hash_(g.encode())
    bits = np.unpackbits(np.frombuffer(b"".join(map(seen.__getitem__, cut)), np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) >= len(bits)).tobytes(), "big", signed=True)


def simhash(x, nfkc: bool = False, **how) -> Column:
    """simhash_of as a Column, in Arrow batches; with nfkc, of the text's NFKC form."""
    import unicodedata

    @F.pandas_udf(T.LongType())
    def sign(texts: pd.Series) -> pd.Series:
        form = (lambda s: s if s.isascii() else unicodedata.normalize("NFKC", s)) if nfkc else (lambda s: s)
        return texts.map(lambda s: simhash_of(form(s or ""), **how))

    return sign(col(x))


def hamming(a, b) -> Column:
    return F.bit_count(col(a).bitwiseXOR(col(b)))


#: Blocks (first bit, bits) of a signature: of any three bits that differ, three blocks know nothing.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))


def block_keys(sig) -> Column:
    """(triple, value) structs: any three of the six BLOCKS together, about 32 bits each,
    so that signatures up to three bits apart share one and few others do."""
    s = col(sig)
    cut = [F.shiftrightunsigned(s, at).bitwiseAND((1 << width) - 1) for at, width in BLOCKS]
    triples = list(combinations(range(6), 3))
    return F.array(*[F.struct(F.lit(i).alias("triple"), F.shiftleft(cut[a], 22).bitwiseOR(F.shiftleft(cut[b], 11)).bitwiseOR(cut[c]).alias("value")) for i, (a, b, c) in enumerate(triples)])


def first_triple(a, b, triple) -> Column:
    """Whether triple is the first in which all three BLOCKS of a and b are equal, given that one is."""
    x = col(a).bitwiseXOR(col(b))
    same = reduce(Column.bitwiseOR, [F.when(x.bitwiseAND(signed64(((1 << width) - 1) << at)) == 0, 1 << i).otherwise(0) for i, (at, width) in enumerate(BLOCKS)])
    triples = list(combinations(range(6), 3))
    own = F.get(F.array(*[F.lit(sum(1 << i for i in t)) for t in triples]), col(triple))
    upto = F.get(F.array(*[F.lit((2 << t[-1]) - 1) for t in triples]), col(triple))
    return same.bitwiseAND(upto) == own


def signed64(x: int) -> int:
    """The long with the bits of an unsigned number."""
    return x - (1 << 64) if x >> 63 else x


def bands(sig, count: int = 4, width: int = 16) -> Column:
    """(band, value) structs of a 64-bit signature."""
    s = col(sig)
    return F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(s, width * i).bitwiseAND((1 << width) - 1).alias("value")) for i in range(count)])


#: The field of the MinHash permutations.
PRIME = (1 << 31) - 1


def permutations(rows: int) -> list[tuple[int, int]]:
    """Factor and shift of each permutation h -> h * a + b of the field, drawn by MD5."""
    draw = lambda kind, s: int(hashlib.md5(f"{kind}:{s}".encode()).hexdigest()[:7], 16)
    return [(1 + draw("a", s), draw("b", s)) for s in range(rows)]


def minhash(hashes, rows: int = 128) -> Column:
    """Signature of 60-bit gram hashes under `rows` random affine permutations of a prime field."""
    low = F.transform(col(hashes), lambda h: F.pmod(h, F.lit(PRIME)))
    pairs = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in permutations(rows)])
    return F.transform(pairs, lambda s: F.array_min(F.transform(low, lambda h: F.pmod(h * s["a"] + s["b"], F.lit(PRIME)))))


def minhash_similarity(a, b) -> Column:
    same = F.size(F.filter(F.zip_with(col(a), col(b), lambda x, y: x == y), lambda t: t))
    return same / F.greatest(F.size(col(a)), F.lit(1))


def band_keys(sig, count: int = 32, rows: int = 4) -> Column:
    s = col(sig)
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda b: F.concat_ws(":", b.cast("string"), F.array_join(F.slice(s, b * rows + 1, F.lit(rows)).cast("array<string>"), ",")))
