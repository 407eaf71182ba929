"""A once-seen and a twice-seen Bloom filter over 64-bit hashes.

Hashes go to owners by hash.  Each owner streams its share past a once-seen filter,
sized for the share; a hash that is met there already is a repeat, or seldom a false
one.  Owners are as many as the hashes ask, so neither the filters nor the tasks grow
with the input.  The repeats alone, far fewer than the hashes, make the twice-seen
filter, which tasks then test their own keys against.  It has a fixed most size;
where even the repeats overfill it, more keys pass and nothing is lost."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hashes of one owner, bits of its filter for each (a byte holds one, while it works), and bits that a hash sets.
OWNER, ONCE_BITS, HASHES = 1 << 20, 16, 4
#: Bits of the twice-seen filter for each repeat, between two powers of two.
TWICE_BITS, LEAST_LOG2, MOST_LOG2 = 12, 17, 28
#: Bits of one block of it, which a task makes whole.
BLOCK_LOG2 = 16
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def places(h: np.ndarray, log2: int) -> list[np.ndarray]:
    """The bits of each hash, all in the block that its highest bits name."""
    inner = min(log2, BLOCK_LOG2)
    h = h.view(np.uint64)
    block = (h >> np.uint64(64 - log2)) >> np.uint64(inner) << np.uint64(inner)
    out = []
    for _ in range(HASHES):
        h = h * FACTOR + np.uint64(1)
        h ^= h >> np.uint64(29)
        out.append((block | (h >> np.uint64(64 - inner))).astype(np.int64))
    return out


def _once(log2: int):
    def task(batches):
        bits = np.zeros(1 << log2, bool)
        for batch in batches:
            h, n = np.unique(batch.column("h").to_numpy(), return_counts=True)
            at = places(h, log2)
            met = np.logical_and.reduce([bits[x] for x in at])
            for x in at:
                bits[x] = True
            met |= n > 1
            if met.any():
                yield pa.RecordBatch.from_arrays([pa.array(h[met])], ["h"])

    return task


def repeats(hashes: DataFrame, most: int) -> DataFrame:
    """Distinct values of the long column h that occur more than once, and few others.
    most is a bound or an estimate of the rows; it sets the number of owners."""
    owners = max(1, -(-most // OWNER))
    log2 = int(np.ceil(np.log2(min(max(most, 1 << 10), OWNER) * ONCE_BITS)))
    return hashes.select("h").repartition(owners, "h").mapInArrow(_once(log2), "h long").distinct()


def twice_seen(repeated: DataFrame) -> tuple[int, bytes]:
    """log2 of the bits, and the filter of the column h of a materialized table:
    2^MOST_LOG2 bits (32 MB) at most, so it can be broadcast."""
    log2 = int(np.clip(np.ceil(np.log2(max(1, repeated.count()) * TWICE_BITS)), LEAST_LOG2, MOST_LOG2))

    def build(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.concatenate(places(batch.column("h").to_numpy(), log2))
            for b in np.unique(at >> BLOCK_LOG2).tolist():
                held.setdefault(b, np.zeros(1 << BLOCK_LOG2, bool))[at[at >> BLOCK_LOG2 == b] & ((1 << BLOCK_LOG2) - 1)] = True
        for b, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["at", "bits"])

    # the hashes of a block meet in one task, so each block is sent once
    blocks = 1 << (log2 - BLOCK_LOG2)
    dealt = repeated.select("h").repartition(min(blocks, 64), F.shiftrightunsigned("h", 64 - (log2 - BLOCK_LOG2)))
    out, width = np.zeros(1 << (log2 - 3), np.uint8), 1 << (BLOCK_LOG2 - 3)
    for row in dealt.mapInArrow(build, "at long, bits binary").toArrow().to_pylist():
        out[row["at"] * width : (row["at"] + 1) * width] |= np.frombuffer(row["bits"], np.uint8)
    return log2, out.tobytes()


def passes(twice: tuple[int, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Whether each hash may be a repeat; twice has the bits as uint8."""
    log2, bits = twice
    return np.logical_and.reduce([(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) for at in places(h, log2)])
