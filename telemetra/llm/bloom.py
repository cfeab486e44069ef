"""Bloom filters of one fixed size over 64-bit keys: rows that surely meet nothing are dropped before a shuffle.

A filter has 2 ** BLOOM_BITS bits (8 MB) however many keys it holds, so it may be broadcast. Beyond some ten million
keys it lets more and more rows pass; the join behind it decides, so results do not depend on it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOOM_BITS = 26


def bloom_slots(key):
    """The two bits of a key: (64-bit slot, bit) each."""
    mask = np.uint64((1 << BLOOM_BITS) - 1)
    for shift in (0, 32):
        bit = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(shift) & mask
        yield (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)


def _bloom_rows(batches):
    bits = np.zeros(1 << (BLOOM_BITS - 6), np.uint64)
    for batch in batches:
        for slot, bit in bloom_slots(batch.column("key").to_numpy().view(np.uint64)):
            np.bitwise_or.at(bits, slot, np.uint64(1) << bit)
    slot = np.flatnonzero(bits)
    for at in range(0, len(slot), 1 << 16):
        part = slot[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(bits[part].view(np.int64))], names=["slot", "bits"])


def bloom_filter(keys: DataFrame) -> bytes:
    """The filter over the column ``key`` of ``keys``."""
    merged = keys.select("key").mapInArrow(_bloom_rows, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    table = merged.toArrow()
    bits = np.zeros(1 << (BLOOM_BITS - 6), np.uint64)
    bits[table["slot"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return bits.tobytes()


def bloom_hits(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the filter."""
    hit = np.ones(len(key), bool)
    for slot, bit in bloom_slots(key):
        hit &= (bits[slot] >> bit & np.uint64(1)).astype(bool)
    return hit
