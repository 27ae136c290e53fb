"""A Bloom filter of fixed size over 64-bit hashes, built by Spark.

Its size is a parameter and never grows with the data, so it may be broadcast.
It only saves work: a key of the set is always found, and a false positive
costs a row that the exact step after it throws out.  The keys are hashes
already, so their top bits and their low bits serve as the two probes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build(keys: DataFrame, column: str, log2_bits: int = 26) -> np.ndarray:
    """The filter's 64-bit words for a column of hashes (long).  The bits of a
    word are joined before the shuffle, so no key or word is hot; the driver
    gets at most 2^log2_bits bits (8 MB by default)."""
    if not 6 < log2_bits <= 32:
        raise ValueError("the two probes need 7 to 32 bits each")
    key = F.col(column)
    probes = F.array(F.shiftrightunsigned(key, 64 - log2_bits),
                     key.bitwiseAND(F.lit((1 << log2_bits) - 1).cast("long")))
    words = (keys.select(F.explode(probes).alias("bit"))
             .groupBy(F.shiftrightunsigned("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")))
    table = words.toArrow()
    out = np.zeros(1 << (log2_bits - 6), np.int64)
    if table.num_rows:
        out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def contains(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may be in the set."""
    log2_bits = int(len(words)).bit_length() - 1 + 6
    found = np.ones(len(keys), bool)
    for bit in (keys >> np.uint64(64 - log2_bits), keys & np.uint64((1 << log2_bits) - 1)):
        found &= (words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
    return found
