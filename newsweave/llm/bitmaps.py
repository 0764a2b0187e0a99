"""Bounded bitmaps of keys, sent to the scans as a first filter before an exact join."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MOST_BITS = 30  # 128 MB


def bitmap(keys: DataFrame, column: str) -> Broadcast:
    """A bit per key, about 64 bits a key and 2**30 bits at most; other keys may share a bit, none is missed."""
    spark = keys.sparkSession
    bits = int(min(_MOST_BITS, max(16, 6 + np.ceil(np.log2(max(1, keys.count()))))))
    slot = F.pmod(F.col(column), F.lit(1 << bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(63).cast("int"))
    found = np.zeros(1 << (bits - 6), np.uint64)
    words = keys.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    found[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(found)


def holds(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
