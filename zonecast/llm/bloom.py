"""A Bloom filter of fixed size, built by Spark and broadcast.

It only thins out rows ahead of an exact join: the fuller it gets, the more
rows go through, and no row that belongs is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.groups import column
from zonecast.llm.textbytes import mix

PROBES = 3


def _bit(keys: np.ndarray, j: int, bits: int) -> np.ndarray:
    return (mix(keys.view(np.uint64) + np.uint64(j)) & np.uint64(bits - 1)).astype(np.int64)


def build(keys: DataFrame, key: str, bits: int) -> bytes:
    """The filter of a long column: ``bits / 8`` bytes (``bits`` a power of two), at most ``bits / 32`` rows to the driver."""
    def run(batches):
        for batch in batches:
            k = column(batch, "k").to_numpy()
            if len(k):
                bit = np.unique(np.concatenate([_bit(k, j, bits) for j in range(PROBES)]))
                yield pa.RecordBatch.from_arrays([pa.array(bit >> 5), pa.array(np.int64(1) << (bit & 31))], names=["word", "bits"])
    picked = keys.select(F.col(key).alias("k")).where("k is not null")
    got = picked.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(bits // 32, np.uint32)
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().astype(np.uint32)
    return table.tobytes()


def contains(table: bytes, keys: np.ndarray) -> np.ndarray:
    """Which of the (int64) keys may be in the filter."""
    words = np.frombuffer(table, np.uint32)
    ok = np.ones(len(keys), bool)
    for j in range(PROBES):
        bit = _bit(keys, j, len(words) * 32)
        ok &= (words[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
    return ok
