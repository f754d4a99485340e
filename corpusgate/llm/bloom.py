"""A Bloom filter of bounded size over 64-bit values, filled in the cluster and sent to all tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codes import mix

#: Bits for each value, and the bounds of the filter's size in words of 64 bits: 32 KB to 64 MB. With more values than
#: fit it lets more through, and nothing is lost by that.
BITS_A_VALUE, LEAST_WORDS, MOST_WORDS = 16, 1 << 12, 1 << 23
#: The filter travels in compressed blocks of up to so many words, and those of so many tasks are put together first.
BLOCK, TASKS = 1 << 14, 256


def _bits(values: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter's bits of each value, by two hashes."""
    v = values.view(np.uint64) if values.dtype == np.int64 else values
    n = np.uint64(words * 64)
    return mix(v) % n, mix(v ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % n


def bloom(values: DataFrame, bits: int = BITS_A_VALUE) -> np.ndarray:
    """Bloom filter over a column ``value`` of a written or persisted table, put together in the cluster block by block.

    Fewer ``bits`` for each row do where most values stand in several rows.
    The driver gets whole blocks, a partition of them at a time: as rows of its
    words the largest filter took more memory than a driver has.
    """
    need = values.count() * bits // 64
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << need.bit_length()))
    block = min(BLOCK, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(words, dtype=np.uint64)
        for b in batches:
            for bit in _bits(b.column("value").to_numpy(), words):
                np.bitwise_or.at(filled, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        blocks = filled.reshape(-1, block)
        for i in np.flatnonzero(blocks.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([_packed(blocks[i])], pa.binary())], names=["block", "filled"])

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        whole = np.zeros(block, dtype=np.uint64)
        for f in frame["filled"]:
            whole |= _unpacked(f, block)
        return pd.DataFrame({"block": frame["block"].iloc[:1], "part": -1, "filled": [_packed(whole)]})

    schema = "block long, part int, filled binary"
    parts = values.select("value").mapInArrow(run, "block long, filled binary").withColumn("part", (F.spark_partition_id() / TASKS).cast("int"))
    whole = parts.groupBy("block", "part").applyInPandas(joined, schema).groupBy("block").applyInPandas(joined, schema)
    out = np.zeros((words // block, block), dtype=np.uint64)
    for r in whole.select("block", "filled").toLocalIterator():
        out[r.block] = _unpacked(r.filled, block)
    return out.ravel()


def _packed(block: np.ndarray) -> bytes:
    return pa.compress(block.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, words: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, words * 8, codec="zstd", asbytes=True), dtype=np.uint64)


def passes(filled: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values may be in the filter; those that are in it always pass."""
    ok = np.ones(len(values), dtype=bool)
    for bit in _bits(values, len(filled)):
        ok &= (filled[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return ok
