"""Bit tables of bounded size, sent to tasks to spare work: false hits are for the caller to verify."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bit table: this many for each entry, within these bounds (32 MB at most).
BITS_EACH, LEAST_BITS, MOST_BITS, BLOCK_BITS = 16, 1 << 20, 1 << 28, 1 << 19


def may_have(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be among those that the table was made of."""
    at = h & np.uint64(8 * len(table) - 1)
    return table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def bit_table(hashes: DataFrame) -> np.ndarray:
    """The bits as bytes, from a DataFrame of one long column; tasks make whole blocks, of which the driver gets MOST_BITS at most.

    A plain array, so that a task that gets it needs no code of this package."""
    size = LEAST_BITS
    n = hashes.count()
    while size < min(MOST_BITS, BITS_EACH * n):
        size *= 2
    bits = hashes.select(F.col(hashes.columns[0]).bitwiseAND(F.lit(size - 1)).alias("bit")).withColumn("block", F.expr(f"bit div {BLOCK_BITS}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            at, block = (b.column(c).to_numpy() for c in ("bit", "block"))
            for i in np.unique(block).tolist():
                place = at[block == i] - i * BLOCK_BITS
                np.bitwise_or.at(found.setdefault(i, np.zeros(BLOCK_BITS // 8, np.uint8)), place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["block", "bytes"])

    made = bits.distinct().repartition(max(1, min(64, size // BLOCK_BITS)), "block").mapInArrow(run, "block long, bytes binary")
    table = np.zeros(size // 8, np.uint8)
    for r in made.collect():
        table[r.block * (BLOCK_BITS // 8) : (r.block + 1) * (BLOCK_BITS // 8)] = np.frombuffer(r.bytes, np.uint8)
    return table
