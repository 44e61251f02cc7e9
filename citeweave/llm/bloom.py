"""A bit table of hashes: of bounded size, built by Spark, so that it may be broadcast whatever the input.

It only spares work: a hash that is in the set always passes, others mostly do not.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 20, 27  # 128 KB to 16 MB, as powers of two


def bit_table(hashes: DataFrame, column: str, rows: int | None = None) -> np.ndarray:
    """Bits of a stored column of 64-bit hashes; about 16 bits a hash, within the bounds."""
    rows = hashes.count() if rows is None else rows
    bits = min(max(int(16 * max(rows, 1)).bit_length(), LEAST_BITS), MOST_BITS)
    place = F.col(column).bitwiseAND((1 << bits) - 1)
    words = (
        hashes.filter(F.col(column).isNotNull())
        .select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        # At most 2^21 rows, whatever the input; sixty-four neighbours go as one row.
        .groupBy(F.shiftright("w", 6).alias("g"))
        .agg(F.collect_list("w").alias("w"), F.collect_list("b").alias("b"))
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    for row in words.toLocalIterator():
        table[np.array(row.w)] = np.array(row.b, np.int64)
    return table.view(np.uint64)


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * len(table) - 1)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
