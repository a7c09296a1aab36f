"""Sets of keys as bits, so that rows whose key is not there need no shuffle.

A bit is found by the leading bits of a key, so other keys may share it: what is not in
the bitmap is not in the set, and what is in it must still be joined.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A bitmap has 16 bits for each key, within these powers of two.
LEAST_BITS, MOST_BITS = 16, 24


def bitmap(keys: DataFrame) -> tuple[np.ndarray, int]:
    """Bits by the leading bits of `key`, a mixed long. At most 2 ** MOST_BITS of them."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * keys.count() + 1))))
    place = F.shiftrightunsigned("key", 64 - bits + 6).cast("int").alias("place")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    rows = keys.groupBy(place).agg(F.bit_or(bit).alias("bits")).toPandas()
    table[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return table.view(np.uint64), bits


def found(table: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each of `keys`."""
    lead = keys.view(np.uint64) >> np.uint64(64 - bits)
    return (table[(lead >> np.uint64(6)).astype(np.int64)] >> (lead & np.uint64(63)) & np.uint64(1)).astype(bool)


def may_hold(ids: DataFrame, column: str = "doc_id") -> Column:
    """A condition on rows with `column`: false only if `ids` does not have it. Null has
    no place there. The bitmap is one constant of the plan, bounded by MOST_BITS."""
    key = F.xxhash64(F.col(column).cast("long"))
    table, bits = bitmap(ids.select(key.alias("key")))
    numbers = F.split(F.lit(",".join(map(str, table.view(np.int64).tolist()))), ",").cast("array<bigint>")
    place = F.shiftrightunsigned(key, 64 - bits + 6).cast("int")
    bit = F.shiftrightunsigned(key, 64 - bits).bitwiseAND(F.lit(63)).cast("int")
    return F.col(column).isNotNull() & (F.getbit(F.get(numbers, place), bit) == 1)
