"""Equi-joins that hold when one key has a large share of the rows.

The left side's key is profiled first, and only as far as needed: its rows are counted without
a shuffle; if they are many, its key hashes are counted too. One row of
figures goes to the driver, and the plan follows from it:

* no hot key: a plain equi-join;
* hot keys: their rows are dealt over several parts, and only the right
  side's rows of those keys are repeated, once per part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 1_000_000  # rows of one key that one task may take
MAX_HOT_KEYS = 10_000  # bound of the broadcast list of hot keys
MAX_BROADCAST_KEYS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class KeyProfile:
    """Upper bounds: rows, distinct keys, rows of the hottest key, bytes of the distinct keys."""

    rows: int
    keys: int
    hottest: int
    key_bytes: int

    @property
    def fits_broadcast(self) -> bool:
        return self.keys <= MAX_BROADCAST_KEYS and self.key_bytes <= MAX_BROADCAST_BYTES

    def hot_rows(self, hot_rows: int) -> int:
        """Rows from which a key is hot: never more than MAX_HOT_KEYS keys can reach it."""
        return max(hot_rows, -(-self.rows // MAX_HOT_KEYS))


def profile_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> KeyProfile:
    length = F.coalesce(F.octet_length(F.col(key)), F.lit(0))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(length), F.lit(0))).first()
    all_rows = KeyProfile(rows, rows, rows, size)
    if rows <= hot_rows and all_rows.fits_broadcast:
        return all_rows
    # Eight bytes per key are shuffled, not the keys; partial counts come first.
    per_key = df.groupBy(F.xxhash64(key).alias("h")).agg(F.count("*").alias("n"), F.max(length).alias("b"))
    row = per_key.agg(F.count("*"), F.max("n"), F.sum("b")).first()
    return KeyProfile(rows, *row)


def _plain_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]


class HotKeys:
    """Parts for the hot keys of the left side of a join."""

    LEFT_PART, RIGHT_PART = "_left_part", "_right_part"

    def __init__(self, left: DataFrame, key: str, profile: KeyProfile, hot_rows: int):
        self.key = key
        limit = profile.hot_rows(hot_rows)
        self.any = profile.hottest > limit
        if self.any:
            self.list = (
                left.groupBy(F.col(key).alias("_hot"))
                .agg(F.ceil(F.count("*") / F.lit(limit)).cast("int").alias("_parts"))
                .filter(F.col("_parts") > 1)
            )

    def _parts(self, df, key):
        listed = df.join(F.broadcast(self.list), F.col(key).eqNullSafe(F.col("_hot")), "left")
        return listed.drop("_hot")

    def deal(self, left: DataFrame) -> DataFrame:
        """Give each left row its part.

        The row's hash parts different rows and the partition number parts exact copies; both
        are the same when a task is run again.
        """
        if not self.any:
            return left
        parts = F.coalesce(F.col("_parts"), F.lit(1)).cast("bigint")
        mixed = F.pmod(F.xxhash64(*_plain_columns(left)), parts) + F.spark_partition_id()
        part = F.pmod(mixed, parts).cast("int")
        return self._parts(left, self.key).withColumn(self.LEFT_PART, part).drop("_parts")

    def repeat(self, right: DataFrame, key: str) -> DataFrame:
        """Repeat the right rows of hot keys once per part; reduce copies before, not after."""
        if not self.any:
            return right
        parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
        return self._parts(right, key).withColumn(self.RIGHT_PART, F.explode(parts)).drop("_parts")

    def join(self, left: DataFrame, right: DataFrame, equal, how: str) -> DataFrame:
        """Join sides that went through `deal` and `repeat`, as a sort-merge join.

        Neither side has a bound on its bytes. What Spark guesses from the size of compressed files, with columns left out, is
        a small share of what the rows take, and would send millions of them through the driver as a broadcast.
        """
        right = right.hint("merge")
        if not self.any:
            return left.join(right, equal, how)
        same_part = F.col(self.LEFT_PART) == F.col(self.RIGHT_PART)
        return left.join(right, equal & same_part, how).drop(self.LEFT_PART, self.RIGHT_PART)


def _null_safe(key, names):
    value = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return value.alias(names[0]), F.col(key).isNull().alias(names[1])


def hot_join(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    how: str,
    null_safe: bool = False,
    distinct: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join `left_key = right_key`, dealing out hot left keys.

    `distinct` first reduces the right side to its distinct keys. The two
    sides must not share column names.
    """
    hot = HotKeys(left, left_key, profile_keys(left, left_key, hot_rows), hot_rows)
    left_on, right_on = [left_key], [right_key]
    if null_safe:
        # The columns `<=>` would be split into: named here, so that the distinct keys and
        # the join share one shuffle.
        left_on, right_on = ["_left_key", "_left_null"], ["_right_key", "_right_null"]
        left = left.select("*", *_null_safe(left_key, left_on))
        right = right.select("*", *_null_safe(right_key, right_on))
    if distinct:
        right = right.select(*right_on, *([right_key] if hot.any and null_safe else [])).distinct()
    left, right = hot.deal(left), hot.repeat(right, right_key)
    equal = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(left_on, right_on)])
    joined = hot.join(left, right, equal, how)
    return joined.drop("_left_key", "_left_null", "_right_key", "_right_null") if null_safe else joined
