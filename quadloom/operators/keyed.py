"""Keys to join on, placed so that a hot one on the other side can be divided.

At run time Spark divides a hot key of a sort-merge join, but only where both
sides come straight from a shuffle for that join. A side that was grouped or
joined by the same key first is used as it lies, with no shuffle of its own,
and then nothing is divided. Grouping by a struct of the key instead makes the
planner place the result, by now one narrow row per key, anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegralType, StringType, TimestampNTZType

from quadloom.functions.times import epoch_micros
from quadloom.session import written_with

# Most bytes of keys sent to all executors, and what a key takes beside its text.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 64
# Bits of a filter of keys, 64 MiB, and how many there are for a key at least.
FILTER_BITS = 1 << 29
BITS_PER_KEY = 8
# Fixed value: bits in one bitmap of the bitmap functions.
_BITMAP = 32_768
# An order key holds an instant, then a whole number in so many values.
_NUMBERS = 10**20
_BEFORE_ALL = -9 * 10**17


def distinct_keys(df: DataFrame, *names: str) -> DataFrame:
    """Distinct values of the columns (by default ``identifier``), by a shuffle on all of them.

    A plain ``distinct`` after a join on some of the columns keeps the join's
    partitions, and with them its hot ones.
    """
    names = names or ("identifier",)
    return df.select(F.struct(*names).alias("k")).distinct().select("k.*")


def per_key(df: DataFrame, names: list[str], **aggregates: Column) -> DataFrame:
    """``df`` aggregated by the key columns, to the columns named."""
    values = [column.alias(name) for name, column in aggregates.items()]
    return df.groupBy(F.struct(*names).alias("k")).agg(*values).select("k.*", *aggregates)


def rows_with_keys(
    df: DataFrame,
    ids: DataFrame,
    how: str = "left_semi",
    key: str = "identifier",
    broadcast_bytes: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``df`` with the keys in ``ids`` only, or without them (``how="left_anti"``).

    A first job writes the distinct keys (``key``, or the columns ``keys``),
    which measures them. Those of no more than ``broadcast_bytes`` (by default
    ``BROADCAST_BYTES``) are broadcast, so that no row of a wide table moves;
    more are joined by a shuffle.
    """
    names = list(keys) or [key]
    asked = picked(distinct_keys(ids, *names), "keys")
    most = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    return df.join(F.broadcast(asked.rows) if asked.bytes <= most else asked.rows, names, how)


def parts_without_keys(df: DataFrame, ids: DataFrame, key: str = "identifier") -> tuple[DataFrame | None, DataFrame | None]:
    """``rows_with_keys(df, ids, "left_anti", key=key)`` in two parts: rows that lie where they were, and rows a shuffle has moved."""
    asked = picked(distinct_keys(ids, key), "keys")
    far, near = asked.apart(df, [key])
    left = near.join(asked.hinted(), key, "left_anti")
    return (left, None) if asked.small else (far, left)


def order_key(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One DECIMAL(38,0) that sorts like the columns ``order``, nulls first; None where their types need more.

    They are an instant, a whole number, or an instant and a whole number. A
    hash aggregate keeps the greatest of such keys in place, which it cannot do
    for structs.
    """
    types = [df.schema[c].dataType for c in order]
    instants = [isinstance(t, TimestampNTZType) for t in types]
    numbers = [isinstance(t, IntegralType) for t in types]
    if (instants, numbers) not in (([], []), ([True], [False]), ([False], [True]), ([True, False], [False, True])):
        return None
    wide = "decimal(38,0)"
    instant = number = F.lit(0).cast(wide)
    for name, is_instant in zip(order, instants):
        if is_instant:
            instant = F.coalesce(epoch_micros(name), F.lit(_BEFORE_ALL)).cast("decimal(18,0)") * F.lit(str(_NUMBERS)).cast("decimal(21,0)")
        else:
            above = F.col(name).cast("decimal(20,0)") + F.lit(str(2**63 + 1)).cast("decimal(20,0)")
            number = F.coalesce(above, F.lit(0)).cast(wide)
    return (instant.cast(wide) + number).cast(wide)


def may_match(df: DataFrame, keys: DataFrame, on: Sequence[str], bits: int | None = None, others: bool = False) -> DataFrame:
    """``df`` without most rows whose key is not in ``keys``; none whose key is there is lost. ``others``: the rows left out.

    A hash of each key sets one of ``bits`` bits. The bitmaps, which are sent
    to all executors, never take more than one bit for each, whatever the number of keys.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(bits or FILTER_BITS))
    bitmap, bit = F.floor(place / _BITMAP).alias("_bitmap"), F.pmod(place, F.lit(_BITMAP)).alias("_bit")
    made = keys.select(bitmap, bit).groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), F.pmod("_bit", F.lit(8)).cast("int")) == 1
    met = df.select("*", bitmap, bit).join(F.broadcast(made), "_bitmap", "left" if others else "inner")
    return met.filter(~F.coalesce(is_set, F.lit(False)) if others else is_set).select(*df.columns)


@dataclass
class Picked:
    """Narrow rows, written once, and what they measure."""

    rows: DataFrame
    count: int
    bytes: int

    @property
    def small(self) -> bool:
        """Whether the rows may be sent to all executors."""
        return self.bytes <= BROADCAST_BYTES

    def hinted(self) -> DataFrame:
        return F.broadcast(self.rows) if self.small else self.rows

    def pruned(self, df: DataFrame, on: Sequence[str]) -> DataFrame:
        """``df`` ahead of a shuffle to meet the rows: filtered, if there are not too many keys for that."""
        return df if self.small or not self.told_apart else may_match(df, self.rows, on)

    @property
    def told_apart(self) -> bool:
        """Whether the bits of a filter are enough for so many keys."""
        return self.count * BITS_PER_KEY <= FILTER_BITS

    def apart(self, df: DataFrame, on: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
        """``df`` in two parts: rows that meet none of the rows for certain, which need not move, and the rest.

        None for the first where the rest is all: the rows are broadcast, or too many for a filter.
        """
        if self.small or not self.told_apart:
            return None, df
        return may_match(df, self.rows, on, others=True), may_match(df, self.rows, on)

    def met(self, df: DataFrame, key: str = "identifier") -> DataFrame:
        """``df`` where its key is in the rows. No row of it moves if they are small, or told apart by a filter.

        What a filter lets through wrongly is found on distinct keys alone, and
        taken out again by broadcast.
        """
        keys = self.rows.select(key)
        if self.small or not self.told_apart:
            return df.join(F.broadcast(keys) if self.small else keys, key, "left_semi")
        near = may_match(df.filter(F.col(key).isNotNull()), keys, [key])
        wrong = picked(distinct_keys(near, key).join(keys, key, "left_anti"), "wrong")
        return near.join(F.broadcast(wrong.rows), key, "left_anti") if wrong.small else near.join(keys, key, "left_semi")


def total_bytes(df: DataFrame) -> Column:
    """An aggregate: about what the rows of ``df`` take in memory."""
    texts = [F.octet_length(f.name) for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    return sum((F.coalesce(F.sum(t), F.lit(0)) for t in texts), F.count(F.lit(1)) * ROW_BYTES)


def picked(narrow: DataFrame, name: str = "picked") -> Picked:
    rows, seen = written_with(narrow, name, bytes=total_bytes(narrow), count=F.count(F.lit(1)))
    return Picked(rows, seen["count"], seen["bytes"])


def fetch(df: DataFrame, found: Picked, on: Sequence[str]) -> DataFrame:
    """Rows of a wide table with their row of ``found``, one for each key; of rows alike in ``on`` one.

    A small ``found`` is broadcast, so that no row moves which isn't picked.
    Of a larger one, up to a number of keys that ``FILTER_BITS`` bits tell
    apart, a filter leaves little more than the rows picked to be joined by a
    shuffle. Beyond that all rows are. Nulls in a key are equal.
    """
    more = [c for c in found.rows.columns if c not in on]
    key = F.struct(*on).alias("_key")
    wide = found.pruned(df, on).select("*", key)
    keys = found.hinted().select(key, *more)
    # rows alike in their key: by a hash of what they hold, so that the choice is always the same
    alike = Window.partitionBy("_key").orderBy(F.xxhash64(*(F.col(c) for c in df.columns)))
    met = wide.join(keys, "_key").withColumn("_alike", F.row_number().over(alike))
    return met.filter("_alike = 1").select(*df.columns, *more)
