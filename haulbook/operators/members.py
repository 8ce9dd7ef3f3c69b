"""A membership filter of bounded size, applied before a large table is aggregated or shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulbook.operators.sizes import estimated_bytes

FILTER_FROM = 64 << 20  # bytes, by Spark's estimate, from which a table is worth a filter computed first
WORD_BITS = 32_768  # bits of one bitmap of Spark's bitmap functions
BITMAPS = 1024  # 4 MB in all, whatever the number of keys


def _places(key: Column) -> tuple[Column, Column]:
    """The bitmap of a key, from 0, and the bit in it."""
    place = F.pmod(F.xxhash64(key.cast("string")), F.lit(WORD_BITS * BITMAPS))
    return F.call_function("div", place, F.lit(WORD_BITS)).cast("int"), (place % WORD_BITS).cast("int")


def member_bitmaps(keys: DataFrame, key: str) -> DataFrame:
    """One row with one array: the bitmaps of all keys. Tasks combine their bits before they meet."""
    bitmap, bit = _places(F.col(key))
    every = keys.sparkSession.range(BITMAPS).select(F.col("id").cast("int").alias("at"), F.lit(None).cast("bigint").alias("bit"))
    marks = keys.dropna(subset=[key]).select(bitmap.alias("at"), bit.cast("bigint").alias("bit")).unionByName(every)
    bitmaps = marks.groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return bitmaps.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda x: x["bits"]).alias("bitmaps"))


def possible_members(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may occur in ``keys``: all that do and, of a large table, few others.

    A table that Spark estimates below FILTER_FROM is returned as it is, less null keys: the filter takes a job of its own before
    the scan, which is more than such a table costs. Otherwise there is one bit per key in a filter of 4 MB, which Spark computes first and
    evaluates in the scan's stage, so that rows which match nothing are neither aggregated nor shuffled. Some 3 % of the others pass
    with a million keys, a quarter with ten million; far beyond that the filter lets most pass and costs a hash per row, and
    facts bucketed by ``key`` are the way to avoid the shuffle. A null key is no member. A join still has to decide.
    """
    if estimated_bytes(df) < FILTER_FROM:
        return df.filter(F.col(key).isNotNull())
    bitmap, bit = _places(F.col(key))
    byte = F.substring(F.get(member_bitmaps(keys, key).scalar(), bitmap), F.call_function("div", bit, F.lit(8)).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return df.filter(F.col(key).isNotNull() & (F.getbit(value, bit % 8) == 1))
