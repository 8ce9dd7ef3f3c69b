"""Left joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a skewed partition only between two shuffles that were made for the join. A side
that is an aggregate, or that already has the partitioning, gets no such shuffle, so the joins here ask for one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulbook.operators.sizes import estimated_bytes

ROWS_PER_SLOT = 250_000  # fewer matches of one key are left to one task
BYTES_PER_ROW = 4  # at least, of a table's rows by Spark's estimate, which is of compressed files
MOST_HOT_KEYS = 1000  # a key beyond these has less than a thousandth of all matches
COPIES_PER_PIECE = 1_000  # identical rows travel as one row with a count up to this


def lookup_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], how: str = "left"
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` with hot keys and null keys of ``left`` spread out; an inner join, for rows
    that are known to match, can split hot keys of ``right`` as well.

    A hash of the keys is a further join column, so that Spark shuffles both sides for this join (or
    broadcasts a right side it has measured to be small) and adaptive execution may split any number of hot
    keys of ``left``, whatever their size. Where a key is null the hash is of ``spread``: such rows
    match nothing and are dealt over all tasks. The hash depends on the row alone, so a task that is run again
    deals its rows in the same way. Keys may differ in integer or text type between the sides, but must not be
    floating-point numbers, of which equal ones can hash differently.
    """
    null_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    kinds = left.select(*keys).union(right.select(*keys)).schema  # the types in which both are compared
    hashed, tag = F.xxhash64(*[F.col(f.name).cast(f.dataType) for f in kinds]), fresh("tag", left, right)
    tagged = left.withColumn(tag, F.when(null_key, F.xxhash64(*spread)).otherwise(hashed))
    known = right.dropna(subset=keys).withColumn(tag, hashed)
    return tagged.join(known, [tag, *keys], how).drop(tag)


def fresh(base: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has."""
    taken, name = {c.lower() for df in tables for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fanout_keys(counted: DataFrame, keys: list[str], rows: Column, rows_per_slot: int) -> DataFrame:
    """Keys with more than ``rows_per_slot`` matches and the number of slots for them, which grows with the matches."""
    per_key = counted.groupBy(*keys).agg(F.sum(rows).alias("_rows"))
    slots = F.ceil(F.col("_rows") / rows_per_slot).cast("int").alias("_slots")
    return per_key.filter(F.col("_rows") > rows_per_slot).select(*keys, slots)


def fanout_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: list[str],
    copies_per_piece: int | None = None,
    rows_per_slot: int | None = None,
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` where one key may match very many right rows.

    Equal right rows are counted instead of carried, in pieces of bounded size. The pieces of a key with
    very many are dealt into slots, and left rows of such a key repeat once per slot, so that its matches are
    produced by many tasks; a slot without a piece adds nothing. The list of such keys, usually empty, has at most
    MOST_HOT_KEYS entries and is a subquery's value, so neither side is shuffled to look a key up: both move once, for the join,
    which can split hot keys of ``left``. Last, the counted copies are written out.
    """
    size, slot_rows = copies_per_piece or COPIES_PER_PIECE, rows_per_slot or ROWS_PER_SLOT
    copies, piece, slot, copy = (fresh(c, left, right) for c in ("copies", "piece", "slot", "copy"))
    counted = right.dropna(subset=keys).groupBy(*right.columns).agg(F.count("*").alias(copies))
    slots = F.lit(None).cast("int")
    if estimated_bytes(right) >= slot_rows * BYTES_PER_ROW:  # else no key has so many rows
        many = fanout_keys(counted, keys, F.col(copies), slot_rows)
        most = many.orderBy(F.desc("_slots"), *keys).limit(MOST_HOT_KEYS)
        hot = most.agg(F.map_from_entries(F.collect_list(F.struct(F.struct(*keys), "_slots"))).alias("hot"))
        kinds = {f.name: f.dataType for f in right.select(*keys).schema}
        slots = F.try_element_at(hot.scalar(), F.struct(*[F.col(k).cast(t).alias(k) for k, t in kinds.items()]))
    last_piece = F.ceil(F.col(copies) / size).cast("int") - 1
    pieces = counted.withColumn(piece, F.explode(F.sequence(F.lit(0), last_piece))).withColumn(
        copies, F.least(F.lit(size), F.col(copies) - F.col(piece) * size).cast("int")
    )
    mixed = F.xxhash64(*right.columns, piece)
    dealt = pieces.withColumn(slot, F.pmod(mixed, F.coalesce(slots, F.lit(1)))).drop(piece)
    every_slot = F.sequence(F.lit(0).cast("long"), F.coalesce(slots, F.lit(1)).cast("long") - 1)
    slotted = left.withColumn(copy, slots).withColumn(slot, F.explode(every_slot))
    joined = lookup_join(slotted, dealt, [*keys, slot], spread)
    found = joined.filter(F.col(copy).isNull() | F.col(copies).isNotNull())
    every_copy = F.explode(F.sequence(F.lit(1), F.coalesce(F.col(copies), F.lit(1))))
    return found.withColumn(copy, every_copy).drop(slot, copies, copy)


def exists_flag(
    left: DataFrame, right: DataFrame, key: str, flag: str, spread: list[str] | None = None
) -> DataFrame:
    """Add ``flag``: whether ``key`` occurs in ``right``. Two-valued, also for a null key.

    The keys are de-duplicated first (before the shuffle as well), so the row count is unchanged.
    Give ``spread`` if ``left`` may repeat a key very often.
    """
    found = right.select(key).dropna().distinct().withColumn(flag, F.lit(True))
    joined = lookup_join(left, found, [key], spread) if spread else left.join(found, key, "left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
