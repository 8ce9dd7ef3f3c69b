"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulbook.operators.joins import fresh


def row_mark(columns: list[str]) -> Column:
    """A hash of whole rows and of where they are null, by which ties are broken."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def latest_per_key(df: DataFrame, key: str, newest: str, tiebreak: list[Column] | None = None) -> DataFrame:
    """One row per key: the newest by ``newest`` (nulls last). A null key counts as one key.

    ``row_number() = 1`` is planned with a per-task top-1 before the shuffle, so a key holding a
    large share of the rows sends one row per task. Ties go to ``tiebreak``, by default to a hash of
    the whole row and of where it is null, so that a recomputed task picks the same row again.
    """
    ties = tiebreak or [row_mark(df.columns)]
    order = Window.partitionBy(key).orderBy(F.col(newest).desc_nulls_last(), *ties)
    rank = fresh("rank", df)
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)


def latest_wide_rows(df: DataFrame, key: str, newest: str, mark: str, facts: DataFrame) -> DataFrame:
    """The rows ``latest_per_key`` picks, with the ``facts`` of their key (one row per key; none for a null key).

    For wide rows. ``df`` carries their ``row_mark`` in column ``mark``. The pick ranks the key, the date and the mark only, so a
    task that scans wide rows sorts narrow ones; the facts join the pick, on the partitioning that it left behind. The wide rows then move
    once, to the pick and its facts, by mark, date and key: rows of one key are dealt over the tasks and no more than those
    picked pass. Copies of a picked row are equal in all three and meet in one task, in the order that the join left; the first stays.
    """
    when, row = fresh("when", df, facts), fresh("row", df, facts)
    known = F.struct(key, newest).alias(when)  # in a struct, nulls are equal
    pick = latest_per_key(df.select(key, newest, mark), key, newest, [F.col(mark)])
    found = pick.join(facts, key, "left").select(mark, known, *[c for c in facts.columns if c != key])
    joined = df.select("*", known).join(found, [mark, when])
    columns = [c for c in joined.columns if c not in (mark, when)]
    return joined.groupBy(mark, when).agg(F.first(F.struct(*columns)).alias(row)).select(f"{row}.*")
