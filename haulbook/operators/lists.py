"""Array columns as ``;`` lists and as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulbook.functions import list_text


def _sorted_text(values: Column) -> Column:
    return list_text(F.array_sort(values))


def _tagged(values: Column, number: int) -> Column:
    """Each element with the number of the list it belongs to."""
    return F.transform(values, lambda v: F.struct(F.lit(number).alias("list"), v.alias("element")))


def listagg_distinct(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sorted ``;`` list of the distinct values per key.

    Duplicates go before the shuffle; what remains of a key is what its one output cell holds, '' if
    there are only nulls.
    """
    return df.select(key, value).distinct().groupBy(key).agg(_sorted_text(F.collect_list(value)).alias(name))


def array_list_columns(df: DataFrame, key: str, arrays: dict[str, str]) -> DataFrame:
    """Per key, one sorted ``;`` list of distinct elements for each of several array columns.

    ``arrays`` maps input columns to output names. A row counts only if *all* its arrays are
    non-empty: unnesting them side by side leaves nothing of a row with an empty one. The cross
    product of the arrays is never formed: they are laid end to end (each element tagged with its list)
    and unnested once. Elements are de-duplicated per key inside each task, so there is one read and one shuffle, and what
    is shuffled and collected for a key is what its output cells hold.
    """
    complete = df.filter(reduce(Column.__and__, [F.size(F.col(a)) > 0 for a in arrays])).select(key, *arrays)
    tagged = F.concat(*[_tagged(F.col(a), i) for i, a in enumerate(arrays)])
    sets = [
        _sorted_text(F.collect_set(F.when(F.col("item.list") == i, F.col("item.element")))).alias(name)
        for i, name in enumerate(arrays.values())
    ]
    return complete.select(key, F.explode(tagged).alias("item")).groupBy(key).agg(*sets)


def tag_rows(df: DataFrame, key: str, array: str, pattern: str, name: str) -> DataFrame:
    """One row per array element that matches a case-insensitive LIKE pattern."""
    return df.select(key, F.explode(array).alias(name)).filter(F.col(name).ilike(pattern))
