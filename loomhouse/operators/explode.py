"""Parallel delimited lists to rows, keeping positions. Nothing is shuffled unless sorted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import string_to_list


def _zipped_rows(df: DataFrame, lists: Mapping[str, object], position: str,
                 order_by: Sequence[str]) -> DataFrame:
    taken = [c for c in df.columns if c not in lists]
    zipped = F.arrays_zip(*[c.alias(f"v{i}") for i, c in enumerate(lists.values())])
    rows = df.select(*taken, F.posexplode(zipped).alias("_at", "_item"))
    items = [F.col("_item").getField(f"v{i}").alias(n) for i, n in enumerate(lists)]
    exploded = rows.select(*taken, (F.col("_at") + 1).alias(position), *items)
    return exploded.orderBy(*order_by, position) if order_by else exploded


def explode_zip(df: DataFrame, columns: Sequence[str], delim: str = ";",
                position: str = "pos", order_by: Sequence[str] = ()) -> DataFrame:
    """One row per position of the longest list; shorter lists give NULL.

    A row whose lists are all empty or NULL gives no row. Positions start at 1. With
    `order_by` the rows are sorted by those columns and the position.
    """
    lists = {c: string_to_list(F.col(c), delim) for c in columns}
    return _zipped_rows(df, lists, position, order_by)


def explode_by_index(df: DataFrame, driver: str, columns: Sequence[str], delim: str = ";",
                     position: str = "pos", order_by: Sequence[str] = ()) -> DataFrame:
    """One row per position of the `driver` list; longer lists are cut, shorter give NULL.

    The other lists are cut before zipping, so no row carries a whole list along.
    """
    length = F.size(string_to_list(F.col(driver), delim))
    lists = {driver: string_to_list(F.col(driver), delim)}
    for c in columns:
        if c != driver:
            lists[c] = F.slice(string_to_list(F.col(c), delim), F.lit(1), length)
    return _zipped_rows(df, lists, position, order_by)


def list_length_report(df: DataFrame, columns: Sequence[str], delim: str = ";") -> DataFrame:
    """Rows whose parallel lists differ in length, with each length as `n_<column>`."""
    sizes = [F.size(string_to_list(F.col(c), delim)) for c in columns]
    unequal = F.lit(False)
    for s in sizes[1:]:
        unequal = unequal | (s != sizes[0])
    others = [c for c in df.columns if c not in columns]
    return df.filter(unequal).select(
        *others, *[s.alias(f"n_{c}") for c, s in zip(columns, sizes)])
