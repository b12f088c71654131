"""Decomposition of wide tables into relations of higher normal forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decompose(df: DataFrame, key: Sequence[str], attrs: Sequence[str],
              latest_by: str | None = None) -> DataFrame:
    """Distinct (key, attributes) of the columns that depend on part of the key.

    With `latest_by`, a key with several attribute sets keeps the one of its newest row
    (greatest attributes on a tie) instead of appearing twice. Both forms combine on the
    map side, so a frequent key shrinks before the shuffle.
    """
    if latest_by is None:
        return df.select(*key, *attrs).distinct()
    newest = F.max(F.struct(latest_by, *attrs)).alias("_newest")
    kept = df.groupBy(*key).agg(newest)
    return kept.select(*key, *[F.col(f"_newest.{a}").alias(a) for a in attrs])


def extract_bridge(df: DataFrame, key: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """The relation that keeps the whole key and what depends on all of it."""
    return df.select(*key, *attrs)


def extract_transitive(df: DataFrame, determinant: str, dependents: Sequence[str]) -> DataFrame:
    """Relation of a non-key determinant and the columns it determines."""
    return df.select(determinant, *dependents).distinct()


def extract_dictionary(df: DataFrame, column: str) -> DataFrame:
    """The values that occur in a column."""
    return df.select(column).distinct()


def resolve_fk(child: DataFrame, parent: DataFrame, on: Mapping[str, str] | str,
               take: Mapping[str, str] | None = None, drop_key: bool = False) -> DataFrame:
    """Keep children whose parent exists; optionally swap in parent columns.

    `on` maps child column to parent column; `take` maps output name to parent column.
    Without `take` only existence matters, so a semi join does it. The physical join is
    left to the optimizer: give parents as stored tables, then those that are small are
    broadcast by their measured size and the child is not shuffled; for large parents a
    frequent child key is split by the adaptive skew join.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    keys = [F.col(p).alias(c) for c, p in pairs.items()]
    if not take:
        kept = child.join(parent.select(*keys), list(pairs), "left_semi")
        return kept.select(*child.columns)
    taken = [F.col(p).alias(out) for out, p in take.items()]
    joined = child.join(parent.select(*keys, *taken), list(pairs), "inner")
    kept = [c for c in child.columns if not (drop_key and c in pairs)]
    return joined.select(*kept, *take)
