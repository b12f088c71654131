"""Fact tables linked to versions of dimensions by surrogate key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .keys import assign_sk
from .normalize import resolve_fk
from .scd2 import Dimension

@dataclass(frozen=True)
class Link:
    """Event column `on` holds the business key of `dim`."""

    dim: DataFrame
    spec: Dimension
    on: str


def _periods(link: Link) -> tuple[DataFrame, DataFrame]:
    """The buckets of each business key, and its versions in every bucket they touch.

    A key's days from its first to its last version are cut into buckets as wide as a version
    lasts on average. So a key has at most three rows for each of its versions, however
    long those last, and a bucket of w days meets at most w + 1 versions.
    """
    spec = link.spec
    rows = link.dim.select(F.col(spec.bk).alias(link.on), spec.sk,
                           F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    first, last = F.min("_from"), F.max("_from")
    # Written, as are the versions, so that their sizes are known where events are joined.
    keys = stage(rows.groupBy(link.on).agg(
        first.alias("_first"), last.alias("_last"),
        F.ceil((F.datediff(last, first) + F.lit(1)) / F.count("*")).alias("_width")), "keys")
    spread = F.explode(F.sequence(_bucket("_from"), _bucket("_to")))
    return keys, stage(rows.join(keys, link.on).withColumn("_bucket", spread)
                       .select(link.on, "_bucket", spec.sk, "_from", "_to",
                               (F.col("_from") == F.col("_first")).alias("_is_first")), "periods")


def _bucket(date: str):
    """Bucket of a day; days outside a key's span fall into its first or last one."""
    inside = F.greatest(F.least(F.col(date), F.col("_last")), F.col("_first"))
    return F.floor(F.datediff(inside, F.col("_first")) / F.col("_width")).cast("long")


def match_as_of(events: DataFrame, link: Link, date_col: str,
                extend_first: bool = True) -> DataFrame:
    """Add the surrogate key of the version valid on the event's day (inner).

    One equi-join on (business key, time bucket), with the period as residual condition:
    no key pairs all its events with all its versions. With `extend_first` a first version
    also covers all days before it.
    """
    on, when = link.on, F.col(date_col)
    keys, periods = _periods(link)
    placed = (events.filter(when.isNotNull()).join(keys, on)
              .withColumn("_bucket", _bucket(date_col)).select(*events.columns, "_bucket"))
    started = when >= F.col("_from")
    if extend_first:
        started = started | F.col("_is_first")
    return (placed.join(periods, [on, "_bucket"]).filter(started & (when <= F.col("_to")))
            .select(*events.columns, link.spec.sk))


def match_current(events: DataFrame, link: Link) -> DataFrame:
    """Add the surrogate key of the current version (inner)."""
    return resolve_fk(events, link.dim.filter("is_current"), {link.on: link.spec.bk},
                      {link.spec.sk: link.spec.sk})


def build_fact(events: DataFrame, links: Sequence[Link],
               references: Sequence[tuple[DataFrame, str]] = (), mode: str = "current",
               date_col: str = "order_date", sk: str = "order_sk",
               extend_first: bool = True, start: int = 0, ordered: bool = True) -> DataFrame:
    """Events with business keys replaced by version keys and a dense key of their own.

    `mode` is "current" (today's version) or "as_of" (the version on the event's day;
    with `extend_first` a first version also covers all days before it). Events without
    a matching version or reference value drop out. Rows are numbered by date, then
    business keys; the range shuffle this takes also leaves the fact sorted by date.
    `ordered=False` saves that shuffle and numbers rows as they come, still densely.
    Give dimensions and references as stored tables: those small enough are then
    broadcast from the start and the events are not shuffled for them.
    """
    if mode not in ("current", "as_of"):
        raise ValueError(f"unknown mode {mode!r}")
    fact = events
    for values, column in references:
        fact = resolve_fk(fact, values, column)
    for link in links:
        fact = (match_current(fact, link) if mode == "current"
                else match_as_of(fact, link, date_col, extend_first))
    business = [link.on for link in links]
    others = [c for c in events.columns if c != date_col and c not in business]
    order = [date_col, *business, *others] if ordered else []
    numbered = assign_sk(fact, order, sk, start)
    return numbered.select(sk, date_col, *[link.spec.sk for link in links], *others)


def star_view(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[str]]],
              references: Sequence[tuple[DataFrame, str]] = ()) -> DataFrame:
    """Readable fact rows: each (dimension, surrogate key, columns) adds its columns."""
    keys = [sk for _, sk, _ in dims]
    added: list[str] = []
    rows = fact
    for dim, sk, columns in dims:
        rows = rows.join(dim.select(sk, *columns), sk)
        added += columns
    for values, column in references:
        rows = resolve_fk(rows, values, column)
    return rows.select(*[c for c in fact.columns if c not in keys], *added)
