"""Slowly changing dimensions, type 2: every attribute change makes a new version.

A dimension table has a surrogate key, a business key, tracked attributes and
`valid_from`, `valid_to` (inclusive, 9999-12-31 while open) and `is_current`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import OPEN_DATE, as_date, day
from ..sources.staging import at_once, stage
from .keys import assign_sk, highest_sk
from .normalize import resolve_fk

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")

# What a refresh does with a key of the source. Kinds that take a new surrogate key come
# first, so that numbering the change set in (kind, key) order leaves no holes.
CHANGED, NEW, OVERWRITE, KEPT = 0, 1, 2, 3


@dataclass(frozen=True)
class Dimension:
    sk: str
    bk: str
    attrs: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.sk, self.bk, *self.attrs, *VERSION_COLUMNS]


@dataclass(frozen=True)
class Parent:
    """A parent dimension whose surrogate key is a tracked attribute of the child.

    `column` holds the parent's business key in the child's source.
    """

    name: str
    column: str


def _attrs(spec: Dimension) -> Column:
    return F.struct(*spec.attrs)


def one_row_per_key(src: DataFrame, spec: Dimension) -> DataFrame:
    """Each business key once; of several attribute sets the greatest one.

    Rows without a key cannot be versioned and are left to the NOT NULL check.
    """
    best = F.max(_attrs(spec)).alias("_best")
    kept = src.filter(F.col(spec.bk).isNotNull()).groupBy(spec.bk).agg(best)
    return kept.select(spec.bk, "_best.*")


def _current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def _paired(src: DataFrame, dim: DataFrame, spec: Dimension, how: str) -> DataFrame:
    """Keys of the source with their current version; with "full" also keys only the
    dimension has (`_given` is NULL there)."""
    now = _current(dim).select(
        spec.bk, F.col(spec.sk).alias("_old_sk"), F.col("valid_from").alias("_since"),
        F.col("valid_to").alias("_until"), _attrs(spec).alias("_was"))
    given = one_row_per_key(src, spec).withColumn("_given", F.lit(True))
    return given.join(now, spec.bk, how)


def _differs(spec: Dimension) -> Column:
    return ~_attrs(spec).eqNullSafe(F.col("_was"))


def scd2_changes(src: DataFrame, dim: DataFrame, spec: Dimension) -> DataFrame:
    """Keys whose current version differs (NULL-safely) in any tracked attribute, with
    the surrogate key of that version and the new attributes."""
    return (_paired(src, dim, spec, "inner").filter(_differs(spec))
            .select(F.col("_old_sk").alias(spec.sk), spec.bk, *spec.attrs))


def scd2_late(src: DataFrame, dim: DataFrame, spec: Dimension, as_of: dt.date | str) -> DataFrame:
    """Changes a refresh refuses: the current version starts after `as_of`."""
    return (_paired(src, dim, spec, "inner")
            .filter(_differs(spec) & (F.col("_since") > day(as_of)))
            .select(F.col("_old_sk").alias(spec.sk), spec.bk, *spec.attrs,
                    F.col("_since").alias("valid_from")))


def scd2_new(src: DataFrame, dim: DataFrame, spec: Dimension) -> DataFrame:
    """Source rows whose key has no version at all, neither current nor closed."""
    return one_row_per_key(src, spec).join(dim.select(spec.bk), spec.bk, "left_anti")


def scd2_close(dim: DataFrame, changed: DataFrame, spec: Dimension,
               as_of: dt.date | str) -> DataFrame:
    """The dimension with the versions named in `changed` ended the day before `as_of`."""
    marks = changed.select(spec.sk, F.lit(True).alias("_ends"))
    ends = F.col("_ends").isNotNull()
    return (dim.join(marks, spec.sk, "left")
            .withColumn("valid_to", F.when(ends, _day_before(as_of))
                        .otherwise(F.col("valid_to")))
            .withColumn("is_current", F.col("is_current") & ~ends)
            .select(*dim.columns))


def scd2_open(rows: DataFrame, spec: Dimension, as_of: dt.date | str) -> DataFrame:
    """New current versions for rows that already carry their surrogate key."""
    return rows.select(
        spec.sk, spec.bk, *spec.attrs,
        day(as_of).alias("valid_from"),
        day(OPEN_DATE).alias("valid_to"),
        F.lit(True).alias("is_current"))


def _day_before(as_of: dt.date | str) -> Column:
    return day(as_date(as_of) - dt.timedelta(days=1))


def scd2_init(src: DataFrame, spec: Dimension, as_of: dt.date | str) -> DataFrame:
    """First load: one open version per key, numbered in key order."""
    keyed = assign_sk(one_row_per_key(src, spec), [spec.bk], spec.sk, unique=True)
    return scd2_open(keyed, spec, as_of)


def scd2_classify(src: DataFrame, dim: DataFrame, spec: Dimension, as_of: dt.date | str,
                  closed_only: bool = True, how: str = "full") -> DataFrame:
    """Every key of source and dimension with what a refresh does to it, by one join.

    Columns: business key, new attributes, `_kind`, and key, period and attributes of the
    current version (`_old_sk`, `_since`, `_until`, `_was`). Keys of the source that have
    closed versions only are left out: of the history just the keys are read, against the
    keys not found current. With `closed_only=False` the caller vouches that there are none,
    and `dim` may be the current versions alone: a refresh then costs the same however long
    the history is. `how="left"` leaves out keys that the source does not have.
    """
    today = day(as_of)
    paired = _paired(src, dim, spec, how)
    changed = F.col("_given").isNotNull() & _differs(spec) & (F.col("_since") <= today)
    kind = (F.when(F.col("_old_sk").isNull(), NEW)
            .when(~changed, KEPT)
            .when(F.col("_since") == today, OVERWRITE)
            .otherwise(CHANGED))
    found = paired.withColumn("_kind", kind)
    if closed_only:
        closed = (dim.filter(~F.col("is_current")).select(spec.bk).distinct()
                  .withColumn("_closed", F.lit(True)))
        found = found.join(closed, spec.bk, "left").filter(
            (F.col("_kind") != NEW) | F.col("_closed").isNull())
    return found.select("_kind", spec.bk, *spec.attrs, "_old_sk", "_since", "_until", "_was")


def _numbered(classified: DataFrame, spec: Dimension, highest: int) -> DataFrame:
    changes = classified.filter(F.col("_kind") != KEPT)
    numbered = assign_sk(changes, ["_kind", spec.bk], "_new_sk", highest, unique=True)
    resulting = F.when(F.col("_kind") == OVERWRITE, F.col("_old_sk")).otherwise(F.col("_new_sk"))
    return numbered.select(resulting.alias(spec.sk), spec.bk, *spec.attrs,
                           "_kind", "_old_sk", "_since", "_was")


def scd2_delta(src: DataFrame, dim: DataFrame, spec: Dimension, as_of: dt.date | str,
               closed_only: bool = True, highest: int | None = None) -> DataFrame:
    """The change set of a refresh, computed and written once: the keys that change, with the
    surrogate key of the resulting version. Closing and opening both read this one table, so
    they cannot disagree. New surrogate keys follow `highest`, by default the largest of `dim`."""
    found = scd2_classify(src, dim, spec, as_of, closed_only, "left")
    return _numbered(found, spec, highest_sk(dim, spec.sk) if highest is None else highest)


def opened_versions(delta: DataFrame, spec: Dimension, as_of: dt.date | str) -> DataFrame:
    return scd2_open(delta.filter(F.col("_kind") != OVERWRITE), spec, as_of)


def closed_versions(delta: DataFrame, spec: Dimension, as_of: dt.date | str) -> DataFrame:
    """Versions that this refresh ends, in their closed form: all in the change set, so
    the dimension is not read again."""
    return delta.filter(F.col("_kind") == CHANGED).select(
        F.col("_old_sk").alias(spec.sk), spec.bk,
        *[F.col(f"_was.{a}").alias(a) for a in spec.attrs],
        F.col("_since").alias("valid_from"),
        _day_before(as_of).alias("valid_to"),
        F.lit(False).alias("is_current"))


def kept_versions(current: DataFrame, delta: DataFrame, spec: Dimension) -> DataFrame:
    """Versions of `current`, or of a part of it, that stay current, with same-day corrections
    written over them."""
    touched = delta.filter(F.col("_kind") != NEW).select(
        F.col("_old_sk").alias(spec.sk), F.col("_kind"),
        *[F.col(a).alias(f"_new_{a}") for a in spec.attrs])
    corrected = F.col("_kind").eqNullSafe(F.lit(OVERWRITE))
    return (current.join(touched, spec.sk, "left")
            .filter(F.col("_kind").isNull() | corrected)
            .select(spec.sk, spec.bk,
                    *[F.when(corrected, F.col(f"_new_{a}")).otherwise(F.col(a)).alias(a)
                      for a in spec.attrs],
                    *VERSION_COLUMNS))


def scd2_apply(src: DataFrame, dim: DataFrame, spec: Dimension, as_of: dt.date | str) -> DataFrame:
    """Refresh: the full next state of the dimension.

    Changed keys get their current version closed and a new one opened, new keys get a
    first version, a second change on the same day corrects that day's version in place,
    and keys missing from the source stay current. One full outer join tells them apart;
    what it finds is written once and gives every part of the next state, so the current
    versions are not joined again.
    """
    dim = dim.select(*spec.columns)
    found = stage(scd2_classify(src, dim, spec, as_of), "classified")
    delta = _numbered(found, spec, highest_sk(dim, spec.sk))
    corrected = F.col("_kind") == OVERWRITE
    stays = found.filter(F.col("_kind").isin(KEPT, OVERWRITE)).select(
        F.col("_old_sk").alias(spec.sk), spec.bk,
        *[F.when(corrected, F.col(a)).otherwise(F.col(f"_was.{a}")).alias(a)
          for a in spec.attrs],
        F.col("_since").alias("valid_from"), F.col("_until").alias("valid_to"),
        F.lit(True).alias("is_current"))
    return (dim.filter(~F.col("is_current"))
            .unionByName(closed_versions(delta, spec, as_of))
            .unionByName(stays)
            .unionByName(opened_versions(delta, spec, as_of)))


def with_parent_sk(src: DataFrame, parent: DataFrame, parent_spec: Dimension,
                   column: str) -> DataFrame:
    """Add the surrogate key of the parent's current version; children without a current
    parent drop out."""
    return resolve_fk(src, _current(parent), {column: parent_spec.bk},
                      {parent_spec.sk: parent_spec.sk})


def rekeyed(children: DataFrame, spec: Dimension, parent_sk: str, changes: DataFrame
            ) -> DataFrame:
    """Of current children those that point to a changed parent version, as a source with the
    new one. `changes` has `old_sk` and `new_sk` of parents; while it is small it is broadcast,
    and the children are only scanned."""
    moved = children.join(changes, F.col(parent_sk) == F.col("old_sk"))
    return moved.select(spec.bk, *[F.col("new_sk").alias(a) if a == parent_sk else F.col(a)
                                   for a in spec.attrs])


def parents_first(names: Iterable[str], parents: Mapping[str, Sequence[Parent]]
                  ) -> list[list[str]]:
    """Groups of dimensions such that the parents of each are in an earlier group."""
    groups, waiting, done = [], list(names), set()
    while waiting:
        ready = [n for n in waiting if all(p.name in done for p in parents.get(n, ()))]
        if not ready:
            raise ValueError(f"parents missing for {waiting}")
        groups.append(ready)
        done.update(ready)
        waiting = [n for n in waiting if n not in done]
    return groups


def scd2_cascade(sources: Mapping[str, DataFrame], dims: Mapping[str, DataFrame],
                 specs: Mapping[str, Dimension], parents: Mapping[str, Sequence[Parent]],
                 as_of: dt.date | str) -> dict[str, DataFrame]:
    """Refresh (or first load) several dimensions, parents before children.

    A new parent version has a new surrogate key, which is a tracked attribute of the
    child, so the child gets a new version as well. Each result is a written table (a
    first load is one already): children and facts then join a table of known size, and
    small dimensions are broadcast to them.
    Dimensions that do not wait for one another are refreshed concurrently.
    """
    result: dict[str, DataFrame] = {}

    def refresh(name: str) -> DataFrame:
        src, spec, known = sources[name], specs[name], dims.get(name)
        for parent in parents.get(name, ()):
            src = with_parent_sk(src, result[parent.name], specs[parent.name], parent.column)
        if known is None:
            return scd2_init(src, spec, as_of)
        return stage(scd2_apply(src, known, spec, as_of), name)

    for names in parents_first(specs, parents):
        result.update(zip(names, at_once(refresh, names)))
    return result


def dim_as_of(dim: DataFrame, on: dt.date | str) -> DataFrame:
    """The dimension as it was on a day."""
    return dim.filter(day(on).between(F.col("valid_from"), F.col("valid_to")))


def version_history(dim: DataFrame, bk: str) -> DataFrame:
    """All versions, in order per business key."""
    return dim.orderBy(bk, "valid_from")
