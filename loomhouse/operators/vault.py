"""Insert-only Data Vault loads.

Each load returns only the rows to append. Hash keys are functions of the business key,
so they are computed in place and a hub or link is consulted for existence alone (semi
join), never to fetch its key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import OPEN_TIMESTAMP, as_timestamp, hash_key
from ..sources.staging import stage_sized

LoadTime = dt.datetime | str

#: Up to this many bytes, written ones and digests, the keys of a batch are broadcast to the stored
#: table.
SMALL_BATCH_BYTES = 8 * 1024 * 1024
#: What a key adds to them as a digest.
KEY_BYTES = 16
#: Up to so many keys, a batch looks them up by value: row groups without them are not read.
FEW_KEYS = 10
#: Written bytes above which a batch is sure to have more.
FEW_BYTES = 1 << 17
#: Rows of a zone that a task may gather before they are combined.
ROWS_TOGETHER = 1 << 20
#: Partition column of stored tables that are laid out in zones.
ZONE = "_zone"


@dataclass(frozen=True)
class Zones:
    """Partitions of a stored table by one of its business keys.

    Whole numbers lie with `width` neighbours: keys that are handed out in order also arrive in
    order, so a batch falls into few zones, and only those are read. Other keys are dealt by
    `digits` hex digits of their hash; then a batch is confined to few zones only if it has
    few keys. The zone follows from the key's text alone, whatever its type in a batch.
    """

    bk: str
    width: int
    digits: int = 2

    def column(self) -> Column:
        text = F.col(self.bk).cast("string")
        near = F.floor(text.try_cast("decimal(38,0)") / F.lit(self.width)).cast("long")
        whole = text.rlike("^-?[0-9]{1,18}$")
        dealt = F.conv(F.substring(F.md5(text), 1, self.digits), 16, 10).cast("long")
        return F.when(whole, near).otherwise(-1 - dealt - F.lit(1 << 60)).alias(ZONE)


def _key(columns: Sequence[str]) -> Column:
    return hash_key(*[F.col(c) for c in columns])


def _binary(digest: str) -> Column:
    """A digest in half its length; none for text that no load makes, which equals no digest."""
    return F.when(F.col(digest).rlike("^[0-9a-f]{32}$"), F.unhex(digest))


def _joint(digests: Sequence[Column]) -> Column:
    """One digest as it is, several by a digest of them, as bytes."""
    return F.unhex(digests[0] if len(digests) == 1 else F.md5(F.concat(*digests)))


def _absent(rows: DataFrame, existing: DataFrame | None, made: dict[str, Column],
            zones: Zones | None, batch: DataFrame, bks: Sequence[str],
            latest: bool = False) -> DataFrame:
    """Rows whose digests, `made` of their columns with the hash key first, are not stored.

    The rows are written to know their size, unless the `batch` they come from, a stored table
    if there are zones, has too many keys to be small. Of a table in zones only the batch's zones
    are read: their list, one number each, is broadcast and prunes partitions when the scan
    starts. A small batch further thins out the stored rows where they are read, so that they
    are never shuffled; beyond that both sides meet in a shuffled join. There rows stay as short
    as they are, digests being made of them where they are compared, and a stored row is the
    bytes of one digest.
    """
    if existing is None:
        return rows
    hk, columns = next(iter(made)), rows.columns
    if zones and _keys_of(batch, bks) * KEY_BYTES > 2 * SMALL_BATCH_BYTES:
        incoming, size = rows, None
    else:
        digests = [F.unhex(d).alias(c) for c, d in made.items() if c != hk]
        batch, size = stage_sized(rows.select(*columns, *digests), "incoming")
        incoming = batch
    hex_key = made[hk].alias(hk)
    if zones:
        # The comparison makes the list a filter in the eyes of partition pruning.
        near = batch.select(zones.column()).distinct().filter(F.col(ZONE) > -(1 << 62))
        existing = existing.join(F.broadcast(near), ZONE, "left_semi")
    if size is not None and size <= SMALL_BATCH_BYTES and (
            size + incoming.count() * KEY_BYTES <= SMALL_BATCH_BYTES):
        few = None if size > FEW_BYTES else [
            r[0] for r in incoming.select(hex_key).distinct().limit(FEW_KEYS + 1).collect()]
        if few is not None and len(few) <= FEW_KEYS:
            existing = existing.filter(F.col(hk).isin(few))
        else:
            existing = existing.join(F.broadcast(incoming.select(hex_key)), hk, "left_semi")
    if latest:
        existing = latest_satellite(existing.select(*made, "load_dts"), hk)
    whole = [F.when(_binary(c).isNotNull(), F.col(c)) for c in made]
    known = existing.select(_joint(whole).alias("_known"))
    return incoming.join(known, _joint(list(made.values())) == F.col("_known"),
                         "left_anti").select(*columns)


def _keys_of(batch: DataFrame, bks: Sequence[str]) -> int:
    """About how many keys a batch has."""
    return batch.agg(F.approx_count_distinct(F.xxhash64(*bks))).first()[0]


def _zoned(zones: Zones | None) -> list[Column]:
    return [zones.column()] if zones else []


def gathered(rows: DataFrame, zones: Zones | None) -> DataFrame:
    """Rows to add by zone, while they are short: digests made after that, several times as long
    as the keys, are written where they are."""
    if zones is None:
        return rows
    return rows.withColumn(ZONE, zones.column()).hint("rebalance", ZONE).drop(ZONE)


def _in_hub(rows: DataFrame, hub: DataFrame | None, bk: str) -> DataFrame:
    """Rows whose business key the hub holds, compared as text like the hub stores it."""
    if hub is None:
        return rows
    known = hub.select(F.col(bk).alias("_known"))
    return rows.join(known, F.col(bk).cast("string") == F.col("_known"), "left_semi")


def _grouped(rows: DataFrame, bks: Sequence[str], best: Column, zones: Zones | None) -> DataFrame:
    """The `best` of the rows of a key, gathered by `zones` if given.

    Rows are combined on the map side and gathered after that. Keys of several parts seldom
    repeat; then that would move every row twice, so rows are gathered as they are, unless some
    zone has too many for one task.
    """
    if zones and len(bks) > 1:
        near = rows.withColumn(ZONE, zones.column())
        most = near.groupBy(ZONE).count().agg(F.max("count")).first()[0]
        if (most or 0) <= ROWS_TOGETHER:
            return near.repartition(ZONE).groupBy(ZONE, *bks).agg(best).drop(ZONE)
    return gathered(rows.groupBy(*bks).agg(best), zones)


def _least_source(rows: DataFrame, bks: Sequence[str], source: str, zones: Zones | None,
                  once: bool) -> DataFrame:
    if once:
        return gathered(rows.select(*bks, F.col(source).alias("record_source")), zones)
    return _grouped(rows, bks, F.min(source).alias("record_source"), zones)


def _now_and_later(zones: Zones | None, *others: DataFrame | None) -> list[Zones | None]:
    """Zones to gather rows by when they are grouped, and after they met `others`, if any."""
    return [None, zones] if any(o is not None for o in others) else [zones, None]


def load_hub(stg: DataFrame, hk: str, bk: str, load_ts: LoadTime,
             existing: DataFrame | None = None, source: str = "source_system",
             zones: Zones | None = None, once: bool = False) -> DataFrame:
    """Business keys not yet in the hub.

    A key that several source systems deliver in one batch takes the least of their
    names; a key already present is never touched. Grouping is on the raw business key:
    the digest is computed once per key, not once per staged row. Rows without a key are
    left to `key_rejects`. With `zones` the result and `existing` have their column, and the
    result is gathered by them. Keys that the caller passes `once` are not grouped again.
    """
    now, later = _now_and_later(zones, existing)
    batch, digest = stg.filter(F.col(bk).isNotNull()), _key([bk])
    keys = _least_source(batch, [bk], source, now, once)
    new = gathered(_absent(keys, existing, {hk: digest}, zones, batch, [bk]), later)
    return new.select(digest.alias(hk), F.col(bk).cast("string").alias(bk),
                      as_timestamp(load_ts).alias("load_dts"), "record_source", *_zoned(zones))


def load_link(stg: DataFrame, hk: str, ends: Sequence[tuple[str, str]], load_ts: LoadTime,
              existing: DataFrame | None = None, hubs: Sequence[DataFrame | None] = (),
              source: str = "source_system", zones: Zones | None = None,
              once: bool = False) -> DataFrame:
    """Pairs of business keys not yet linked; `ends` lists (hub key, business key).

    Staged rows shrink to distinct pairs before anything is joined, and digests are made
    last, so that joins move short business keys only. Give `hubs` to keep only pairs
    whose keys exist there; without, the caller vouches for them. Pairs that the caller passes
    `once` are not grouped again.
    """
    bks = [bk for _, bk in ends]
    known = F.lit(True)
    for bk in bks:
        known = known & F.col(bk).isNotNull()
    now, later = _now_and_later(zones, existing, *hubs)
    batch, digest = stg.filter(known), _key(bks)
    pairs = _least_source(batch, bks, source, now, once)
    for bk, hub in zip(bks, hubs):
        pairs = _in_hub(pairs, hub, bk)
    new = gathered(_absent(pairs, existing, {hk: digest}, zones, batch, bks), later)
    return new.select(digest.alias(hk), *[_key([bk]).alias(end) for end, bk in ends],
                      as_timestamp(load_ts).alias("load_dts"), "record_source", *_zoned(zones))


def key_rejects(stg: DataFrame, bks: Sequence[str], source: str = "source_system") -> DataFrame:
    """Staged rows that no hub, link or satellite takes because a business key is NULL: how many
    there are by the keys they do have, the names of those they lack, and their source."""
    lacking = F.concat_ws(",", *[F.when(F.col(bk).isNull(), F.lit(bk)) for bk in bks])
    return (stg.select(*bks, source, lacking.alias("missing")).filter(F.col("missing") != "")
            .groupBy(*bks, source, "missing").agg(F.count(F.lit(1)).alias("n_rows")))


def latest_satellite(sat: DataFrame, hk: str) -> DataFrame:
    """The newest row per key, by a map-side combined maximum: no window over a key."""
    others = [c for c in sat.columns if c not in (hk, "load_dts")]
    newest = sat.groupBy(hk).agg(F.max(F.struct("load_dts", *others)).alias("_newest"))
    return newest.select(hk, "_newest.*").select(*sat.columns)


def satellite_rejects(stg: DataFrame, bks: Sequence[str], attrs: dict[str, str]) -> DataFrame:
    """Distinct staged rows that get no hash diff because a key or attribute is NULL."""
    columns = [*bks, *attrs.values()]
    lacking = F.lit(False)
    for c in columns:
        lacking = lacking | F.col(c).isNull()
    return stg.filter(lacking).select(*bks, *[F.col(c).alias(n) for n, c in attrs.items()]
                                      ).distinct()


def satellite_conflicts(stg: DataFrame, bks: Sequence[str], attrs: dict[str, str]) -> DataFrame:
    """Distinct attribute sets that a load leaves out because a greater set came for their key.

    Sets without NULLs only, like the load itself.
    """
    columns = [*bks, *attrs.values()]
    sets = stg.select(*bks, F.struct(*[F.col(c).alias(n) for n, c in attrs.items()]).alias("_set"),
                      *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    for i in range(len(columns)):
        sets = sets.filter(F.col(f"_c{i}").isNotNull())
    sets = sets.select(*bks, "_set").distinct()
    best = sets.groupBy(*bks).agg(F.max("_set").alias("_best"))
    return (sets.join(best, list(bks)).filter(F.col("_set") != F.col("_best"))
            .select(*bks, "_set.*"))


def load_satellite(stg: DataFrame, hk: str, bks: Sequence[str], attrs: dict[str, str],
                   load_ts: LoadTime, existing: DataFrame | None = None,
                   parent: DataFrame | None = None, parent_hk: str | None = None,
                   compare: str = "any", end_dated: bool = True,
                   null_safe: bool = False, zones: Zones | None = None) -> DataFrame:
    """Attribute rows whose hash diff is not stored for their key.

    `attrs` maps the satellite's attribute names to staged columns.
    `bks` is one business key for a hub satellite, two for a link satellite. A key with
    several attribute sets in the batch keeps the greatest. Give `parent`, the hub or the
    link (whose hash key is `parent_hk`), to keep only keys it holds. compare="any" skips a set
    the key ever had; compare="latest" compares with the newest row only, so a return to
    former values is recorded. Rows with NULLs are left to `satellite_rejects`, unless
    `null_safe` switches to a hash text that has a mark for NULL. `end_dated` satellites
    carry an `end_date` that stays open.
    """
    if compare not in ("any", "latest"):
        raise ValueError(f"unknown comparison {compare!r}")
    names = list(attrs)
    rows = stg.select(*bks, *[F.col(c).alias(f"a_{n}") for n, c in attrs.items()])
    keyed = [F.col(b).isNotNull() for b in bks]
    if not null_safe:
        keyed += [F.col(f"a_{n}").isNotNull() for n in names]
    for condition in keyed:
        rows = rows.filter(condition)
    batch = rows
    best = F.max(F.struct(*[f"a_{n}" for n in names])).alias("_best")
    now, later = _now_and_later(zones, existing, parent)
    rows = _grouped(rows, bks, best, now).select(*bks, "_best.*")
    if len(bks) == 1:
        rows = _in_hub(rows, parent, bks[0])
    elif parent is not None:
        # Before the digests are made: the rows that meet the link are short.
        owner = parent.select(_binary(parent_hk or hk).alias("_owner"))
        rows = rows.withColumn("_owner", F.unhex(_key(bks))).join(
            owner, "_owner", "left_semi").drop("_owner")
    values = [F.col(f"a_{n}") for n in names]
    made = {hk: _key(bks), "hash_diff": hash_key(*values, null_safe=null_safe)}
    if existing is not None and compare == "any" and end_dated:
        existing = existing.filter(F.col("end_date") == as_timestamp(OPEN_TIMESTAMP))
    new = gathered(_absent(rows, existing, made, zones, batch, bks, compare == "latest"), later)
    return new.select(*[d.alias(c) for c, d in made.items()],
                      *[v.alias(n) for v, n in zip(values, names)],
                      as_timestamp(load_ts).alias("load_dts"),
                      *([as_timestamp(OPEN_TIMESTAMP).alias("end_date")] if end_dated else []),
                      *_zoned(zones))


def load_link_satellite(stg: DataFrame, hk: str, bks: Sequence[str], attrs: dict[str, str],
                        load_ts: LoadTime, existing: DataFrame | None = None,
                        link: DataFrame | None = None, link_hk: str | None = None,
                        compare: str = "any", null_safe: bool = False,
                        zones: Zones | None = None) -> DataFrame:
    """A satellite of a link: keyed by both business keys, without `end_date`."""
    return load_satellite(stg, hk, bks, attrs, load_ts, existing, link, link_hk,
                          compare, end_dated=False, null_safe=null_safe, zones=zones)
