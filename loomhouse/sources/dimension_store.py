"""A versioned dimension on plain Parquet folders.

    <root>/current/version=N/part=K/   current versions that refresh N wrote, by key
    <root>/closed/version=N/           the versions that refresh N ended
    <root>/commits/version=N/          which version holds each part after refresh N

Keys are dealt into a fixed number of parts by their hash. A refresh joins the source once
with the current versions in the parts that its keys belong to, appends what it closed as a new
folder, rewrites only the parts in which a key changed or is new, and writes the list of parts
last. That folder's success marker
commits the refresh: readers take the newest marked list, the files it names, and history up to
it. Parts that no key touched keep their files. A refresh that died leaves no marker and its
folders are simply written again. History is never rewritten; of the current folders the last
`RETAINED` states stay, for readers that still use them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd2 import (
    CHANGED,
    NEW,
    Dimension,
    Parent,
    closed_versions,
    kept_versions,
    opened_versions,
    parents_first,
    rekeyed,
    scd2_delta,
    scd2_init,
    with_parent_sk,
)
from .files import child_names, delete_folder, make_folder, path_exists
from .staging import at_once, stage, stage_sized, staging_scope

#: Stored bytes of a part at the first load, and at most so many parts.
PART_BYTES = 32 << 20
MOST_PARTS = 4096
#: Committed states whose files are kept.
RETAINED = 2

_PART = "_part"
_COMMIT = "part int, held_by int, parts int, highest long"


class DimensionStore:
    """`parts` settles the number of parts at the first load; without, the bytes loaded do."""

    def __init__(self, spark: SparkSession, root: str, spec: Dimension, schema: T.StructType,
                 parts: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.schema = T.StructType([schema[c] for c in spec.columns])
        self.parts = parts

    def _current_path(self, version: int, part: int | None = None) -> str:
        path = f"{self.root}/current/version={version}"
        return path if part is None else f"{path}/{_PART}={part}"

    def _closed_path(self, version: int) -> str:
        return f"{self.root}/closed/version={version}"

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/commits/version={version}"

    def _versions(self, kind: str) -> list[int]:
        """Numbers of the folders of a kind, newest first."""
        return sorted((int(n.split("=")[1]) for n in child_names(self.spark, f"{self.root}/{kind}")
                       if n.startswith("version=")), reverse=True)

    def committed(self) -> int:
        """Number of the newest complete refresh, 0 before the first load."""
        return next((n for n in self._versions("commits")
                     if path_exists(self.spark, f"{self._commit_path(n)}/_SUCCESS")), 0)

    def _state(self, version: int) -> tuple[dict[int, int], int, int]:
        """After a refresh: the version that holds each part, the number of parts, and the
        highest surrogate key."""
        rows = self.spark.read.schema(_COMMIT).parquet(self._commit_path(version)).collect()
        held = {r["part"]: r["held_by"] for r in rows if r["part"] >= 0}
        return held, rows[0]["parts"], rows[0]["highest"]

    def _held(self, version: int) -> dict[int, int]:
        return self._state(version)[0]

    def _read_parts(self, held: Mapping[int, int]) -> DataFrame:
        paths = [self._current_path(v, k) for k, v in sorted(held.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def current(self) -> DataFrame:
        return self._read_parts(self._held(self.committed()))

    def read(self) -> DataFrame:
        """Every version, current and closed."""
        version = self.committed()
        current = self._read_parts(self._held(version))
        if not path_exists(self.spark, f"{self.root}/closed"):
            return current
        numbered = T.StructType([*self.schema.fields, T.StructField("version", T.IntegerType())])
        closed = (self.spark.read.schema(numbered).parquet(f"{self.root}/closed")
                  .filter(F.col("version") <= version).drop("version"))
        return current.unionByName(closed)

    def changes(self, since: int) -> DataFrame | None:
        """`old_sk` and `new_sk` of the versions that refreshes after `since` ended and their
        successors, None if there are none. Only parts written since then are read."""
        held = self._held(self.committed())
        ended = [self._closed_path(n) for n in self._versions("closed")
                 if since < n <= self.committed()]
        if not ended or not since:
            return None
        closed = self.spark.read.schema(self.schema).parquet(*ended).select(
            self.spec.bk, F.col(self.spec.sk).alias("old_sk"))
        now = self._read_parts({k: v for k, v in held.items() if v > since}).select(
            self.spec.bk, F.col(self.spec.sk).alias("new_sk"))
        return stage(closed.join(now, self.spec.bk).select("old_sk", "new_sk"), "changes")

    def followed(self, parent: str) -> int:
        """The refresh of a parent up to which this dimension points to its versions."""
        marks = [n.removeprefix(f"{parent}=") for n in
                 child_names(self.spark, f"{self.root}/followed") if n.startswith(f"{parent}=")]
        return max(map(int, marks), default=0)

    def mark_followed(self, parent: str, version: int) -> None:
        make_folder(self.spark, f"{self.root}/followed/{parent}={version}")

    def refresh(self, src: DataFrame, as_of: dt.date | str) -> None:
        """First load or refresh, committed as one step; `src` may be all keys or some.

        Versions are only ever closed for a successor, so every key is found among the
        current versions: history is not read, and of the current versions only the parts
        that keys of the source belong to. What the refresh staged is deleted with its end.
        """
        version = self.committed()
        src = src.select(*[F.col(c).cast(self.schema[c].dataType).alias(c)
                           for c in (self.spec.bk, *self.spec.attrs)])
        with staging_scope(self.spark):
            if version == 0:
                self._first(src, as_of)
            else:
                self._next(src, as_of, version)
        self._drop_unused()

    def _first(self, src: DataFrame, as_of: dt.date | str) -> None:
        loaded, size = stage_sized(scd2_init(src, self.spec, as_of), "first")
        parts = min(self.parts or -(-size // PART_BYTES) or 1, MOST_PARTS)
        held = dict.fromkeys(self._write_current(loaded, 1, parts), 1)
        self._commit(1, held, parts, loaded.count())

    def _next(self, src: DataFrame, as_of: dt.date | str, version: int) -> None:
        held, parts, highest = self._state(version)
        src = stage(src.withColumn(_PART, self._part(parts)), "source")
        asked = {r[_PART] for r in src.select(_PART).distinct().collect()}
        met = self._read_parts({k: v for k, v in held.items() if k in asked})
        delta = scd2_delta(src.drop(_PART), met, self.spec, as_of, False, highest)
        delta = stage(delta.withColumn(_PART, self._part(parts)), "delta")
        # One row for each part and kind at most.
        touched = delta.groupBy(_PART, "_kind").count().collect()
        delete_folder(self.spark, self._closed_path(version + 1))  # of a refresh that died
        if any(r["_kind"] == CHANGED for r in touched):
            closed = closed_versions(delta, self.spec, as_of).select(*self.spec.columns)
            closed.write.mode("overwrite").parquet(self._closed_path(version + 1))
        keys = {r[_PART] for r in touched}
        if keys:
            current = self._read_parts({k: v for k, v in held.items() if k in keys})
            following = kept_versions(current, delta, self.spec).unionByName(
                opened_versions(delta, self.spec, as_of))
            held |= dict.fromkeys(self._write_current(following, version + 1, parts), version + 1)
        added = sum(r["count"] for r in touched if r["_kind"] in (CHANGED, NEW))
        self._commit(version + 1, held, parts, highest + added)

    def _part(self, parts: int):
        return F.pmod(F.xxhash64(F.col(self.spec.bk).cast("string")), F.lit(parts)).cast("int")

    def _write_current(self, df: DataFrame, version: int, parts: int) -> list[int]:
        """Write by parts; which of them have rows."""
        (df.select(*self.spec.columns, self._part(parts).alias(_PART)).hint("rebalance", _PART)
         .write.mode("overwrite").partitionBy(_PART).parquet(self._current_path(version)))
        return [int(n.split("=")[1]) for n in child_names(self.spark, self._current_path(version))
                if n.startswith(f"{_PART}=")]

    def _commit(self, version: int, held: Mapping[int, int], parts: int, highest: int) -> None:
        # A row without a part tells the rest of an empty dimension, too.
        rows = [(k, v, parts, highest) for k, v in [(-1, 0), *held.items()]]
        (self.spark.createDataFrame(rows, _COMMIT).coalesce(1)
         .write.mode("overwrite").parquet(self._commit_path(version)))

    def _drop_unused(self) -> None:
        """Delete lists of parts but the newest ones, and current files that these do not name."""
        newest = self.committed()
        listed = [n for n in self._versions("commits") if n <= newest]
        for n in listed[RETAINED:]:
            delete_folder(self.spark, self._commit_path(n))
        used = {(v, k) for n in listed[:RETAINED] for k, v in self._held(n).items()}
        for version in self._versions("current"):
            if version > newest:
                continue
            parts = [n for n in child_names(self.spark, self._current_path(version))
                     if n.startswith(f"{_PART}=")]
            unused = [n for n in parts if (version, int(n.split("=")[1])) not in used]
            if len(unused) == len(parts):
                delete_folder(self.spark, self._current_path(version))
                continue
            for n in unused:
                delete_folder(self.spark, f"{self._current_path(version)}/{n}")


def refresh_stores(stores: Mapping[str, DimensionStore], sources: Mapping[str, DataFrame],
                   parents: Mapping[str, Sequence[Parent]], as_of: dt.date | str) -> None:
    """Refresh stored dimensions, parents before the children that point to their versions.

    A child without a source follows its parents: only its keys that point to a version that
    has ended since it last did are refreshed, with the key of the successor. How far it has
    followed is marked afterwards, so a call that died is made up for by the next one.
    """
    def refresh(name: str) -> None:
        child, src = stores[name], sources.get(name)
        pointed = {p: stores[p.name].committed() for p in parents.get(name, ())}
        for parent in pointed:
            store = stores[parent.name]
            if src is not None:
                src = with_parent_sk(src, store.current(), store.spec, parent.column)
            elif (changes := store.changes(child.followed(parent.name))) is not None:
                child.refresh(rekeyed(child.current(), child.spec, store.spec.sk, changes), as_of)
        if src is not None:
            child.refresh(src, as_of)
        for parent, version in pointed.items():
            child.mark_followed(parent.name, version)

    for names in parents_first(stores, parents):
        at_once(refresh, names)
