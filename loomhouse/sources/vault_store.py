"""Vault tables as append-only Parquet folders, by load and zone of business keys.

    <root>/<table>/_load=NAME/_zone=K/

A load is written to a folder of its own, so a load that is repeated under its name replaces
what a failed attempt left.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.vault import ZONE
from ..session import set_within
from .contracts import VAULT, conform
from .files import child_names, make_folder
from .staging import staging_scope

#: Whole-number keys that lie in one zone: some ten million bytes of a hub.
ZONE_WIDTH = 1 << 20
#: Sizes of bloom filters to choose from, from 1 MiB down by halves: small files need few KiB.
_BLOOM_SIZES = 10
_WIDTH_MARK = "_zone-width-"
#: Rows of a load are read and moved short and sorted with all their digests, ten times as long:
#: tasks get few bytes, so that they need not spill. What a step has shuffled goes with its end.
LOAD_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": str(16 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_LOAD = "_load"


@contextmanager
def load_scope(spark: SparkSession) -> Iterator[None]:
    """For a load: `LOAD_SETTINGS`, and a scope for what it stages."""
    with set_within(spark, LOAD_SETTINGS), staging_scope(spark):
        yield


class VaultStore:
    """Tables under one folder. The width of zones is settled when a folder is first opened and
    kept with it: a key must lie in the same zone at every load."""

    def __init__(self, spark: SparkSession, root: str, zone_width: int = ZONE_WIDTH):
        self.spark = spark
        self.root = root.rstrip("/")
        marks = [n for n in child_names(spark, self.root) if n.startswith(_WIDTH_MARK)]
        self.zone_width = int(marks[0].removeprefix(_WIDTH_MARK)) if marks else zone_width
        if not marks:
            make_folder(spark, f"{self.root}/{_WIDTH_MARK}{zone_width}")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def loads(self, table: str) -> list[str]:
        return [n.removeprefix(f"{_LOAD}=") for n in child_names(self.spark, self.path(table))
                if n.startswith(f"{_LOAD}=")]

    def stored(self, table: str, without: str | None = None) -> DataFrame | None:
        """The stored table with its zones, None before its first load. Loads whose names begin
        with `without` are left out and not read."""
        if not any(without is None or not n.startswith(without) for n in self.loads(table)):
            return None
        schema = T.StructType([*VAULT[table].schema().fields, T.StructField(_LOAD, T.StringType()),
                               T.StructField(ZONE, T.LongType())])
        found = self.spark.read.schema(schema).parquet(self.path(table))
        if without is not None:
            found = found.filter(~F.col(_LOAD).startswith(without))
        return found.drop(_LOAD)

    def read(self, table: str) -> DataFrame | None:
        found = self.stored(table)
        return None if found is None else found.drop(ZONE)

    def append(self, table: str, rows: DataFrame, load: str | None = None,
               gathered: bool = False) -> None:
        """Add zoned rows as a load, which replaces an earlier one of its name. Zones are gathered
        before they are written, large ones in several files, unless the load has `gathered`
        them; within a file rows are ordered by hash key, and a bloom filter of the hash keys
        tells which row groups a few keys cannot be in. Digests are hex digits, which zstd
        writes in half their length."""
        if ZONE not in rows.columns:
            raise ValueError(f"rows of {table} have no zone")
        hk = VAULT[table].columns[0].name
        rows = conform(rows, VAULT[table], [ZONE])
        if not gathered:
            rows = rows.hint("rebalance", ZONE)
        (rows.sortWithinPartitions(ZONE, hk)
         .write.mode("overwrite").partitionBy(ZONE).option("compression", "zstd")
         .option("parquet.compression.codec.zstd.level", "1")
         .option(f"parquet.bloom.filter.enabled#{hk}", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true")
         .option(f"parquet.bloom.filter.candidates.number#{hk}", _BLOOM_SIZES)
         .parquet(f"{self.path(table)}/{_LOAD}={load or uuid.uuid4().hex}"))
