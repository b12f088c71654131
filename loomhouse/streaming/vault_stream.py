"""Continuous vault loads.

Two streaming queries over the same source. The first keeps the business keys of all hubs and
links it has seen in Spark's streaming state and passes on a key once, in the batch that brings
it: stored hubs and links are not read, however long the stream. The second compares the
attributes of each batch with the stored satellites, in the zones of its keys. Every batch is
written as a load of its own name, so a batch that is run again after a failure replaces what
the first attempt wrote.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans import vault
from ..session import set_within
from ..sources.staging import at_once, stage
from ..sources.vault_store import LOAD_SETTINGS, VaultStore, load_scope

ATTRIBUTES = [*vault.SATELLITES, *vault.LINK_SATELLITES]

_STATE = "spark.sql.streaming.stateStore."
#: State grows with the keys, so it lies on local disks instead of in the heap, and a batch saves
#: what it changes. A stream that is taken up again keeps the kind of state it began with.
STATE_SETTINGS = {
    f"{_STATE}providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}rocksdb.trackTotalNumberOfRows": "false",
    f"{_STATE}rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}rocksdb.compression": "zstd",
    f"{_STATE}compression.codec": "zstd",
}


class VaultStream:
    """The queries of a vault stream, handled as one."""

    def __init__(self, queries: Sequence[StreamingQuery]):
        self.queries = list(queries)

    def awaitTermination(self) -> None:
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def _key_columns(table: str) -> list[str]:
    if table in vault.HUBS:
        return [vault.HUBS[table][1]]
    return [vault.HUBS[h][1] for h in vault.LINKS[table][1]]


def first_seen(staged: DataFrame, source: str = "source_system") -> DataFrame:
    """(table, one, other, source): the keys of hubs and links in the batch that brings them
    first, with the least of the source systems that deliver them in it.

    The state holds for each key the time of its first batch: it is new as long as that is the
    time of the batch. It is kept short, with a number in place of a table's name, and of keys
    if all are whole numbers, which are alike if their texts are.
    """
    tables, kinds = [*vault.HUBS, *vault.LINKS], []
    types = {staged.schema[bk].dataType for _, bk in vault.HUBS.values()}
    kind = "bigint" if all(isinstance(t, T.IntegralType) for t in types) else "string"
    for number, table in enumerate(tables):
        one, *other = [F.col(c).cast(kind) for c in _key_columns(table)]
        whole = one.isNotNull() & (other[0].isNotNull() if other else F.lit(True))
        # The key itself first: where keys are sorted, its first bytes tell most of them apart.
        key = F.struct(one.alias("one"),
                       (other[0] if other else F.lit(None).cast(kind)).alias("other"),
                       F.lit(number).cast("tinyint").alias("table"))
        kinds.append(F.when(whole, key))
    # In a stream this is the time of the batch.
    now = F.current_timestamp()
    keys = staged.select(F.explode(F.array(*kinds)).alias("key"),
                         F.struct(now.alias("seen"), F.col(source).alias("source")).alias("first")
                         ).filter("key IS NOT NULL")
    known = keys.select("key.*", "first").groupBy("one", "other", "table").agg(
        F.min("first").alias("first"))
    names = F.array(*[F.lit(t) for t in tables])
    return known.filter(F.col("first.seen") == now).select(
        names[F.col("table")].alias("table"),
        *[F.col(c).cast("string").alias(c) for c in ("one", "other")],
        F.col("first.source").alias("source"))


def vault_stream(staged: DataFrame, store: VaultStore, checkpoint: str,
                 load_ts: Callable[[int], dt.datetime | str], compare: str = "any",
                 available_now: bool = True, written: bool = False) -> VaultStream:
    """Load a stream of staged orders; `load_ts` gives the load time of a batch number. Rows that
    are `written` already, as a stream of files as they are, are not written again.

    What other loads stored before, or store meanwhile, is respected: batches are compared
    with it, but not with what this stream, known by its checkpoint, has written of keys.
    """
    name = "stream-" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def load_keys(batch: DataFrame, number: int) -> None:
        with load_scope(store.spark):
            # Written first, and only once: looking into the batch would run its state, too.
            new = stage(batch, "new_keys", store.spark, "zstd")
            if new.isEmpty():
                return

            def load(table: str) -> None:
                one, *other = _key_columns(table)
                rows = new.filter(F.col("table") == table).select(
                    F.col("one").alias(one), *[F.col("other").alias(c) for c in other],
                    F.col("source").alias("source_system"))
                make = vault.hub if table in vault.HUBS else vault.link
                stored = store.stored(table, name)
                added = make(rows, table, load_ts(number), stored, zone_width=store.zone_width,
                             once=True)
                store.append(table, added, f"{name}-{number}.", gathered=True)

            for layer in (vault.HUBS, vault.LINKS):
                at_once(load, layer)

    def load_attributes(batch: DataFrame, number: int) -> None:
        load = f"{name}-{number}."
        if batch.isEmpty():
            return
        with load_scope(store.spark):
            stored = batch if written else stage(batch, "stg_orders", store.spark, "zstd")
            existing = {t: store.stored(t, load) for t in ATTRIBUTES}
            added = vault.run_vault(stored, load_ts(number), existing, compare,
                                    store.zone_width, ATTRIBUTES)
            at_once(lambda t: store.append(t, added[t], load, gathered=True), ATTRIBUTES)

    def started(rows: DataFrame, load: Callable, part: str) -> StreamingQuery:
        writer = (rows.writeStream.foreachBatch(load).outputMode("update")
                  .option("checkpointLocation", f"{checkpoint}/{part}"))
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    # The queries copy the settings as they start.
    with set_within(store.spark, STATE_SETTINGS | LOAD_SETTINGS):
        return VaultStream([started(first_seen(staged), load_keys, "keys"),
                            started(staged, load_attributes, "attributes")])
