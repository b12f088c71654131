"""Cutting lineage through written tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .files import delete_folder, stored_bytes

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Paths staged by the load that is running, if it has a scope.
_SCOPE: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def staging_root(spark: SparkSession) -> str:
    """The folder named by the session; a temporary one only for local runs without it."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomhouse-"))
    return spark.sparkContext.getCheckpointDir()


def staged_folder(spark: SparkSession) -> str:
    """Where this application writes its staged tables."""
    return f"{staging_root(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables, once nothing built on them is needed."""
    delete_folder(spark, staged_folder(spark))


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside when the scope ends, and no others.

    For a load whose result is stored by then: a frame that still reads a staged table is
    of no use afterwards. Work started through `at_once` belongs to the scope; loads that
    run beside it, and scopes inside it, have their own tables.
    """
    staged: list[str] = []
    token = _SCOPE.set(staged)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in staged:
            delete_folder(spark, path)


def staged_path(spark: SparkSession, name: str) -> str:
    path = f"{staged_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return path


def stage(df: DataFrame, name: str = "table", session: SparkSession | None = None,
          codec: str = "snappy") -> DataFrame:
    """Write once, read back (in `session`, if another one than the table's own).

    The result survives lost executors, is the same for every consumer, is read column
    by column, and carries its true size, so broadcast decisions rest on a measured size.
    zstd as the `codec` writes hex digits in half their length.
    """
    return stage_sized(df, name, session, codec)[0]


def stage_sized(df: DataFrame, name: str = "table", session: SparkSession | None = None,
                codec: str = "snappy") -> tuple[DataFrame, int]:
    """Like `stage`, with the number of bytes written."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return (session or spark).read.schema(df.schema).parquet(path), stored_bytes(spark, path)


Item = TypeVar("Item")
Result = TypeVar("Result")


def at_once(work: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Run actions that do not depend on each other as concurrent Spark jobs, so that the
    last tasks of one share the cluster with the first tasks of the next."""
    todo = list(items)
    if len(todo) < 2:
        return [work(i) for i in todo]
    session = SparkSession.active()
    with ThreadPoolExecutor(len(todo)) as pool:
        # Wrapped one by one: each thread needs its own copy of the job properties.
        running = [pool.submit(copy_context().run, inheritable_thread_target(session)(work), i)
                   for i in todo]
        return [r.result() for r in running]
