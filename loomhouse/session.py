"""Session settings this library expects from a cluster."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Skewed join keys are split at run time, also where that costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

_LOCK = threading.Lock()
# By session and key: the value before, and how many need the present one.
_HELD: dict[tuple[int, str], tuple[str | None, int]] = {}


@contextmanager
def set_within(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold inside. Loads that run at once hold them until the last one ends."""
    session = id(spark)
    with _LOCK:
        for key, value in settings.items():
            before, users = _HELD.get((session, key), (spark.conf.get(key, None), 0))
            _HELD[session, key] = before, users + 1
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _LOCK:
            for key in settings:
                before, users = _HELD.pop((session, key))
                if users > 1:
                    _HELD[session, key] = before, users - 1
                elif before is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, before)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster set SETTINGS there."""
    builder = (SparkSession.builder.master(f"local[{cpus}]")
               .appName("loomhouse")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
