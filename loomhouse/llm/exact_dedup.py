"""Exact duplicates: frequent digests are settled in the map, the others by a shuffle.

Rows: any; a missing text counts as empty, a missing doc_id as smaller than every other.
Rows repeated under one doc_id and text stand or fall together. An empty table gives an
empty result. Only `doc_id` and `text` are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import doc_key, numbers, own_id, ship, whole_text
from .heavy import frequent

#: A digest held by more than one of this many rows is frequent: at most so many are broadcast.
COUNTERS = 1000


def text_digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the whole text, written once."""
    digest = F.sha2(whole_text(), 256)
    return stage(docs.select(doc_key().alias("doc_id"), digest.alias("text_sha256")), "digests")


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact count and largest doc_id of every digest that more than one in `counters` rows has.

    Misra-Gries summaries of 60-bit prefixes name the candidates; counting them settles
    which are frequent. The result has fewer than `counters` rows.
    """
    prefix = F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long")
    keyed = digests.withColumn("value", prefix)
    rows = digests.count()
    # A summary may miss up to two counters-ths: with four times the counters none is lost.
    candidates = stage(frequent(keyed.select("value"), lambda b: [numbers(b, "value")],
                                1, 4 * counters).select("value"), "candidates")
    counted = (keyed.join(F.broadcast(candidates), "value")
               .groupBy("text_sha256")
               .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return stage(counted.filter(F.col("group_size") * counters > rows), "frequent")


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: the row of its text that stays (largest doc_id) and the number
    of rows with that text."""
    ship(docs)
    digests = text_digests(docs)
    heavy = frequent_digests(digests, counters)
    settled = digests.join(F.broadcast(heavy), "text_sha256")
    same = Window.partitionBy("text_sha256")
    rest = (digests.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
            .withColumn("keep_id", F.max("doc_id").over(same))
            .withColumn("group_size", F.count("*").over(same)))
    both = settled.unionByName(rest)
    return both.select(own_id().alias("doc_id"), own_id("keep_id").alias("keep_id"), "group_size",
                       (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256")
