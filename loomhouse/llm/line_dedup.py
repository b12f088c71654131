"""Boilerplate lines of a host: dropped where too large a share of its pages has them.

Rows: each row is a page. A missing host is a host of its own; a missing text has no lines
and stays missing; an empty text stays empty. Lines are what lies between line feeds,
compared unchanged; lines of nothing but spaces, tabs and carriage returns are never
boilerplate. A line found
several times on a page counts once. An empty table gives an empty result. Other columns
are carried along under their own names; any named `n_lines` or `n_dropped`, in any case,
are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import named, without

#: A line is boilerplate if more than this share of the pages of a host has it ...
RATIO = 0.05
#: ... and at least so many pages: a line of one page is no repeat.
MIN_PAGES = 2


def _lines(text: str):
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _digest(line):
    return F.unhex(F.md5(line))


def _solid(line):
    return F.trim(F.translate(line, "\t\r", "  ")) != ""


def _fresh(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def boilerplate_lines(pages: DataFrame, host: str = "source", text: str = "text",
                      ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): digests of the boilerplate lines of each host that has any.

    A host's list holds fewer than (its mean number of lines a page) / `ratio` digests.
    Counting combines in the map, so a host with most of the pages does not meet in a task.
    """
    per_page = pages.select(F.col(host).alias("host"),
                            F.array_distinct(F.filter(_lines(text), _solid)).alias("lines"))
    counted = (per_page.select("host", F.explode("lines").alias("line"))
               .select("host", _digest(F.col("line")).alias("line"))
               .groupBy("host", "line").agg(F.count("*").alias("n"))
               .filter(F.col("n") >= min_pages))
    totals = pages.groupBy(F.col(host).alias("total_host")).agg(F.count("*").alias("pages"))
    return (counted.join(totals, F.col("host").eqNullSafe(F.col("total_host")))
            .filter(F.col("n") > F.col("pages") * F.lit(ratio))
            .groupBy("host").agg(F.collect_list("line").alias("lines")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The rows of `pages` with boilerplate lines taken out of `text`, plus the numbers of
    lines before and dropped (`n_lines`, `n_dropped`).

    The lists are written first: Spark then knows their size, broadcasts them if they are
    small and otherwise splits the pages of a large host between tasks.
    """
    pages = without(pages, ("n_lines", "n_dropped"))
    lists = stage(boilerplate_lines(pages, host, text, ratio, min_pages), "boilerplate")
    listed, lost, before, kept = (_fresh(pages, n) for n in ("_host", "_lost", "_before", "_kept"))
    lists = lists.select(F.col("host").alias(listed), F.col("lines").alias(lost))
    joined = pages.join(lists, F.col(host).eqNullSafe(F.col(listed)), "left")
    stays = F.filter(F.col(before), lambda line: ~F.array_contains(F.col(lost), _digest(line)))
    split = (joined.withColumn(before, _lines(text))
             .withColumn(kept, F.when(F.col(lost).isNull(), F.col(before)).otherwise(stays)))
    dropped = F.size(before) - F.size(kept)
    none = F.col(text).isNull()
    return split.select(
        *[F.when(dropped > 0, F.array_join(kept, "\n")).otherwise(F.col(text)).alias(text)
          if c == text else named(c) for c in pages.columns],
        F.when(none, 0).otherwise(F.size(before)).cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"))
