"""Ordered slices, sums over slices, and dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

SLICE = "_slice"
POSITION = "_position"
# monotonically_increasing_id keeps the row index of a partition in its low 33 bits.
_ROW_INDEX_MASK = (1 << 33) - 1
#: A node of the tree over slices has 2 ** FAN_BITS children; no window holds more rows.
FAN_BITS = 10
#: Up to this many slices, one short row each, a table of slices is broadcast.
BROADCAST_SLICES = 1 << 19


def ordered_slices(df: DataFrame, order_by: Sequence[str], slices: int | None = None,
                   unique: bool = False) -> DataFrame:
    """Range-partition by `order_by`, sort each partition and write it.

    Adds the slice number and the position in the slice: reading slices in turn gives the
    total order. Unless `order_by` is `unique`, all other columns break ties, so that one
    frequent `order_by` value still spreads over many slices. With an empty `order_by` the partitions are written as they
    come: no shuffle, any order, but fixed from then on.
    """
    if order_by:
        ties = [] if unique else [c for c in df.columns if c not in order_by]
        order = [*order_by, *ties]
        ranged = (df.repartitionByRange(slices, *order) if slices
                  else df.repartitionByRange(*order))
        df = ranged.sortWithinPartitions(*order)
    placed = df.select(
        F.spark_partition_id().alias(SLICE),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_INDEX_MASK)).alias(POSITION),
        "*",
    )
    return stage(placed, "slices")


def _ancestor(depth: int, column: str = SLICE) -> Column:
    return F.shiftright(F.col(column), FAN_BITS * depth)


def _earlier():
    """The slices before one in its run."""
    return (Window.partitionBy(_ancestor(1)).orderBy(SLICE)
            .rowsBetween(Window.unboundedPreceding, -1))


def _levels(per_slice: DataFrame) -> int:
    """Depth of the tree over the slices of a written table."""
    highest = per_slice.agg(F.max(SLICE)).first()[0] or 0
    return max(1, -(-int(highest).bit_length() // FAN_BITS))


def _one_run(df: DataFrame, order_by: Sequence[str], slices: int | None) -> bool:
    """Whether ordered slices are sure to be so few that they are one run of the tree."""
    conf = df.sparkSession.conf
    most = slices or max(int(conf.get("spark.sql.shuffle.partitions")), int(conf.get(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "1")))
    return bool(order_by) and most <= 1 << FAN_BITS


def by_slice(rows: DataFrame, per_slice: DataFrame, how: str = "left", one_run: bool = False
             ) -> DataFrame:
    """Join rows with a table of at most one short row a slice; it is broadcast while the
    number of slices allows."""
    few = one_run or _levels(per_slice) * FAN_BITS <= BROADCAST_SLICES.bit_length()
    return rows.join(F.broadcast(per_slice) if few else per_slice, SLICE, how)


def slice_offsets(totals: DataFrame, columns: Sequence[str], one_run: bool = False) -> DataFrame:
    """For each slice the sums of `columns` over all slices before it.

    `totals` has one row per slice. Sums run through a tree: slices within their run of
    2 ** FAN_BITS, those runs within theirs, and so on, so that no task orders all slices
    and none of them reach the driver. Beyond one run the tables of the tree are written.
    """
    if one_run:
        return totals.select(SLICE, *[F.coalesce(F.sum(c).over(_earlier()), F.lit(0)).alias(c)
                                      for c in columns])
    totals = stage(totals.select(SLICE, *columns), "totals")
    offsets = totals.select(SLICE, *[F.lit(0).cast("long").alias(c) for c in columns])
    for depth in range(_levels(totals)):
        nodes = totals if depth == 0 else totals.groupBy(_ancestor(depth).alias(SLICE)).agg(
            *[F.sum(c).alias(c) for c in columns])
        before = nodes.select(F.col(SLICE).alias("_node"), *[
            F.coalesce(F.sum(c).over(_earlier()), F.lit(0)).alias(f"_before_{c}")
            for c in columns])
        offsets = offsets.join(before, _ancestor(depth) == F.col("_node")).select(
            SLICE, *[(F.col(c) + F.col(f"_before_{c}")).alias(c) for c in columns])
    return stage(offsets, "offsets")


def following_heads(heads: DataFrame, head: str, one_run: bool = False) -> DataFrame:
    """For each slice the value of `head` in the next slice that has rows.

    Looked up in the slice's own run of 2 ** FAN_BITS slices first, for the last one of a run
    at the first slice of the next run, and so on up the tree, whose tables are written.
    """
    if one_run:
        within = Window.partitionBy(_ancestor(1)).orderBy(SLICE)
        return heads.select(SLICE, F.lead(head).over(within).alias(head))
    heads = stage(heads.select(SLICE, head), "heads")
    found = heads.select(SLICE, F.lit(None).cast(heads.schema[head].dataType).alias(head))
    for depth in range(_levels(heads)):
        nodes = heads.groupBy(_ancestor(depth).alias("_node")).agg(
            F.min_by(head, SLICE).alias("_first"))
        ahead = F.lead("_first").over(Window.partitionBy(_ancestor(1, "_node")).orderBy("_node"))
        found = found.join(nodes.select("_node", ahead.alias("_ahead")),
                           _ancestor(depth) == F.col("_node")).select(
            SLICE, F.coalesce(head, "_ahead").alias(head))
    return stage(found, "heads")


def assign_sk(df: DataFrame, order_by: Sequence[str], sk: str = "sk", start: int = 0,
              slices: int | None = None, unique: bool = False) -> DataFrame:
    """Number rows start+1, start+2, ... in `order_by` order.

    Equals row_number() over the whole table. Offsets of the slices are summed up in a tree
    and joined by slice: no row count reaches the driver.
    """
    placed, one_run = ordered_slices(df, order_by, slices, unique), _one_run(df, order_by, slices)
    offsets = slice_offsets(placed.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_rows")),
                            ["_rows"], one_run)
    number = F.col("_rows") + F.col(POSITION) + F.lit(start + 1)
    return by_slice(placed, offsets, one_run=one_run).select(number.cast("long").alias(sk), *df.columns)


def highest_sk(df: DataFrame, sk: str) -> int:
    """Largest key in use, 0 for an empty table."""
    return df.agg(F.max(sk)).first()[0] or 0


def next_row(df: DataFrame, group: Sequence[str], order_by: Sequence[str],
             take: Sequence[str], prefix: str = "next_", slices: int | None = None) -> DataFrame:
    """lead() of `take` within `group`, safe for a group of any size.

    The window runs over balanced slices, not over groups, so one huge group is shared
    between tasks; the last row of a slice looks up the first row of the following slice.
    """
    placed = ordered_slices(df, [*group, *order_by], slices)
    peeked = F.struct(*group, *take)
    inside = F.lead(peeked).over(Window.partitionBy(SLICE).orderBy(POSITION))
    heads = placed.filter(F.col(POSITION) == 0).select(SLICE, peeked.alias("_head"))
    one_run = _one_run(df, order_by, slices)
    looked = by_slice(placed.withColumn("_ahead", inside),
                      following_heads(heads, "_head", one_run), one_run=one_run
                      ).withColumn("_ahead", F.coalesce("_ahead", "_head"))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_ahead.{g}"))
    return looked.select(
        *df.columns,
        *[F.when(same, F.col(f"_ahead.{c}")).alias(prefix + c) for c in take])
