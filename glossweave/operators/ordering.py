"""Exact positions and running sums without a single-task window.

A window ordered over a whole language, or over the whole table, would run in one task. Here rows
are range-partitioned by (group, order), so a large group spreads over many partitions; each row
then needs only its place inside its own partition plus the totals of the partitions before it,
and there are as many totals as partitions and groups, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.session import materialise, shuffle_partitions

# Offsets are broadcast up to this many rows; beyond, they are joined by shuffle.
BROADCAST_OFFSETS = 100_000


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_OFFSETS) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def ordered_positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    *,
    position: str = "pos",
    running: dict[str, str] | None = None,
    totals: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add the 0-based ``position`` of each row in its group.

    ``running`` maps new columns to numeric columns whose inclusive running sum they take; ``totals``
    does the same for the sum over the whole group. (group, order) must identify a row. The placed
    rows are written once, since sampled range bounds may differ between two evaluations.
    """
    running, totals = running or {}, totals or {}
    group, order = list(group), list(order)
    keys = ["_slice", *group]
    placed = (
        df.repartitionByRange(partitions or shuffle_partitions(df.sparkSession), *group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )
    placed = materialise(placed, "positions")

    summed = sorted({*running.values(), *totals.values()})
    slices = placed.groupBy(*keys).agg(
        F.min("_at").alias("_first"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(c).alias(f"_sum_{c}") for c in summed],
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *keys,
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in set(running.values())],
        *[F.sum(f"_sum_{c}").over(whole).alias(name) for name, c in totals.items()],
    )
    offsets = materialise(offsets, "offsets")
    offsets = broadcast_if_small(offsets, offsets.count())

    joined = placed.join(offsets, _same(placed, offsets, keys)).select(
        *[placed[c] for c in placed.columns],
        "_shift",
        *[f"_before_{c}" for c in set(running.values())],
        *totals,
    )
    inside = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    result = joined.withColumn(position, F.col("_at") + F.col("_shift"))
    for name, c in running.items():
        result = result.withColumn(name, F.sum(c).over(inside) + F.col(f"_before_{c}"))
    return result.select(*df.columns, position, *running, *totals)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """Null-safe equality, because a group column may be NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys find each other; the keys of ``left`` stay."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"`{key}`").eqNullSafe(F.col(f"`_right_{key}`"))
    return left.join(named, condition).drop(*[f"_right_{k}" for k in keys])


def with_row_id(df: DataFrame, order: Sequence[str] | None = None, name: str = "row_id") -> DataFrame:
    """``df`` with an id from 0 without gaps, written once so that every later step sees the same one.

    Rows are numbered by ``order``, or as they are read if none is given.
    """
    if order is None:
        df = materialise(df.withColumn("_read", F.monotonically_increasing_id()), "as-read")
        return with_row_id(df, ["_read"], name).drop("_read")
    placed = ordered_positions(df, [], list(order), position=name)
    return materialise(placed.select(F.col(name), *[F.col(f"`{c}`") for c in df.columns]), "row-ids")
