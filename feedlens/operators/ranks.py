"""Gapless ranks within groups of any size, and joins by a number that many rows lack.

A window by a group puts the whole group into one task.  Here a range sort deals the rows out by
(group, order), so a group that holds most rows spreads over many tasks; each task
numbers its own rows, and what came before a task in its group is added from one row per task and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SPREAD = 1024


def ranked(rows: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """``rows`` with ``out``: 1, 2, ... within each group of ``keys`` (null is a group like any other) by ``order``,
    stored in that order.  ``order`` should tell rows apart; rows that it does not get ranks in any order."""
    by = [*map(F.col, keys), *order]
    # stored: a range sort looks at its input twice, for the ranges and for the rows
    rows = materialize(rows, "unranked")
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed, "ranked").withColumn("_task", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at")
    parts = placed.groupBy(*keys, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    parts = parts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_task").alias("_of"), shift.alias("_shift"))
    same = F.col("_task") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return placed.join(parts, same).select(*rows.columns, (F.col("_row") + F.col("_shift")).alias(out))


def spread_left_join(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """``left`` left joined to ``right`` on the number ``key``.  Left rows without that number match nothing; they
    are dealt over ``SPREAD`` keys by ``by`` in place of one task."""
    apart = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(by), F.lit(SPREAD))).otherwise(F.lit(-1).cast("long"))
    # not a plain -1: the optimizer would take a constant out of the join's keys
    other = F.col(key) - F.col(key) - 1
    return left.withColumn("_apart", apart).join(right.withColumn("_apart", other.cast("long")), [key, "_apart"], "left").drop("_apart")
