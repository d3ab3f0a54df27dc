"""Positions of rows within groups, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_rows, broadcast_row_limit
from .common import materialize

_IN_PART = (1 << 33) - 1  # monotonically_increasing_id: partition number above, row number within it below


def ranked(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with pos (from 0, by ``order`` within ``group``) and total (rows of the group), as longs.

    ``group`` must not be null.  One sort by range deals rows over tasks, so
    a group that holds a third of all rows is split like any other; a row's
    position is its place in its task plus the rows that earlier tasks have of
    its group.  Rows that are equal in ``order`` are told apart by their place
    in ``rows``, which should be a written table, so that it can be read again
    alike.
    """
    spread = rows.withColumn("_at", F.monotonically_increasing_id())
    placed = spread.orderBy(group, *order, "_at").drop("_at").withColumn("_mid", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_row", F.col("_mid").bitwiseAND(_IN_PART)).drop("_mid"), name)
    parts = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(group)).alias("total")), f"{name}-parts")
    if bounded_rows(parts, broadcast_row_limit(parts)):  # a row for each task and each group at most
        parts = F.broadcast(parts)
    found = placed.join(parts, (placed[group] == parts["_g"]) & (placed["_part"] == parts["_p"]))
    return found.withColumn("pos", F.col("_before") + F.col("_row") - F.col("_first")).select(
        *[c for c in placed.columns if c not in ("_part", "_row")], "pos", "total")
