"""Previous-row and as-of lookups over time, split for hot keys.

Rows of a key are ordered by time.  A window over the key alone puts a key
that holds a third of all rows into one task, so time is cut into buckets: the
wide rows meet only rows of their own (key, bucket), and what a bucket needs
from earlier ones is a single row, carried in.  The carried rows come from one
aggregated row per (key, bucket), which is all that a window over the key sees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_of(ts: str, unit: str = "month") -> Column:
    """The time bucket of a row; NULL times have one of their own, before all others."""
    return F.date_trunc(unit, F.col(ts))


def previous(df: DataFrame, key: str, order: str, value: str, out: str, unit: str = "month",
             backwards: bool = False) -> DataFrame:
    """``df`` plus ``out``: a struct of ``value`` of the key's row before (or after, if ``backwards``); NULL if none.

    Rows of a key must differ in ``order``, a time; NULL comes first.
    """
    rows = df.withColumn("_bucket", bucket_of(order, unit)).withColumn("_v", F.struct(value))
    nearest = F.min_by if backwards else F.max_by
    direction = (lambda c: F.desc_nulls_last(c)) if backwards else (lambda c: F.asc_nulls_first(c))
    ends = rows.groupBy(key, "_bucket").agg(nearest("_v", F.struct(order)).alias("_v"))
    before = F.lag("_v").over(Window.partitionBy(key).orderBy(direction("_bucket")))
    carried = ends.withColumn("_v", before).where(F.col("_v").isNotNull())
    both = rows.withColumn("_own", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    place = Window.partitionBy(key, "_bucket").orderBy(F.asc_nulls_first("_own"), direction(order))
    return both.withColumn(out, F.lag("_v").over(place)).where("_own").drop("_bucket", "_v", "_own")


def as_of(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, values: Sequence[str],
          out: str, unit: str = "month") -> DataFrame:
    """``left`` plus ``out``: a struct of ``values`` of the key's last ``right`` row at or before ``left_ts``.

    A NULL ``right_ts`` holds from the beginning.  Rows of ``left`` with a
    NULL key or time, or before the key's first row, get NULL.  Both sides are
    shuffled once by (key, bucket); no range join is formed.
    """
    dated = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    events = left.where(dated).select(
        F.col(key).alias("_key"), F.col(left_ts).alias("_ts"), F.struct(*left.columns).alias("_left"),
        bucket_of(left_ts, unit).alias("_bucket"))
    versions = right.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(right_ts).alias("_ts"), F.struct(*values).alias("_right"),
        bucket_of(right_ts, unit).alias("_bucket"))
    # The last version of each bucket, and the buckets that events ask for.
    ends = versions.groupBy("_key", "_bucket").agg(F.max_by("_right", F.struct("_ts")).alias("_right"))
    asked = events.select("_key", "_bucket").distinct()
    earlier = Window.partitionBy("_key").orderBy(F.asc_nulls_first("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    marks = ends.join(asked, ["_key", "_bucket"], "full_outer")  # both have a row per key and bucket
    carried = marks.withColumn("_right", F.last("_right", ignorenulls=True).over(earlier)).where("_right is not null")
    rows = (events.withColumn("_kind", F.lit(2)).unionByName(versions.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
            .unionByName(carried.withColumn("_kind", F.lit(0)), allowMissingColumns=True))
    so_far = Window.partitionBy("_key", "_bucket").orderBy(
        F.col("_kind") > 0, F.asc_nulls_first("_ts"), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn(out, F.last("_right", ignorenulls=True).over(so_far)).where("_kind = 2").select("_left.*", out)
    rest = left.where(~dated | dated.isNull())
    return found.unionByName(rest.withColumn(out, F.lit(None).cast(found.schema[out].dataType)))
