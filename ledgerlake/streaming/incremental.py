"""The incremental load as a Structured Streaming job.

The batch design keeps a bookmark table and extracts rows newer than it.  As
a stream, the file source's checkpoint is that bookmark: each raw file is
read exactly once.  Every micro-batch is reduced to its latest row per key
and becomes a partition of a catalog table of changes, with one bookmark row
(table, max timestamp, rows, late rows, run time) in a table beside it.  The
current state of the table is the latest row per key over all changes, read
with the same ``keep_latest`` the staging models use.

A micro-batch that is replayed after a failure replaces its own partitions, so
nothing counts twice.  Late rows, whose time lies more than ``late_after``
behind the newest time of earlier batches, are kept like all others (the state
is decided by time, not by arrival) and counted.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import keep_latest
from ..operators.incremental import batch_watermark, ts_lit
from ..plans.merge import replace_partitions
from ..sources.sinks import write_table, written

BATCH_COL = "_batch_id"


def _tables(schema: str, table: str) -> tuple[str, str]:
    return f"{schema}.{table}_changes", f"{schema}.{table}_marks"


def _replace(df: DataFrame, target: str, batch_id: int) -> None:
    """The batch's partition of ``target`` holds ``df`` afterwards; the first batch creates the table."""
    df = df.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
    if df.sparkSession.catalog.tableExists(target):
        replace_partitions(df, target, [BATCH_COL])
    else:
        write_table(df, target, [BATCH_COL], as_table=True)


def run_incremental_load(spark: SparkSession, source_dir: str, schema: StructType, table: str,
                         keys: Sequence[str], order_by: Sequence[str], ts_col: str,
                         target: str, checkpoint_dir: str, max_files_per_trigger: int = 256,
                         late_after: str = "0 seconds") -> None:
    """Process every raw file not yet seen into the catalog schema ``target``, then stop (``availableNow``)."""
    changes, marks = _tables(target, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch is bounded (maxFilesPerTrigger); keep it for its two
        # uses instead of reading the new files twice.  Lineage still covers
        # a lost executor.
        session = batch.sparkSession
        batch.persist()
        try:
            newest = None
            if session.catalog.tableExists(marks):
                newest = session.table(marks).where(F.col(BATCH_COL) < batch_id).agg(F.max("last_watermark")).first()[0]
            _replace(keep_latest(batch, keys, order_by), changes, batch_id)
            run_ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
            late = F.col(ts_col) < ts_lit(newest) - F.expr(f"INTERVAL {late_after}") if newest else F.lit(False)
            counted = batch.agg(F.count_if(late).alias("late_rows"))
            _replace(batch_watermark(batch, table, ts_col, run_ts).crossJoin(counted), marks, batch_id)
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def current_state(spark: SparkSession, target: str, table: str, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The upserted table: latest row per key over all changes."""
    changes, _ = _tables(target, table)
    return keep_latest(spark.table(changes).drop(BATCH_COL), keys, order_by)


def compact(spark: SparkSession, target: str, table: str, keys: Sequence[str], order_by: Sequence[str]) -> None:
    """The newest batch's partition takes the whole current state, then the older partitions go.

    If it fails between, the older partitions only hold versions that the
    state has already passed over, so every read gives the same rows.  Run it
    between loads.
    """
    changes, _ = _tables(target, table)
    batches = sorted(r[0] for r in spark.table(changes).select(BATCH_COL).distinct().collect())  # one row a batch
    if len(batches) < 2:
        return
    state = written(current_state(spark, target, table, keys, order_by), f"{table}-state")
    _replace(state, changes, batches[-1])
    for batch_id in batches[:-1]:
        spark.sql(f"ALTER TABLE {changes} DROP IF EXISTS PARTITION ({BATCH_COL} = {batch_id})")
    spark.catalog.refreshTable(changes)


def watermarks(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Bookmark of the table: the newest time, and the rows and late rows loaded so far."""
    _, marks = _tables(target, table)
    return spark.table(marks).groupBy("table_name").agg(
        F.max("last_watermark").alias("last_watermark"),
        F.max_by("last_run_status", "last_run_date").alias("last_run_status"),
        F.sum("rows_extracted").alias("rows_extracted"),
        F.sum("late_rows").alias("late_rows"),
        F.max("last_run_date").alias("last_run_date"))
