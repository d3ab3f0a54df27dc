"""The streaming incremental load reaches the same state as the batch dedup."""

import copy
import os
import tempfile
import uuid
from collections import Counter

from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.catalog import Inputs
from ledgerlake.operators.dedup import keep_latest
from ledgerlake.streaming import incremental as S

SF = "/root/testdata/sf0.001"
KEYS = (["customer_id"], ["last_modified_date"])


def test_two_extracts_then_state_equals_batch_dedup(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-stream-")
    src, ckpt = (os.path.join(root, d) for d in ("raw", "ckpt"))
    target = f"stream_{uuid.uuid4().hex}"
    raw = Inputs(spark, SF).raw["customers"]
    times = sorted(r[0] for r in raw.select("last_modified_date").collect() if r[0])
    cut = F.lit(str(times[len(times) // 2])).cast("timestamp_ntz")
    args = dict(schema=copy.deepcopy(schemas.CUSTOMERS), table="customers", keys=KEYS[0], order_by=KEYS[1],
                ts_col="last_modified_date", target=target, checkpoint_dir=ckpt, late_after="10 days")

    def rows(df):
        return Counter(map(tuple, df.select(raw.columns).collect()))

    def state():
        return S.current_state(spark, target, "customers", *KEYS)

    raw.where(F.col("last_modified_date") <= cut).write.mode("append").parquet(src)
    S.run_incremental_load(spark, src, **args)
    first = state().count()

    raw.where(F.col("last_modified_date") > cut).write.mode("append").parquet(src)
    S.run_incremental_load(spark, src, **args)
    S.run_incremental_load(spark, src, **args)      # nothing new: no change
    expected = rows(keep_latest(raw, *KEYS))
    assert rows(state()) == expected
    assert first <= state().count()
    wm = S.watermarks(spark, target, "customers").first()
    assert wm.table_name == "customers" and wm.rows_extracted == raw.where(F.col("last_modified_date").isNotNull()).count()
    assert wm.late_rows == 0  # the second extract holds newer rows only
    assert wm.last_watermark == raw.agg(F.max("last_modified_date")).first()[0]

    # A replayed batch replaces its own partitions: it doesn't count twice.
    again = spark.createDataFrame(raw.where(F.col("last_modified_date") <= cut).toArrow())
    S._replace(keep_latest(again, *KEYS), f"{target}.customers_changes", 0)
    assert rows(state()) == expected
    assert spark.table(f"{target}.customers_changes").select("_batch_id").distinct().count() == 2

    # Late rows are kept and counted.
    late = raw.limit(3).withColumn("customer_id", F.lit(10 ** 6) + F.monotonically_increasing_id()).withColumn(
        "last_modified_date", F.lit("1990-01-01").cast("timestamp_ntz")).select(*[
            F.col(f.name).cast(f.dataType) for f in raw.schema.fields])
    late.write.mode("append").parquet(src)
    S.run_incremental_load(spark, src, **args)
    assert S.watermarks(spark, target, "customers").first().late_rows == 3
    assert state().count() == sum(expected.values()) + 3

    # After a compaction the state stands in one partition; later batches go on from it.
    before = rows(state())
    S.compact(spark, target, "customers", *KEYS)
    assert rows(state()) == before
    assert spark.table(f"{target}.customers_changes").count() == sum(before.values())
    newest = raw.limit(1).withColumn("last_modified_date", F.lit("2030-01-01").cast("timestamp_ntz")).select(raw.columns)
    newest.write.mode("append").parquet(src)
    S.run_incremental_load(spark, src, **args)
    assert state().count() == sum(before.values()) and state().where("last_modified_date >= '2030-01-01'").count() == 1
