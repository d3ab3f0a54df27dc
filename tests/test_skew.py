"""A key holding a third of all rows: results stay exact and the plans split or pre-aggregate it."""

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tests import plain_shapes
from ledgerlake.catalog import Inputs
from ledgerlake.plans import intermediate as I
from ledgerlake.plans import marts as M
from ledgerlake.plans import staging as S

SF = "/root/testdata/sf0.01"
HOT = 7

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df):
    """Run the Dataset itself, then read its (final) adaptive plan."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    x = Inputs(spark, SF)
    raw_t = x.raw["transactions"].withColumn(
        "account_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("account_id")))
    return x, S.stg_transactions(raw_t)


def test_hot_account_is_split_in_fact_and_enrichment(spark, skewed):
    x, st = skewed
    sa, sc = x.m["stg_accounts"], x.m["stg_customers"]
    with conf(spark, SKEW_CONF):
        fct_rows, fct_plan = final_plan(M.fct_transactions(st, sa, sc, x.cities))
        it_rows, it_plan = final_plan(I.int_transactions_enriched(sa, sc, st, x.cities))
        lit_rows, lit_plan = final_plan(plain_shapes.int_transactions_enriched_literal(sa, sc, st, x.cities))
    assert "SortMergeJoin(skew=true)" in fct_plan
    assert "SortMergeJoin(skew=true)" in it_plan
    assert "skew=true" not in lit_plan          # the accounts-driven left join cannot be split
    assert Counter(map(tuple, it_rows)) == Counter(map(tuple, lit_rows))
    hot = sum(1 for r in fct_rows if r.account_id == HOT)
    assert hot > len(fct_rows) / 4 and len(fct_rows) == st.count()


def test_hot_dedup_key_is_cut_before_the_shuffle(spark):
    x = Inputs(spark, SF)
    raw = x.raw["transactions"]
    hot = raw.withColumn("transaction_id",
                         F.when(F.col("account_id") % 3 == 0, F.lit(1)).otherwise(F.col("transaction_id")))
    stg = S.stg_transactions(hot)
    plan = stg._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.find("WindowGroupLimit"), plan.find("Exchange")
    assert "Partial" in plan and exchange != -1 and plan.rfind("WindowGroupLimit") > exchange
    assert stg.where("transaction_id = '1'").count() == 1
    assert partial != -1


def test_hot_customer_is_pre_aggregated(spark):
    x = Inputs(spark, SF)
    acc = x.m["stg_accounts"].withColumn("customer_id", F.lit(HOT))
    summary = M.account_summary(M.account_measures(acc))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.rfind("HashAggregate") > plan.find("Exchange")   # partial aggregate below the shuffle
    (row,) = summary.collect()
    assert row.total_accounts == x.m["stg_accounts"].count()
