"""Bucketed staged tables: same marts, no shuffle of the bucketed sides, and a way out for hot keys."""

import re
import uuid

import pytest

from ledgerlake.catalog import AS_OF, Inputs
from ledgerlake.config import shared_dir
from ledgerlake.plans import intermediate as I
from ledgerlake.plans.marts import account_measures, account_summary, fct_transactions
from ledgerlake.plans.pipeline import STAGING, run_pipeline
from ledgerlake.sources.sinks import write_bucketed
from tests.test_load import SF, rows


@pytest.fixture
def shuffle_joins(spark):
    """Joins by shuffle, as at volume, and plans as they are before AQE."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan_of(df)))


def test_marts_from_bucketed_staging(spark, shuffle_joins):
    x = Inputs(spark, SF)
    schema = f"buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    marts = run_pipeline(spark, {n: x.raw[n] for n in ("customers", "accounts", "transactions", "loan_applications")}, x.cities,
                         f"{shared_dir(spark)}/{schema}", AS_OF, schema=schema, buckets=4)
    for name, df in marts.items():
        assert rows(df) == rows(x.m[name]), name
    stg = {n: spark.table(f"{schema}.{n}_bucketed") for n in STAGING}
    assert shuffles(I.int_accounts_enriched(stg["stg_accounts"], stg["stg_customers"])) == 0
    assert shuffles(I.int_loans_enriched(stg["stg_loans"], stg["stg_customers"])) == 0
    assert shuffles(account_summary(account_measures(stg["stg_accounts"]))) == 0
    # The fact: the accounts travel to the transactions' buckets, the transactions stay.
    plan = plan_of(fct_transactions(stg["stg_transactions"], stg["stg_accounts"], stg["stg_customers"], x.cities))
    assert sorted(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == ["_city", "account_id"]  # the seed's names; accounts


def test_a_hot_key_is_not_bucketed(spark):
    hot = spark.range(1000).selectExpr("if(id % 3 = 0, 7, id) as k", "id as v")
    table = f"hot_{uuid.uuid4().hex}"
    assert not write_bucketed(hot, table, "k", 16)
    assert rows(spark.table(table)) == rows(hot)
    assert write_bucketed(spark.range(1000).selectExpr("id as k"), f"even_{uuid.uuid4().hex}", "k", 16)
