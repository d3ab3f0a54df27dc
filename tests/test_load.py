"""The incremental fact and the incremental run equal a full rebuild."""

import datetime as dt
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.catalog import AS_OF, Inputs
from ledgerlake.config import shared_dir
from ledgerlake.plans import load as L
from ledgerlake.plans.merge import fct_transactions_incremental
from ledgerlake.plans.pipeline import Models
from ledgerlake.sources import testviews as tv

SF = "/root/testdata/sf0.001"
CUT = dt.datetime(2024, 1, 10)
OLD, NEW = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 15)


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def frame(spark, table, values):
    schema = schemas.RAW_SCHEMAS[table]
    return spark.createDataFrame([tuple(v.get(f.name) for f in schema.fields) for v in values], schema)


def tx(i, account, date, modified, status="SETTLED", amount="10.00"):
    from decimal import Decimal
    return dict(transaction_id=i, account_id=account, transaction_date=date, amount=Decimal(amount), status=status,
                merchant_city="Auckland", last_modified_date=modified)


def test_incremental_fact_equals_rebuild_on_hard_rows(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    customers = [dict(customer_id=i, first_name="A", last_name=str(i), last_modified_date=OLD) for i in (1, 2)]
    accounts = [dict(account_id=i, customer_id=c, account_type="SAVINGS", last_modified_date=OLD)
                for i, c in ((10, 1), (11, 2), (None, 1))]
    old = [tx(1, 10, day(3), OLD), tx(2, 11, day(4), OLD, "PENDING"), tx(3, 10, None, OLD), tx(None, 11, day(4), OLD),
           tx(4, 99, day(2), OLD), tx(8, 12, day(2), OLD), tx(9, None, day(2), OLD)]
    new = [tx(5, 11, dt.datetime(2023, 5, 1), NEW),            # late
           tx(2, 11, day(4), NEW, "SETTLED"),                   # status change at an equal date
           tx(1, 10, day(1), NEW, "REVERSED"),                  # an older version arrives later
           tx(6, 10, None, NEW), tx(3, 10, day(9), NEW),        # null dates
           tx(None, 10, day(5), NEW), tx(7, 98, day(6), NEW)]   # null id, unknown account
    new_accounts = [dict(account_id=11, customer_id=2, account_type="CHEQUE", last_modified_date=NEW),   # changed
                    dict(account_id=12, customer_id=1, account_type="CREDIT", last_modified_date=NEW)]   # was unknown
    new_customers = [dict(customer_id=1, first_name="B", last_name="1", last_modified_date=NEW)]
    x = Inputs(spark, SF)
    loans = x.raw["loan_applications"]
    before = {"customers": frame(spark, "customers", customers), "accounts": frame(spark, "accounts", accounts),
              "transactions": frame(spark, "transactions", old), "loan_applications": loans}
    after = {"customers": frame(spark, "customers", customers + new_customers),
             "accounts": frame(spark, "accounts", accounts + new_accounts),
             "transactions": frame(spark, "transactions", old + new), "loan_applications": loans}
    existing = Models(before, x.cities, AS_OF)["fct_transactions"]
    merged = fct_transactions_incremental(existing, after, x.cities, dict.fromkeys(after, CUT), AS_OF)
    assert rows(merged) == rows(Models(after, x.cities, AS_OF)["fct_transactions"])
    again = fct_transactions_incremental(merged, after, x.cities, dict.fromkeys(after, CUT), AS_OF)
    assert rows(again) == rows(merged)  # a run repeated changes nothing


@pytest.mark.parametrize("in_place", [False, True])
def test_two_loads_equal_one_and_a_failed_one_loses_nothing(spark, monkeypatch, in_place):
    x = Inputs(spark, SF)
    schema = f"load_{uuid.uuid4().hex}"
    first = {t: x.raw[t].where(~F.coalesce(F.col("last_modified_date") > F.lit(tv.INCREMENTAL_CUTS[t]).cast(
        "timestamp_ntz"), F.lit(False))) for t in tv.RAW_NAMES}
    L.load(spark, first, x.cities, schema, AS_OF, in_place)
    run, marks = L.published_run(spark, schema), L.read_marks(spark, schema)
    before = rows(spark.table(f"{schema}.fct_transactions"))
    assert spark.table(f"{schema}.fct_transactions").count() == Models(first, x.cities, AS_OF)["fct_transactions"].count()
    assert spark.table("stg_customers").columns == x.m["stg_customers"].columns  # the session's views

    monkeypatch.setattr(L, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        L.load(spark, x.raw, x.cities, schema, AS_OF, in_place)
    monkeypatch.undo()
    assert L.published_run(spark, schema) == run and L.read_marks(spark, schema) == marks
    if not in_place:
        assert rows(spark.table(f"{schema}.fct_transactions")) == before

    marts = L.load(spark, x.raw, x.cities, schema, AS_OF, in_place)
    assert L.published_run(spark, schema) != run
    full = Models(x.raw, x.cities, AS_OF)
    for mart, df in marts.items():
        assert rows(df) == rows(full[mart]), mart
    assert len(L.runs_of(spark, schema, "dim_customers")) == 3
    L.drop_old_runs(spark, schema, keep=1)
    assert len(L.runs_of(spark, schema, "dim_customers")) == 1 and rows(spark.table(f"{schema}.dim_customers")) == rows(full["dim_customers"])
    table = f"{schema}.fct_transactions" if in_place else f"{schema}.{L.runs_of(spark, schema, 'fct_transactions')[0]}"
    assert spark.sql(f"SHOW TBLPROPERTIES {table}").where("key = 'delta.columnMapping.mode'").first()["value"] == "name"


def test_load_from_the_command_line(spark):
    from ledgerlake.__main__ import main
    x = Inputs(spark, SF)
    root, schema = f"{shared_dir(spark)}/cli-load-{uuid.uuid4().hex}", f"cli_{uuid.uuid4().hex}"
    for t in tv.RAW_NAMES:
        x.raw[t].where(F.col("last_modified_date") <= F.lit(tv.INCREMENTAL_CUTS[t]).cast("timestamp_ntz")).write.parquet(
            os.path.join(root, "raw", t))
    args = ["load", "--raw", os.path.join(root, "raw"), "--schema", schema, "--as-of", AS_OF]
    assert main(args) == 0
    for t in tv.RAW_NAMES:
        x.raw[t].where(F.col("last_modified_date") > F.lit(tv.INCREMENTAL_CUTS[t]).cast("timestamp_ntz")).write.mode(
            "append").parquet(os.path.join(root, "raw", t))
    assert main(args) == 0
    known = {t: x.raw[t].where(F.col("last_modified_date").isNotNull()) for t in tv.RAW_NAMES}
    assert spark.table(f"{schema}.fct_transactions").count() == Models(known, x.cities, AS_OF)["fct_transactions"].count()
