"""Partition-scoped merge, incremental dimension, customer history and as-of lookups against rebuilds and brute force."""

import datetime as dt
import os
import random
import uuid
from collections import Counter, defaultdict

import pytest

from ledgerlake.catalog import AS_OF, Inputs
from ledgerlake.operators.history import as_of, previous
from ledgerlake.plans.history import TRACKED, dim_customers_history, fct_customer_as_of
from ledgerlake.plans.merge import _latest_of, dim_customers_incremental, fct_transactions_incremental, merge_fct_transactions
from ledgerlake.plans.pipeline import MART_PARTITIONS, Models
from ledgerlake.sources.sinks import write_table
from tests.test_load import CUT, NEW, OLD, SF, frame, rows, tx


def day(n, month=1, year=2024):
    return dt.datetime(year, month, n)


def raw_of(spark, x, customers=(), accounts=(), transactions=(), loans=None):
    return {"customers": frame(spark, "customers", customers), "accounts": frame(spark, "accounts", accounts),
            "transactions": frame(spark, "transactions", transactions),
            "loan_applications": x.raw["loan_applications"] if loans is None else frame(spark, "loan_applications", loans)}


def files_of(spark, table):
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    top = where.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), top): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def test_merge_rewrites_only_touched_months(spark):
    x = Inputs(spark, SF)
    customers = [dict(customer_id=i, first_name="A", last_name=str(i), last_modified_date=OLD) for i in (1, 2)]
    accounts = [dict(account_id=10 + i, customer_id=i, account_type="SAVINGS", last_modified_date=OLD) for i in (1, 2)]
    old = [tx(1, 11, day(3), OLD), tx(2, 11, day(4, 2), OLD), tx(3, 11, day(5, 3), OLD), tx(4, 11, day(6, 4), OLD),
           tx(5, 11, None, OLD), tx(6, 11, day(7, 5), OLD), tx(None, 11, day(8, 6), OLD), tx(9, 12, day(8, 9), OLD)]
    new = [tx(2, 11, day(4, 7), NEW),   # leaves February, which it empties, for July
           tx(3, 11, day(9, 3), NEW),   # moves within its month
           tx(5, 11, day(2, 4), NEW),   # gets a date: the month without a date is emptied
           tx(7, 11, day(1, 4), NEW)]   # new in April
    new_customers = [dict(customer_id=2, first_name="B", last_name="2", last_modified_date=NEW)]  # touches September
    before = raw_of(spark, x, customers, accounts, old)
    after = raw_of(spark, x, customers + new_customers, accounts, old + new)
    table = f"fct_{uuid.uuid4().hex}"
    fct = Models(before, x.cities, AS_OF)["fct_transactions"]
    write_table(fct, table, MART_PARTITIONS["fct_transactions"], as_table=True)
    first = files_of(spark, table)
    since = dict.fromkeys(after, CUT)
    months = merge_fct_transactions(spark, table, after, x.cities, since, AS_OF)
    assert set(months) == {(2024, 2), (2024, 7), (2024, 3), (None, None), (2024, 4), (2024, 9)}
    full = rows(Models(after, x.cities, AS_OF)["fct_transactions"])
    assert rows(spark.table(table)) == full
    then = files_of(spark, table)
    untouched = {f: t for f, t in first.items() if any(f"transaction_month={m}/" in f for m in (1, 5, 6))}
    assert len(untouched) == 3 and untouched.items() <= then.items()
    assert not any("transaction_month=2/" in f for f in then)
    merge_fct_transactions(spark, table, after, x.cities, since, AS_OF)  # a run repeated changes nothing
    assert rows(spark.table(table)) == full
    assert merge_fct_transactions(spark, table, after, x.cities, dict.fromkeys(after, day(1, 1, 2030)), AS_OF) == []


def test_incremental_dimension_equals_rebuild(spark):
    x = Inputs(spark, SF)
    customers = [dict(customer_id=i, first_name="A", last_name=str(i), date_of_birth=dt.date(1990, 1, 1 + i),
                      last_modified_date=OLD) for i in range(1, 7)] + [dict(customer_id=None, last_modified_date=OLD)]
    accounts = [dict(account_id=10 + i, customer_id=i, account_type="CREDIT", open_date=dt.date(2000, 1, i), status="ACTIVE",
                     last_modified_date=OLD) for i in range(1, 6)] + [dict(account_id=30, customer_id=1, last_modified_date=OLD)]
    loans = [dict(application_id=100 + i, customer_id=i, status="APPROVED", credit_score=500, last_modified_date=OLD)
             for i in range(1, 5)]
    new_accounts = [dict(account_id=11, customer_id=2, account_type="SAVINGS", last_modified_date=NEW),   # 1 -> 2: minima of 1 change
                    dict(account_id=13, customer_id=None, last_modified_date=NEW),                        # loses its customer
                    dict(account_id=14, customer_id=4, status="closed", last_modified_date=NEW),          # a flag goes
                    dict(account_id=15, customer_id=6, last_modified_date=day(1))]                        # an older version arrives late
    new_loans = [dict(application_id=104, customer_id=5, status="DECLINED", credit_score=800, last_modified_date=NEW)]
    new_customers = [dict(customer_id=9, first_name="N", last_name="9", last_modified_date=NEW)]
    before = raw_of(spark, x, customers, accounts, (), loans)
    after = raw_of(spark, x, customers + new_customers, accounts + new_accounts, (), loans + new_loans)
    existing = Models(before, x.cities, "2020-01-01")["dim_customers"]
    merged = dim_customers_incremental(existing, after, dict.fromkeys(after, CUT), AS_OF)
    assert rows(merged) == rows(Models(after, x.cities, AS_OF)["dim_customers"])  # ages as of the new date
    assert rows(dim_customers_incremental(merged, after, dict.fromkeys(after, CUT), AS_OF)) == rows(merged)


def customer_versions(seed, n=260):
    rng = random.Random(seed)
    out = [dict(customer_id=rng.choice([1, 1, 1, 1, 2, 3, None]), first_name=rng.choice("AB"), last_name="x",
                kyc_status=rng.choice(["verified", "VERIFIED", "pending", None]),
                last_modified_date=None if rng.random() < 0.03 else dt.datetime(2020 + rng.randint(0, 3), rng.randint(1, 12), rng.randint(1, 3)))
           for _ in range(n)]
    return out + out[:20]


@pytest.mark.parametrize("unit", ["year", "month"])
def test_history_has_no_gaps(spark, unit):
    """A hot customer's states against brute force; each ends where the next begins."""
    versions = customer_versions(5)
    history = dim_customers_history(frame(spark, "customers", versions), unit).collect()
    by = defaultdict(list)
    for r in history:
        by[r["customer_id"]].append(r)
    low = dt.datetime.min
    for key, found in by.items():
        found.sort(key=lambda r: r["valid_from"] or low)
        assert [r["valid_to"] for r in found] == [r["valid_from"] for r in found[1:]] + [None]
        assert [r["is_current"] for r in found] == [False] * (len(found) - 1) + [True]
        last = {}
        for v in versions:  # of equal times the greatest of the rest, as in staging
            if v["customer_id"] == key:
                t = v["last_modified_date"] or low
                rest = (v["first_name"], v["kyc_status"] or "")
                last[t] = max(last.get(t, rest), rest)
        states = []
        for t in sorted(last):
            state = (f"{last[t][0]} x", last[t][1].upper() or None)
            if not states or states[-1][1] != state:
                states.append((t, state))
        assert [(r["valid_from"] or low, (r["full_name"], r["kyc_status"])) for r in found] == states
    assert set(by) == {v["customer_id"] for v in versions}
    assert dim_customers_history(frame(spark, "customers", [])).count() == 0


@pytest.mark.parametrize("unit", ["year", "day"])
def test_as_of_against_brute_force(spark, unit):
    rng = random.Random(unit)
    when = lambda: None if rng.random() < 0.05 else dt.datetime(2020 + rng.randint(0, 2), rng.randint(1, 12), rng.randint(1, 28))
    versions = {(k, when()): None for k in [1] * 150 + [2] * 10 + [None] * 3}
    right = [(k, t, i) for i, (k, t) in enumerate(versions)]
    left = [(rng.choice([1, 1, 1, 2, 3, None]), when(), i) for i in range(400)] + [(1, right[0][1], 900)]
    df = as_of(spark.createDataFrame(left, "k long, t timestamp_ntz, id long"),
               spark.createDataFrame(right, "k long, since timestamp_ntz, v long"), "k", "t", "since", ["v"], "found", unit)
    low = dt.datetime.min

    def brute(k, t):
        fits = [((s or low), v) for rk, s, v in right if rk == k and (s or low) <= t] if k is not None and t else []
        return max(fits)[1] if fits else None

    assert Counter((r["id"], r["found"]["v"] if r["found"] else None) for r in df.collect()) == Counter(
        (i, brute(k, t)) for k, t, i in left)


def test_hot_keys_are_split_by_time(spark):
    """Windows over the key alone see one row a bucket; those over wide rows are split by bucket."""
    raw = frame(spark, "customers", customer_versions(1, 20))
    plan = dim_customers_history(raw)._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "Window [lag(_v" in line and "_own" in line]
    assert wide and all("_bucket" in line for line in wide)


def test_every_transaction_keeps_its_row(spark):
    x = Inputs(spark, SF)
    history = dim_customers_history(x.raw["customers"])
    assert set(TRACKED) <= set(history.columns)
    out = fct_customer_as_of(x.m["stg_transactions"], x.m["stg_accounts"], history)
    assert out.count() == x.m["stg_transactions"].count()


def test_previous_is_null_safe(spark):
    df = spark.createDataFrame([(None, day(1), "a"), (None, day(2), None), (1, None, "b"), (1, day(1, 5), "c")],
                               "k long, t timestamp_ntz, v string")
    out = {(r["k"], r["v"]): r["p"] and r["p"]["v"] for r in previous(df, "k", "t", "v", "p").collect()}
    assert out == {(None, "a"): None, (None, None): "a", (1, "b"): None, (1, "c"): "b"}


def test_lookup_reads_staged_facts_once(spark):
    """The events are used twice; staging and its window aren't part of the lookup's plan."""
    x = Inputs(spark, SF)
    out = fct_customer_as_of(x.m["stg_transactions"], x.m["stg_accounts"], dim_customers_history(x.raw["customers"]))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "transaction_date" in plan and "lineitem" not in plan and "l_shipdate" not in plan


def test_increment_with_null_ids(spark):
    """A touched NULL id is found beside the others, and the raw rows are shuffled once for match and staging."""
    x = Inputs(spark, SF)
    customers = [dict(customer_id=1, first_name="A", last_name="1", last_modified_date=OLD)]
    accounts = [dict(account_id=11, customer_id=1, account_type="SAVINGS", last_modified_date=OLD)]
    old = [tx(None, 11, day(3), OLD), tx(1, 11, day(4), OLD), tx(2, None, day(4), OLD)]
    before = raw_of(spark, x, customers, accounts, old)
    after = raw_of(spark, x, customers, accounts, old + [tx(None, 11, day(5, 2), NEW), tx(2, 11, day(6), NEW)])
    fct = Models(before, x.cities, AS_OF)["fct_transactions"]
    found = fct_transactions_incremental(fct, after, x.cities, dict.fromkeys(after, CUT), AS_OF)
    assert rows(found) == rows(Models(after, x.cities, AS_OF)["fct_transactions"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = after["transactions"].select("transaction_id").distinct().withColumnRenamed("transaction_id", "_id")
        latest = _latest_of(after["transactions"], ids)
        plan = latest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(coalesce" not in plan and "hashpartitioning(transaction_id" in plan
    assert latest.count() == 3
