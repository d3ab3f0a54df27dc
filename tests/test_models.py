"""Dedup edge cases, model semantics on hand-built rows, rewrite equality and invariants."""

import datetime as dt
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests import plain_shapes
from ledgerlake import schemas
from ledgerlake.catalog import AS_OF, Inputs
from ledgerlake.operators.dedup import keep_latest
from ledgerlake.plans import intermediate as I
from ledgerlake.plans import marts as M
from ledgerlake.plans import staging as S
from ledgerlake.sources.raw import read_seed

SF = "/root/testdata/sf0.01"
TS = dt.datetime


def rows_set(df):
    """Order-insensitive multiset of rows."""
    return Counter(tuple(r) for r in df.collect())


def test_keep_latest_edge_cases(spark):
    rows = [(1, TS(2024, 1, 1), "old"), (1, TS(2024, 2, 1), "new"),          # latest kept
            (2, TS(2024, 1, 1), "same"), (2, TS(2024, 1, 1), "same"),        # exact copies -> one
            (3, TS(2024, 1, 1), "a"), (3, TS(2024, 1, 1), "b"),              # tie broken by other cols
            (4, None, "null-ts"), (4, TS(2020, 1, 1), "dated"),               # NULL timestamp loses
            (None, TS(2024, 1, 1), "n1"), (None, TS(2024, 1, 2), "n2")]      # NULL ids: one survivor
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, v string")
    out = {r.id: r.v for r in keep_latest(df, ["id"], ["ts"]).collect()}
    assert out == {1: "new", 2: "same", 3: "b", 4: "dated", None: "n2"}
    assert keep_latest(df, ["id"], ["ts"]).count() == 5


def test_distinct_is_redundant_before_keep_latest(spark):
    raw = Inputs(spark, SF).raw["customers"]
    with_distinct = keep_latest(raw.distinct(), ["customer_id"], ["last_modified_date"])
    without = keep_latest(raw, ["customer_id"], ["last_modified_date"])
    assert rows_set(with_distinct) == rows_set(without)


def _raw(spark, table, rows):
    return spark.createDataFrame(rows, schemas.RAW_SCHEMAS[table])


@pytest.fixture(scope="module")
def tiny(spark):
    t0 = TS(2024, 1, 1, 10)
    customers = _raw(spark, "customers", [
        (1, "Ana", "Lee", dt.date(1990, 1, 1), "a@x", None, None, None, None, None, "retail", "verified", t0, t0),
        (2, "Bo", None, dt.date(1980, 1, 1), "b@x", None, None, None, None, None, "sme", "Pending", t0, t0),
    ])
    accounts = _raw(spark, "accounts", [
        (10, 1, "A10", "credit", "low rate visa", None, D("-500"), D("1000"), "nzd", "Active", dt.date(2020, 1, 1), None, t0),
        (11, 1, "A11", "savings", None, None, D("20"), None, "NZD", "closed", dt.date(2021, 1, 1), dt.date(2023, 1, 1), t0),
        (12, 2, "A12", "mortgage", None, None, None, None, "NZD", "ACTIVE", dt.date(2019, 1, 1), None, t0),  # phantom
    ])
    tx = _raw(spark, "transactions", [
        (100, 10, TS(2024, 1, 1, 3), None, D("-31"), "debit", "eftpos", "x", "gambling", "AUCKLAND", None, None, False, D("31"), "settled", t0),
        (101, 10, TS(2024, 1, 1, 13), None, D("5"), "CREDIT", "atm", "y", "groceries", "Auckland CBD", None, None, False, D("10"), "SETTLED", t0),
        (102, 11, TS(2024, 1, 1, 20), None, D("2000"), "debit", None, None, "crypto", "palmerston north", None, None, False, D("75"), "DECLINED", t0),
        (103, 99, TS(2024, 1, 1, 8), None, D("50"), "debit", None, None, None, None, None, None, False, D("80"), "SETTLED", t0),   # orphan
        (104, 99, TS(2024, 1, 1, 8), None, D("50"), "debit", None, None, None, "Sydney", None, None, False, D("10"), "SETTLED", t0),  # orphan
    ])
    loans = _raw(spark, "loan_applications", [
        (1000, 1, "home_loan", D("1000"), D("700"), None, None, dt.date(2024, 1, 1), dt.date(2024, 1, 5), "approved", None, 760, D("0.2"), t0),
        (1001, 1, "auto_loan", D("100000"), None, None, None, dt.date(2024, 1, 1), None, "DECLINED", "x", 600, D("0.5"), t0),
    ])
    sc, sa = S.stg_customers(customers, AS_OF), S.stg_accounts(accounts, AS_OF)
    st, sl = S.stg_transactions(tx), S.stg_loans(loans)
    return dict(sc=sc, sa=sa, st=st, sl=sl, cities=read_seed(spark))


def test_trap_raw_status_flags(tiny):
    loans = {r.application_id: r for r in tiny["sl"].collect()}
    assert loans[1000].status == "APPROVED" and loans[1000].is_approved is False   # raw 'approved'
    assert loans[1001].is_declined is True
    assert loans[1000].loan_amount_approved_pct == D("70")
    assert loans[1001].approved_amount == D("0") and loans[1001].loan_amount_approved_pct is None
    tx = {r.transaction_id: r for r in tiny["st"].collect()}
    assert tx["100"].status == "SETTLED" and tx["100"].is_settled is False          # raw 'settled'
    assert tx["100"].fraud_risk_band == "LOW RISK" and tx["101"].fraud_risk_band == "HIGH RISK"


def test_int_transactions_phantoms_and_orphans(tiny):
    it = I.int_transactions_enriched(tiny["sa"], tiny["sc"], tiny["st"], tiny["cities"])
    rows = it.collect()
    ids = sorted(r.transaction_id for r in rows if r.transaction_id)
    assert ids == ["100", "101", "102"]                      # orphans 103, 104 dropped
    phantom = [r for r in rows if r.transaction_id is None]
    assert len(phantom) == 1 and phantom[0].customer_id == 2 and phantom[0].account_id is None
    assert phantom[0].transaction_size_band == "LARGE" and phantom[0].is_overseas is True
    by = {r.transaction_id: r for r in rows}
    assert by["100"].is_overseas is False and by["101"].is_overseas is True and by["102"].is_overseas is False
    lit = plain_shapes.int_transactions_enriched_literal(tiny["sa"], tiny["sc"], tiny["st"], tiny["cities"])
    assert rows_set(it) == rows_set(lit)


def test_fct_risk_levels_and_fusion(tiny):
    f = M.fct_transactions(tiny["st"], tiny["sa"], tiny["sc"], tiny["cities"])
    risk = {r.transaction_id: r.transaction_risk_level for r in f.collect()}
    assert risk == {"100": "MEDIUM", "101": "MEDIUM", "102": "HIGH", "103": "HIGH", "104": "NORMAL"}
    orphan = f.where("transaction_id = '103'").first()
    assert orphan.is_fraud is None and orphan.customer_id is None
    lit = plain_shapes.fct_transactions_literal(tiny["st"], tiny["sa"], tiny["sc"], tiny["cities"])
    assert rows_set(f) == rows_set(lit)


def test_dim_customers_defaults_and_text_max(tiny):
    d = {r.customer_id: r for r in M.dim_customers(tiny["sc"], tiny["sa"], tiny["sl"]).collect()}
    assert d[1].total_accounts == 2 and d[1].has_credit_account is True
    assert d[1].max_credit_utilisation_pct == D("50.00")
    assert d[1].latest_credit_score_band == "POOR"            # string max of EXCELLENT, POOR
    assert d[1].has_declined_loan is True and d[1].avg_debt_to_income == D("0.35")
    assert d[2].total_loan_applications == 0 and d[2].has_declined_loan is False
    assert d[2].latest_credit_score_band is None and d[2].has_mortgage is True
    assert d[2].full_name is None                               # NULL last name


@pytest.fixture(scope="module")
def sf_models(spark):
    return Inputs(spark, SF)


def test_rewrites_equal_literal_shapes_at_sf001(sf_models):
    m, x = sf_models.m, sf_models
    lit = plain_shapes.int_transactions_enriched_literal(m["stg_accounts"], m["stg_customers"], m["stg_transactions"], x.cities)
    assert rows_set(m["int_transactions_enriched"]) == rows_set(lit)
    lit_f = plain_shapes.fct_transactions_literal(m["stg_transactions"], m["stg_accounts"], m["stg_customers"], x.cities)
    assert rows_set(m["fct_transactions"]) == rows_set(lit_f)
    # dim summaries from staged rows == summaries of the enriched models (the literal shape)
    a_lit = M.account_summary(m["int_accounts_enriched"])
    a_new = M.account_summary(M.account_measures(m["stg_accounts"]))
    assert rows_set(a_lit) == rows_set(a_new)
    l_lit = M.loan_summary(m["int_loans_enriched"])
    assert rows_set(l_lit) == rows_set(M.loan_summary(M.loan_measures(m["stg_loans"])))
    # count(key) == count(distinct key) on unique staging
    ia = m["int_accounts_enriched"]
    a = ia.groupBy("customer_id").agg(F.count("account_id").alias("n"))
    b = ia.groupBy("customer_id").agg(F.count_distinct("account_id").alias("n"))
    assert rows_set(a) == rows_set(b)


def test_invariants_at_sf001(sf_models):
    m, raw = sf_models.m, sf_models.raw
    for model, table, key in (("stg_customers", "customers", "customer_id"),
                              ("stg_accounts", "accounts", "account_id"),
                              ("stg_loans", "loan_applications", "application_id"),
                              ("stg_transactions", "transactions", "transaction_id")):
        assert m[model].count() == raw[table].select(key).distinct().count()
    assert m["dim_customers"].count() == m["stg_customers"].count()
    assert m["fct_transactions"].count() == m["stg_transactions"].count()
    matched = m["stg_transactions"].join(m["stg_accounts"].select("account_id"), "account_id").count()
    no_tx = m["stg_accounts"].join(m["stg_transactions"].select("account_id"), "account_id", "left_anti").count()
    assert m["int_transactions_enriched"].count() == matched + no_tx


def test_run_pipeline_writes_marts_equal_to_lazy_models(spark, sf_models):
    import os
    from ledgerlake.config import shared_dir
    from ledgerlake.plans.pipeline import run_pipeline
    out = os.path.join(shared_dir(spark), "pipeline_test")
    marts = run_pipeline(spark, {n: sf_models.raw[n] for n in ("customers", "accounts", "transactions",
                                                              "loan_applications")},
                         sf_models.cities, out, AS_OF)
    for name in ("dim_customers", "fct_transactions"):
        assert marts[name].columns == sf_models.m[name].columns
        assert rows_set(marts[name]) == rows_set(sf_models.m[name])


def test_overseas_flag_after_title_case(spark):
    t0 = TS(2024, 1, 1)
    cities_in = ["AUCKLAND", "Auckland CBD", "palmerston north", "Sydney", None]
    tx = _raw(spark, "transactions", [
        (i, 1, t0, None, D("5"), "debit", None, None, None, c, None, None, False, D("1"), "SETTLED", t0)
        for i, c in enumerate(cities_in)])
    acc = _raw(spark, "accounts", [(1, 1, "A1", "cheque", None, None, D("1"), None, "NZD", "active",
                                    dt.date(2020, 1, 1), None, t0)])
    cus = _raw(spark, "customers", [(1, "A", "B", dt.date(1990, 1, 1), None, None, None, None, None, None,
                                     "retail", "verified", t0, t0)])
    it = I.int_transactions_enriched(S.stg_accounts(acc, AS_OF), S.stg_customers(cus, AS_OF),
                                     S.stg_transactions(tx), read_seed(spark))
    got = {r.transaction_id: r.is_overseas for r in it.collect()}
    assert got == {"0": False, "1": True, "2": False, "3": True, "4": True}


def test_fact_is_placed_in_raw_columns(spark):
    """The fact written by month has the same rows; what it derives is computed after the rebalance."""
    x = Inputs(spark, SF)
    placed = x.m.fct_of_raw(by_month=True)
    assert placed.schema == x.m["fct_transactions"].schema
    assert rows_set(placed) == rows_set(x.m["fct_transactions"]) == rows_set(x.m.fct_of_raw())
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        above, _, below = placed._jdf.queryExecution().optimizedPlan().toString().partition("RebalancePartitions")
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert below and "Rebalance" not in below
    for derived in ("transaction_risk_level", "amount_band", "abs_amount", "is_debit", "transaction_hour"):
        assert derived in above and derived not in below
