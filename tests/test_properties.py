"""Property tests: random small inputs against brute force / the literal shape."""

import datetime as dt
from collections import Counter
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests import plain_shapes
from ledgerlake import schemas
from ledgerlake.operators.dedup import keep_latest
from ledgerlake.plans import intermediate as I
from ledgerlake.plans import staging as S
from ledgerlake.sources.raw import read_seed

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

keys = st.one_of(st.none(), st.integers(0, 4))
stamps = st.one_of(st.none(), st.sampled_from([dt.datetime(2024, 1, d) for d in (1, 2, 3)]))
values = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
rows = st.lists(st.tuples(keys, stamps, values), min_size=0, max_size=25)


def brute_force_latest(data):
    """Per key: the row ranking first by (ts desc, v desc), NULLs last."""
    def rank(r):
        _, ts, v = r
        return ((ts is not None, ts or dt.datetime.min), (v is not None, v or ""))
    best = {}
    for r in data:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    return Counter(best.values())


@SETTINGS
@given(rows)
def test_keep_latest_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz, v string")
    got = Counter(tuple(r) for r in keep_latest(df, ["id"], ["ts"]).collect())
    assert got == brute_force_latest(data)


account_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.integers(1, 3)),
                        min_size=0, max_size=6)
tx_rows = st.lists(st.tuples(st.integers(1, 12), st.one_of(st.none(), st.integers(1, 5)),
                             st.sampled_from(["AUCKLAND", "Sydney", None]),
                             st.sampled_from(["2", "50", "500", "5000"])),
                   min_size=0, max_size=15)


@SETTINGS
@given(account_rows, tx_rows)
def test_enrichment_rewrite_equals_literal_left_joins(spark, accounts, txs):
    t0 = dt.datetime(2024, 1, 1)
    acc = spark.createDataFrame(
        [(a, c, f"A{a}", "cheque", None, None, D("1"), None, "NZD", "active", dt.date(2020, 1, 1), None,
          t0 + dt.timedelta(hours=i)) for i, (a, c) in enumerate(accounts)], schemas.ACCOUNTS)
    cus = spark.createDataFrame(
        [(c, "F", "L", dt.date(1990, 1, 1), None, None, None, None, None, None, "retail", "verified", t0, t0)
         for c in (1, 2)], schemas.CUSTOMERS)
    tx = spark.createDataFrame(
        [(i, a, t0 + dt.timedelta(hours=i), None, D(amt), "debit", None, None, "groceries", city, None, None,
          False, D("10"), "SETTLED", t0) for i, a, city, amt in txs], schemas.TRANSACTIONS)
    sa, sc, stx = S.stg_accounts(acc, "2024-06-01"), S.stg_customers(cus, "2024-06-01"), S.stg_transactions(tx)
    cities = read_seed(spark)
    new = Counter(map(tuple, I.int_transactions_enriched(sa, sc, stx, cities).collect()))
    lit = Counter(map(tuple, plain_shapes.int_transactions_enriched_literal(sa, sc, stx, cities).collect()))
    assert new == lit
