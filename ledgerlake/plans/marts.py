"""Mart models: the customer dimension and the transaction fact.

Both are built from the staging frames so Catalyst plans each mart as one
job: filters and column pruning reach the scans, the dedup windows and the
aggregations share exchanges where their keys line up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators.texts import PACKED, text_columns, with_texts_packed, with_texts_unpacked
from .intermediate import CUSTOMER_ATTRS, accounts_with_customer, city_lookup
from .staging import transaction_columns

# Staging is unique by its key, so ``count(distinct key)`` per customer equals
# ``count(key)`` (NULL keys are ignored by both).  The plain count avoids the
# extra (customer, key) shuffle a distinct aggregate needs; tests compare it
# with the literal distinct form.


def account_summary(int_accounts: DataFrame) -> DataFrame:
    credit = F.col("account_type") == "CREDIT"
    mortgage = F.col("account_type") == "MORTGAGE"
    return int_accounts.groupBy("customer_id").agg(
        F.count("account_id").alias("total_accounts"),
        A.count_if(F.col("is_active")).alias("active_accounts_count"),
        A.count_if(F.col("account_type") == "SAVINGS").alias("savings_accounts_count"),
        A.count_if(credit).alias("credit_accounts_count"),
        A.count_if(mortgage).alias("loan_accounts_count"),
        A.sum_of("balance").alias("total_balance"),
        A.min_of("open_date").alias("first_account_open_date"),
        A.max_if(credit, "credit_utilisation_pct").alias("max_credit_utilisation_pct"),
        A.any_flag(F.col("is_active")).alias("has_active_account"),
        A.any_flag(mortgage).alias("has_mortgage"),
        A.any_flag(credit).alias("has_credit_account"),
    )


def loan_summary(int_loans: DataFrame) -> DataFrame:
    return int_loans.groupBy("customer_id").agg(
        F.count("application_id").alias("total_loan_applications"),
        A.count_if(F.col("is_approved")).alias("total_approved_loans"),
        A.count_if(F.col("is_declined")).alias("total_declined_loans"),
        A.count_if(F.col("is_pending")).alias("total_pending_loans"),
        A.sum_of("approved_amount").alias("total_approved_amount"),
        A.any_flag(F.col("is_high_risk")).alias("has_high_risk_loan"),
        A.any_flag(F.col("is_approved")).alias("has_approved_loan"),
        A.any_flag(F.col("is_declined")).alias("has_declined_loan"),
        A.any_flag(F.col("is_pending")).alias("has_pending_loan"),
        # Text maximum (POOR > GOOD > FAIR > EXCELLENT), not the latest band.
        A.max_text("credit_score_band").alias("latest_credit_score_band"),
        A.avg_round("debt_to_income", 2).alias("avg_debt_to_income"),
    )


def transaction_summary(int_transactions: DataFrame) -> DataFrame:
    """Per-customer transaction measures.  Accounts without transactions
    contribute their NULL rows (counted as overseas)."""
    return int_transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        A.sum_if(F.col("is_debit"), "abs_amount").alias("total_debits"),
        A.sum_if(F.col("is_credit"), "abs_amount").alias("total_credits"),
        A.count_if(F.col("is_fraud")).alias("fraud_count"),
        A.count_if(F.col("is_gambling")).alias("gambling_count"),
        A.count_if(F.col("is_crypto")).alias("crypto_count"),
        A.count_if(F.col("is_overseas")).alias("overseas_count"),
        A.any_flag(F.col("is_fraud")).alias("has_fraudulent_transaction"),
        A.any_flag(F.col("is_gambling")).alias("has_gambling_transaction"),
        A.avg_round("abs_amount", 2).alias("avg_transaction_value"),
    )


CUSTOMER_COLS = ("customer_id", "full_name", "date_of_birth", "email", "phone", "address_street",
                 "address_city", "address_region", "postcode", "customer_segment", "kyc_status",
                 "age_years", "is_kyc_verified")


def account_measures(stg_accounts: DataFrame) -> DataFrame:
    """The enriched-account columns the account summary reads (all account-level)."""
    return stg_accounts.select(
        "customer_id", "account_id", "is_active", "account_type", "balance", "open_date",
        S.utilisation_pct("balance", "credit_limit").alias("credit_utilisation_pct"))


def loan_measures(stg_loans: DataFrame) -> DataFrame:
    """The enriched-loan columns the loan summary reads (all loan-level)."""
    return stg_loans.select(
        "customer_id", "application_id", "is_approved", "is_declined", "is_pending",
        "approved_amount", "credit_score_band", "debt_to_income",
        B.is_high_risk_loan("credit_score", "debt_to_income").alias("is_high_risk"))


def dim_customers(stg_customers: DataFrame, stg_accounts: DataFrame, stg_loans: DataFrame) -> DataFrame:
    """One row per staged customer with account and loan summaries.

    The reference summarises the enriched accounts and loans, i.e. after a
    left join to customers.  That join is 1:1 (customers are unique) and the
    summaries read only account / loan columns, so they are aggregated from
    the staged rows directly: the partial aggregation then runs before any
    shuffle, and a customer holding a huge share of the accounts costs one
    row per input partition instead of one oversized join task.

    The reference also joins a transaction summary that it never projects;
    that join cannot change the rows (1:1 on the key) and is left out, which
    is what Catalyst does with it anyway.
    """
    c = stg_customers.select(*CUSTOMER_COLS).alias("c")
    a = account_summary(account_measures(stg_accounts)).alias("a")
    l = loan_summary(loan_measures(stg_loans)).alias("l")
    j = (c.join(a, F.col("c.customer_id") == F.col("a.customer_id"), "left")
          .join(l, F.col("c.customer_id") == F.col("l.customer_id"), "left"))

    def d(name, value, alias=None):
        return F.coalesce(F.col(name), F.lit(value)).alias(alias or name.split(".")[1])

    return j.select(
        *[F.col(f"c.{n}").alias(n) for n in CUSTOMER_COLS],
        d("a.total_accounts", 0),
        d("a.active_accounts_count", 0, "active_account_count"),
        d("a.savings_accounts_count", 0, "savings_account_count"),
        d("a.credit_accounts_count", 0, "credit_account_count"),
        d("a.loan_accounts_count", 0, "mortgage_account_count"),
        d("a.total_balance", 0),
        d("a.max_credit_utilisation_pct", 0),
        F.col("a.first_account_open_date").alias("first_account_open_date"),
        d("a.has_active_account", False),
        d("a.has_mortgage", False),
        d("a.has_credit_account", False),
        d("l.total_loan_applications", 0),
        d("l.total_approved_loans", 0),
        d("l.total_declined_loans", 0),
        d("l.total_approved_amount", 0),
        d("l.has_declined_loan", False),
        d("l.avg_debt_to_income", 0),
        F.col("l.latest_credit_score_band").alias("latest_credit_score_band"),
    )


FACT_ACCOUNT_COLS = ("customer_id", "account_type", "account_number", "product_name", "last_modified_date")
FACT_TX_COLS = ("transaction_date", "transaction_month", "transaction_year", "transaction_hour",
                "abs_amount", "channel", "transaction_type", "merchant_category", "merchant_name",
                "merchant_city", "status", "reference", "balance_after", "fraud_score",
                "is_declined", "is_settled", "fraud_risk_band", "is_debit", "is_credit")


def fct_transactions(stg_transactions: DataFrame, stg_accounts: DataFrame,
                     stg_customers: DataFrame, cities: DataFrame) -> DataFrame:
    """One row per staged transaction, transaction-driven.

    The reference re-joins the enriched transactions on ``transaction_id``.
    That row is the same transaction's own enrichment whenever its account
    is known and its id is not NULL (ids, account ids and city names are
    unique after staging), so the enrichment is computed in place: no second
    scan or shuffle of the transactions.  Transactions with an unknown account
    keep NULL enrichment and are judged on the raw fraud score alone.
    """
    t, ac = stg_transactions.alias("t"), _fact_accounts(stg_accounts, stg_customers).alias("ac")
    return _fact_columns(t.join(ac, F.col("t.account_id") == F.col("ac.account_id"), "left"), cities)


def _fact_accounts(stg_accounts: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """What a fact row takes from its account by account_id, under names that no transaction column has."""
    ac = accounts_with_customer(stg_accounts, stg_customers, FACT_ACCOUNT_COLS)
    return ac.select("account_id", F.lit(True).alias("_account_hit"),
                     *[F.col(c).alias(f"_{c}") for c in (*FACT_ACCOUNT_COLS, *CUSTOMER_ATTRS)])


#: The raw transaction columns that the fact's columns follow from.
FACT_RAW_COLS = ("transaction_id", "account_id", "transaction_date", "amount", "transaction_type", "channel",
                 "merchant_name", "merchant_category", "merchant_city", "reference", "balance_after",
                 "is_fraud_flagged", "fraud_score", "status")


def fct_of_versions(latest: DataFrame, stg_accounts: DataFrame, stg_customers: DataFrame, cities: DataFrame,
                    by_month: bool = False) -> DataFrame:
    """The fact of the raw versions that staging keeps: the rows of ``fct_transactions``.

    They meet their accounts, and with ``by_month`` are rebalanced by year and
    month for a partitioned write, in the raw columns that the fact needs,
    their texts as one column; what staging and the fact derive from these is
    computed after the last shuffle.
    """
    tx = latest.select(*FACT_RAW_COLS)
    ac = _fact_accounts(stg_accounts, stg_customers)
    carried = [c for c in ac.columns if c != "account_id"]
    of_tx, of_account = text_columns(tx), text_columns(ac)
    t, a = with_texts_packed(tx, of_tx).alias("t"), with_texts_packed(ac, of_account, "_account_texts").alias("ac")
    rows = t.join(a, F.col("t.account_id") == F.col("ac.account_id"), "left").select(
        *[F.col(f"t.{c}") for c in (*(c for c in FACT_RAW_COLS if c not in of_tx), PACKED)],
        *[c for c in carried if c not in of_account], "_account_texts")
    if by_month:
        month = [S.year_of("transaction_date").alias("_year"), S.month_of("transaction_date").alias("_month")]
        rows = rows.select("*", *month).hint("rebalance", "_year", "_month")
    rows = with_texts_unpacked(with_texts_unpacked(rows, of_tx, like=tx), of_account, "_account_texts")
    return _fact_columns(transaction_columns(rows, carried).alias("t"), cities)


def _fact_columns(joined: DataFrame, cities: DataFrame) -> DataFrame:
    """The fact's columns from staged transactions (aliased t) joined to ``_fact_accounts``."""
    j = joined.join(city_lookup(cities), F.col("t.merchant_city") == F.col("_city"), "left")
    has_te = F.col("_account_hit") & F.col("t.transaction_id").isNotNull()

    def te(expr, name):
        return F.when(has_te, expr).alias(name)

    size_band = B.transaction_size_band("t.abs_amount")
    te_fraud = B.is_fraud("t.fraud_score")
    te_gambling = B.is_category("t.merchant_category", "GAMBLING")
    te_overseas = B.is_overseas("_city")
    risk_in = [F.when(has_te, x) for x in (te_fraud, te_overseas, te_gambling)]
    return j.select(
        F.col("t.transaction_id").alias("transaction_id"),
        F.col("t.account_id").alias("account_id"),
        F.col("_customer_id").alias("customer_id"),
        F.col("_customer_name").alias("customer_name"),
        F.col("_customer_segment").alias("customer_segment"),
        F.col("_kyc_status").alias("kyc_status"),
        F.col("_account_type").alias("account_type"),
        F.col("_account_number").alias("account_number"),
        F.col("_product_name").alias("product_name"),
        te(size_band, "transaction_size_band"),
        te(te_fraud, "is_fraud"),
        te(te_gambling, "is_gambling"),
        te(B.is_category("t.merchant_category", "CRYPTO"), "is_crypto"),
        te(te_overseas, "is_overseas"),
        *[F.col(f"t.{n}").alias(n) for n in FACT_TX_COLS],
        B.transaction_risk_level(risk_in[0], risk_in[1], risk_in[2], "t.fraud_score")
         .alias("transaction_risk_level"),
        size_band.alias("amount_band"),
        F.col("_last_modified_date").alias("last_modified_date"),
    )
