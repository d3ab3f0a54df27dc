"""Intermediate models: accounts, loans and transactions enriched with the
customer and with risk attributes.

The reference wraps the unique staging relations in ``SELECT DISTINCT *``
again; staging is unique by key (one row per key survives the dedup), so
that pass is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import scalars as S
from ..operators.joins import bounded_rows, broadcast_row_limit

CUSTOMER_ATTRS = ("customer_name", "customer_segment", "kyc_status")


def _customer_side(stg_customers: DataFrame, extra=()) -> DataFrame:
    return stg_customers.select("customer_id", F.col("full_name").alias("customer_name"),
                                "customer_segment", "kyc_status", *extra)


def int_accounts_enriched(stg_accounts: DataFrame, stg_customers: DataFrame) -> DataFrame:
    a = stg_accounts.alias("a")
    c = _customer_side(stg_customers).alias("c")
    joined = a.join(c, F.col("a.customer_id") == F.col("c.customer_id"), "left")
    bal, lim = F.col("a.balance"), F.col("a.credit_limit")
    return joined.select(
        F.col("a.account_id").alias("account_id"),
        F.col("a.customer_id").alias("customer_id"),
        F.col("c.customer_name").alias("customer_name"),
        F.col("c.customer_segment").alias("customer_segment"),
        F.col("c.kyc_status").alias("kyc_status"),
        *[F.col(f"a.{n}").alias(n) for n in (
            "account_number", "account_type", "product_name", "account_status", "balance",
            "credit_limit", "currency", "is_active", "is_closed", "is_credit_account",
            "open_date", "close_date", "account_age_days")],
        S.utilisation_pct(bal, lim).alias("credit_utilisation_pct"),
        B.credit_health_flag(bal, lim).alias("credit_health_flag"),
        B.account_age_band("a.account_age_days").alias("account_age_band"),
        B.balance_band(bal).alias("balance_band"),
    )


def int_loans_enriched(stg_loans: DataFrame, stg_customers: DataFrame) -> DataFrame:
    l = stg_loans.alias("l")
    c = _customer_side(stg_customers, ["age_years"]).alias("c")
    joined = l.join(c, F.col("l.customer_id") == F.col("c.customer_id"), "left")
    return joined.select(
        F.col("l.customer_id").alias("customer_id"),
        F.col("c.customer_name").alias("customer_name"),
        F.col("c.customer_segment").alias("customer_segment"),
        F.col("c.kyc_status").alias("kyc_status"),
        F.col("c.age_years").alias("age_years"),
        *[F.col(f"l.{n}").alias(n) for n in (
            "application_id", "is_approved", "is_declined", "is_pending", "credit_score_band",
            "approved_amount", "debt_to_income")],
        B.debt_to_income_band("l.debt_to_income").alias("debt_to_income_band"),
        B.loan_size_band("l.applied_amount").alias("loan_size_band"),
        B.is_high_risk_loan("l.credit_score", "l.debt_to_income").alias("is_high_risk"),
    )


def accounts_with_customer(stg_accounts: DataFrame, stg_customers: DataFrame,
                           account_cols=("customer_id", "account_type")) -> DataFrame:
    """Account-level frame (accounts LEFT JOIN customers) used by the transaction models."""
    a = stg_accounts.select("account_id", *account_cols).alias("a")
    c = _customer_side(stg_customers).alias("c")
    return (a.join(c, F.col("a.customer_id") == F.col("c.customer_id"), "left")
             .select(*[F.col(f"a.{n}").alias(n) for n in ("account_id",) + tuple(account_cols)],
                     *[F.col(f"c.{n}").alias(n) for n in CUSTOMER_ATTRS]))


def city_lookup(cities: DataFrame) -> DataFrame:
    """The city seed keyed by name, broadcast when its size is proven small.

    A name listed twice counts once, so the lookup never multiplies rows.
    """
    keys = cities.select(F.col("city_name").alias("_city")).distinct()
    return F.broadcast(keys) if bounded_rows(cities, broadcast_row_limit(cities)) else keys


def transaction_flags(abs_amount, merchant_category, fraud_score, matched_city) -> list:
    """The enrichment columns computed from one transaction and its city lookup."""
    return [
        B.transaction_size_band(abs_amount).alias("transaction_size_band"),
        B.is_category(merchant_category, "GAMBLING").alias("is_gambling"),
        B.is_category(merchant_category, "CRYPTO").alias("is_crypto"),
        B.is_fraud(fraud_score).alias("is_fraud"),
        B.is_overseas(matched_city).alias("is_overseas"),
    ]


TX_COLS = ("transaction_id", "account_id", "abs_amount", "is_debit", "is_credit")
ACCOUNT_OUT = ("customer_id", "customer_name", "customer_segment", "account_type")


def int_transactions_enriched(stg_accounts: DataFrame, stg_customers: DataFrame,
                              stg_transactions: DataFrame, cities: DataFrame) -> DataFrame:
    """accounts LEFT JOIN customers LEFT JOIN transactions LEFT JOIN cities.

    Accounts drive the join: an account without transactions yields one row
    with NULL transaction fields (size band LARGE, overseas true); a
    transaction whose account is unknown is dropped.

    Executed as (transactions INNER JOIN accounts) UNION ALL (accounts with no
    transaction).  A left join that preserves accounts cannot have its
    transaction side split when one account holds a huge share of the
    transactions; an inner join can (AQE skew join), and the "no transaction"
    side needs only the distinct account ids, which are aggregated map-side
    before they are shuffled.
    """
    ac = accounts_with_customer(stg_accounts, stg_customers)
    t = stg_transactions.select(*TX_COLS, "merchant_category", "fraud_score", "merchant_city")
    cities_b = city_lookup(cities)

    # Null-safe equality: plain equality would push "account id is not null" below the
    # accounts' dedup in this branch only, and the accounts would be planned twice.
    known = t.where(F.col("account_id").isNotNull())
    matched = (known.join(ac.withColumnRenamed("account_id", "_ac_id"), F.col("account_id").eqNullSafe(F.col("_ac_id")))
                .join(cities_b, F.col("merchant_city") == F.col("_city"), "left"))
    matched = matched.select(
        *TX_COLS, *ACCOUNT_OUT,
        *transaction_flags(F.col("abs_amount"), F.col("merchant_category"),
                           F.col("fraud_score"), F.col("_city")))

    used_accounts = known.select(F.col("account_id").alias("_used_id")).distinct()
    phantoms = ac.join(used_accounts, F.col("account_id").eqNullSafe(F.col("_used_id")), "left_anti")
    null = F.lit(None)
    phantoms = phantoms.select(
        null.cast("string").alias("transaction_id"),
        null.cast(stg_transactions.schema["account_id"].dataType).alias("account_id"),
        null.cast(stg_transactions.schema["abs_amount"].dataType).alias("abs_amount"),
        null.cast("boolean").alias("is_debit"),
        null.cast("boolean").alias("is_credit"),
        *ACCOUNT_OUT,
        *transaction_flags(null.cast(stg_transactions.schema["abs_amount"].dataType),
                           null.cast("string"), null.cast("decimal(5,2)"), null.cast("string")))
    return matched.unionByName(phantoms)
