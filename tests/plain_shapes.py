"""The transaction models in their plain join shape, to compare the rewritten plans with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import bands as B
from ledgerlake.plans.intermediate import ACCOUNT_OUT, TX_COLS, accounts_with_customer, int_transactions_enriched, transaction_flags
from ledgerlake.plans.marts import FACT_ACCOUNT_COLS, FACT_TX_COLS


def int_transactions_enriched_literal(stg_accounts: DataFrame, stg_customers: DataFrame,
                                      stg_transactions: DataFrame, cities: DataFrame) -> DataFrame:
    """The same model as three chained left joins (reference shape; for tests)."""
    ac = accounts_with_customer(stg_accounts, stg_customers)
    t = stg_transactions.select(*TX_COLS, "merchant_category", "fraud_score", "merchant_city")
    j = ac.alias("a").join(t.alias("t"), F.col("a.account_id") == F.col("t.account_id"), "left")
    j = j.join(F.broadcast(cities.select(F.col("city_name").alias("_city"))), F.col("merchant_city") == F.col("_city"), "left")
    return j.select(
        *[F.col(f"t.{n}").alias(n) for n in TX_COLS],
        *[F.col(f"a.{n}").alias(n) for n in ACCOUNT_OUT],
        *transaction_flags(F.col("t.abs_amount"), F.col("t.merchant_category"),
                           F.col("t.fraud_score"), F.col("_city")))


def fct_transactions_literal(stg_transactions: DataFrame, stg_accounts: DataFrame,
                             stg_customers: DataFrame, cities: DataFrame) -> DataFrame:
    """Reference shape: re-join the enriched transactions by id (for tests)."""
    ac = accounts_with_customer(stg_accounts, stg_customers, FACT_ACCOUNT_COLS).alias("ac")
    te = int_transactions_enriched(stg_accounts, stg_customers, stg_transactions, cities).select(
        F.col("transaction_id").alias("te_id"), "transaction_size_band", "is_fraud", "is_gambling",
        "is_crypto", "is_overseas").alias("te")
    t = stg_transactions.alias("t")
    j = (t.join(ac, F.col("t.account_id") == F.col("ac.account_id"), "left")
          .join(te, F.col("t.transaction_id") == F.col("te.te_id"), "left"))
    return j.select(
        F.col("t.transaction_id").alias("transaction_id"),
        F.col("t.account_id").alias("account_id"),
        *[F.col(f"ac.{n}").alias(n) for n in ("customer_id", "customer_name", "customer_segment",
                                                "kyc_status", "account_type", "account_number",
                                                "product_name")],
        *[F.col(f"te.{n}").alias(n) for n in ("transaction_size_band", "is_fraud", "is_gambling",
                                                "is_crypto", "is_overseas")],
        *[F.col(f"t.{n}").alias(n) for n in FACT_TX_COLS],
        B.transaction_risk_level("te.is_fraud", "te.is_overseas", "te.is_gambling", "t.fraud_score")
         .alias("transaction_risk_level"),
        B.transaction_size_band("t.abs_amount").alias("amount_band"),
        F.col("ac.last_modified_date").alias("last_modified_date"),
    )
