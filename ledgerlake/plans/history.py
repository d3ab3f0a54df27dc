"""Customer history: the versions that the dimension discards, as type-2 rows, and lookups as of a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import keep_latest
from ..operators.history import as_of, previous
from ..sources.sinks import written
from .staging import customer_columns

#: What a version is judged by: a version that changes none of these is no new one.
TRACKED = ("full_name", "date_of_birth", "email", "phone", "address_street", "address_city", "address_region",
           "postcode", "customer_segment", "kyc_status", "is_kyc_verified")


def dim_customers_history(raw_customers: DataFrame, unit: str = "year") -> DataFrame:
    """One row per customer and state: customer_id, valid_from, valid_to, is_current and the tracked columns.

    Raw rows of a customer with equal modification times are one version, the
    one that staging would keep.  Versions that change nothing tracked extend
    the row before.  A row holds from ``valid_from`` (inclusive; NULL: from the
    beginning, a version without a time) to ``valid_to`` (exclusive; NULL in
    the current row), so a customer's rows leave no gaps and don't overlap.
    """
    instant = keep_latest(raw_customers, ["customer_id", "last_modified_date"], [])
    versions = customer_columns(instant).select(
        "customer_id", F.col("last_modified_date").alias("valid_from"), F.struct(*TRACKED).alias("state"))
    versions = previous(versions, "customer_id", "valid_from", "state", "before", unit)
    changes = versions.where(F.col("before").isNull() | ~F.col("state").eqNullSafe(F.col("before.state"))).drop("before")
    rows = previous(changes, "customer_id", "valid_from", "valid_from", "after", unit, backwards=True)
    return rows.select("customer_id", "valid_from", F.col("after.valid_from").alias("valid_to"),
                       F.col("after").isNull().alias("is_current"), "state.*")


def fct_customer_as_of(stg_transactions: DataFrame, stg_accounts: DataFrame, history: DataFrame,
                       unit: str = "month") -> DataFrame:
    """Every staged transaction with its customer as they were on the transaction's date.

    The customer's columns are NULL for an unknown account or customer, for a
    transaction without a date and for one before the customer's first version.
    """
    accounts = stg_accounts.select(F.col("account_id").alias("_account"), "customer_id")
    facts = stg_transactions.select("transaction_id", "account_id", "transaction_date").join(
        accounts, F.col("account_id") == F.col("_account"), "left").drop("_account")
    # Read twice by the lookup: staging and the join to the accounts run once.
    facts = written(facts, "dated-facts")
    values = ("valid_from", "full_name", "customer_segment", "kyc_status", "address_region")
    found = as_of(facts, history.select("customer_id", *values), "customer_id", "transaction_date", "valid_from",
                  values, "customer", unit)
    return found.select(
        "transaction_id", "account_id", "customer_id", "transaction_date", F.col("customer").isNotNull().alias("has_version"),
        F.col("customer.valid_from").alias("version_from"),
        *[F.col(f"customer.{c}").alias(f"{c}_then") for c in values[1:]])
