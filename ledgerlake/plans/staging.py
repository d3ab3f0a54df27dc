"""Staging models: keep the latest version of each record, standardise, flag.

Every expression in a model's ``select`` reads the *raw* input columns, as in
one SQL SELECT list: e.g. ``stg_loans.is_approved`` compares the raw status
case-sensitively even though the projected ``status`` is upper-cased, and the
credit-score band reads the raw score (NULL -> POOR) while the projected score
is coalesced to 0.

The reference runs ``SELECT DISTINCT *`` before the dedup window; with a
total order in ``keep_latest`` exact copies collapse to one survivor anyway,
so that extra all-column shuffle is dropped (tests prove equality).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import scalars as S
from ..operators.dedup import keep_latest


def stg_customers(raw: DataFrame, as_of=None) -> DataFrame:
    return customer_columns(keep_latest(raw, ["customer_id"], ["last_modified_date"]), as_of)


def customer_columns(versions: DataFrame, as_of=None) -> DataFrame:
    """The staged columns of customer versions, row by row."""
    return versions.select(
        "customer_id",
        "first_name",
        "last_name",
        S.full_name("first_name", "last_name").alias("full_name"),
        "date_of_birth",
        "email",
        "phone",
        "address_street",
        "address_city",
        "address_region",
        "postcode",
        S.upper_clean("customer_segment").alias("customer_segment"),
        S.upper_clean("kyc_status").alias("kyc_status"),
        "created_date",
        "last_modified_date",
        S.age_years("date_of_birth", as_of).alias("age_years"),
        S.ci_flag("kyc_status", "VERIFIED").alias("is_kyc_verified"),
    )


def stg_accounts(raw: DataFrame, as_of=None) -> DataFrame:
    latest = keep_latest(raw, ["account_id"], ["last_modified_date"])
    return latest.select(
        "account_id",
        "customer_id",
        "account_number",
        S.upper_clean("account_type").alias("account_type"),
        S.upper_clean("status").alias("account_status"),
        S.upper_clean("currency").alias("currency"),
        S.title("product_name").alias("product_name"),
        S.default("balance", 0).alias("balance"),
        S.default("credit_limit", 0).alias("credit_limit"),
        "open_date",
        "close_date",
        "last_modified_date",
        S.ci_flag("status", "ACTIVE").alias("is_active"),
        S.not_null_flag("close_date").alias("is_closed"),
        S.ci_flag("account_type", "CREDIT").alias("is_credit_account"),
        S.days_between(S.as_of_date(as_of), "open_date").alias("account_age_days"),
    )


def stg_loans(raw: DataFrame) -> DataFrame:
    latest = keep_latest(raw, ["application_id"], ["last_modified_date"])
    return latest.select(
        "customer_id",
        "application_id",
        "applied_amount",
        S.upper_clean("loan_type").alias("loan_type"),
        S.upper_clean("status").alias("status"),
        S.default("decline_reason", "NOT APPLICABLE").alias("decline_reason"),
        S.default("approved_amount", 0).alias("approved_amount"),
        S.default("interest_rate", 0).alias("interest_rate"),
        S.default("term_months", 0).alias("term_months"),
        S.default("credit_score", 0).alias("credit_score"),
        S.default("debt_to_income", 0).alias("debt_to_income"),
        "decision_date",
        S.raw_flag("status", "APPROVED").alias("is_approved"),
        S.raw_flag("status", "DECLINED").alias("is_declined"),
        S.raw_flag("status", "PENDING").alias("is_pending"),
        S.pct_of("approved_amount", "applied_amount").alias("loan_amount_approved_pct"),
        S.days_between("decision_date", "application_date").alias("decision_time_days"),
        B.credit_score_band("credit_score").alias("credit_score_band"),
    )


def latest_transactions(raw: DataFrame) -> DataFrame:
    """The version of each transaction that staging keeps, in its raw columns."""
    return keep_latest(raw, ["transaction_id"], ["transaction_date"])


def stg_transactions(raw: DataFrame) -> DataFrame:
    return transaction_columns(latest_transactions(raw))


def transaction_columns(versions: DataFrame, carried=()) -> DataFrame:
    """The staged columns of transaction versions, row by row, and the ``carried`` columns as they are."""
    hour = S.hour_of("transaction_date")
    return versions.select(
        S.id_to_string("transaction_id").alias("transaction_id"),
        F.col("account_id").alias("account_id"),
        S.upper_clean("channel").alias("channel"),
        S.upper_clean("merchant_category").alias("merchant_category"),
        S.upper_clean("status").alias("status"),
        S.title("merchant_name").alias("merchant_name"),
        S.title("merchant_city").alias("merchant_city"),
        S.default("reference", "NOT APPLICABLE").alias("reference"),
        S.default("balance_after", 0).alias("balance_after"),
        S.default("fraud_score", 0).alias("fraud_score"),
        F.col("is_fraud_flagged").alias("is_fraud"),
        S.abs_value("amount").alias("abs_amount"),
        F.col("transaction_date").alias("transaction_date"),
        S.upper_clean("transaction_type").alias("transaction_type"),
        S.ci_flag("transaction_type", "DEBIT").alias("is_debit"),
        S.ci_flag("transaction_type", "CREDIT").alias("is_credit"),
        S.raw_flag("status", "DECLINED").alias("is_declined"),
        S.raw_flag("status", "SETTLED").alias("is_settled"),
        S.year_of("transaction_date").alias("transaction_year"),
        S.month_of("transaction_date").alias("transaction_month"),
        hour.alias("transaction_hour"),
        B.fraud_risk_band(hour).alias("fraud_risk_band"),
        *carried,
    )
