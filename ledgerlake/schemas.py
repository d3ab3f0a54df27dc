"""Typed schemas of the raw banking tables and the city seed.

Identifiers are 64-bit: the source DDL uses 32-bit serials, but a table that
is meant to grow to billions of rows must not overflow its key.
"""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampNTZType)

MONEY = DecimalType(18, 2)
SMALL_DECIMAL = DecimalType(5, 2)


def _s(*fields):
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in fields])


CUSTOMERS = _s(
    ("customer_id", LongType(), True),
    ("first_name", StringType(), True),
    ("last_name", StringType(), True),
    ("date_of_birth", DateType(), True),
    ("email", StringType(), True),
    ("phone", StringType(), True),
    ("address_street", StringType(), True),
    ("address_city", StringType(), True),
    ("address_region", StringType(), True),
    ("postcode", StringType(), True),
    ("customer_segment", StringType(), True),
    ("kyc_status", StringType(), True),
    ("created_date", TimestampNTZType(), True),
    ("last_modified_date", TimestampNTZType(), True),
)

ACCOUNTS = _s(
    ("account_id", LongType(), True),
    ("customer_id", LongType(), True),
    ("account_number", StringType(), True),
    ("account_type", StringType(), True),
    ("product_name", StringType(), True),
    ("bsb_number", StringType(), True),
    ("balance", MONEY, True),
    ("credit_limit", MONEY, True),
    ("currency", StringType(), True),
    ("status", StringType(), True),
    ("open_date", DateType(), True),
    ("close_date", DateType(), True),
    ("last_modified_date", TimestampNTZType(), True),
)

TRANSACTIONS = _s(
    ("transaction_id", LongType(), True),
    ("account_id", LongType(), True),
    ("transaction_date", TimestampNTZType(), True),
    ("value_date", DateType(), True),
    ("amount", MONEY, True),
    ("transaction_type", StringType(), True),
    ("channel", StringType(), True),
    ("merchant_name", StringType(), True),
    ("merchant_category", StringType(), True),
    ("merchant_city", StringType(), True),
    ("reference", StringType(), True),
    ("balance_after", MONEY, True),
    ("is_fraud_flagged", BooleanType(), True),
    ("fraud_score", SMALL_DECIMAL, True),
    ("status", StringType(), True),
    ("last_modified_date", TimestampNTZType(), True),
)

LOAN_APPLICATIONS = _s(
    ("application_id", LongType(), True),
    ("customer_id", LongType(), True),
    ("loan_type", StringType(), True),
    ("applied_amount", MONEY, True),
    ("approved_amount", MONEY, True),
    ("interest_rate", SMALL_DECIMAL, True),
    ("term_months", IntegerType(), True),
    ("application_date", DateType(), True),
    ("decision_date", DateType(), True),
    ("status", StringType(), True),
    ("decline_reason", StringType(), True),
    ("credit_score", IntegerType(), True),
    ("debt_to_income", SMALL_DECIMAL, True),
    ("last_modified_date", TimestampNTZType(), True),
)

PIPELINE_WATERMARK = _s(
    ("table_name", StringType(), False),
    ("last_watermark", TimestampNTZType(), False),
    ("last_run_status", StringType(), True),
    ("rows_extracted", LongType(), True),
    ("last_run_date", TimestampNTZType(), True),
)

CITIES = _s(
    ("city_name", StringType(), True),
    ("country", StringType(), True),
    ("region", StringType(), True),
)

RAW_SCHEMAS = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "loan_applications": LOAN_APPLICATIONS,
    "pipeline_watermark": PIPELINE_WATERMARK,
}
