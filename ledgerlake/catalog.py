"""Registered queries: one per operator / model of the blueprint, keyed by name.

Each entry takes ``(spark, sf_dir)``, derives the banking raw tables from the
driver's tables under ``sf_dir`` and returns a lazily planned DataFrame over
the whole tables.  ``ledgerlake.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import os
import uuid
import weakref
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import shared_dir
from .functions import bands as B
from .functions import scalars as S
from .operators import aggregates as A
from .operators import expectations as E
from .operators import incremental as INC
from .operators import quality as Q
from .operators.dedup import distinct_rows, keep_latest
from .operators.joins import bounded_rows, broadcast_row_limit
from .operators.sketches import distinct_in, monthly_sketches
from .plans import intermediate as I
from .plans import marts as M
from .plans.history import dim_customers_history, fct_customer_as_of
from .plans.merge import dim_customers_incremental, fct_transactions_incremental, merge_fct_transactions
from .plans.pipeline import MART_PARTITIONS, Models
from .sources import sinks
from .sources import testviews as tv
from .sources.raw import REASON, conform_checked, read_seed

AS_OF = "2002-01-01"
RUN_TS = "2002-01-01 06:00:00"
DEDUP_ORDER = {"customers": ("customer_id", "last_modified_date"),
               "accounts": ("account_id", "last_modified_date"),
               "loan_applications": ("application_id", "last_modified_date"),
               "transactions": ("transaction_id", "transaction_date")}


class Inputs:
    """Raw tables and models for one data directory (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> tv.RawTables:
        return tv.RawTables(self.spark, self.sf_dir)

    @cached_property
    def cities(self) -> DataFrame:
        return read_seed(self.spark)

    @cached_property
    def m(self) -> Models:
        return Models(self.raw, self.cities, AS_OF)


REGISTRY: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- scans, sources, sinks

for _key, _table in (("scan_customers", "customers"), ("scan_accounts", "accounts"),
                     ("scan_transactions", "transactions"), ("scan_loans", "loan_applications")):
    REGISTRY[_key] = (lambda t: lambda x: x.raw[t])(_table)


@query("seed_cities")
def _seed_cities(x: Inputs) -> DataFrame:
    """The seed driving a count of staged transactions per listed city."""
    per_city = (x.m["stg_transactions"].groupBy("merchant_city")
                .agg(F.count(F.lit(1)).alias("transaction_count")))
    return (x.cities.join(per_city, x.cities["city_name"] == per_city["merchant_city"], "left")
            .select("city_name", "country", "region",
                    F.coalesce("transaction_count", F.lit(0)).alias("transaction_count")))


@query("write_mart_roundtrip")
def _write_mart_roundtrip(x: Inputs) -> DataFrame:
    fct = x.m.fct_of_raw(by_month=True)
    path = os.path.join(shared_dir(x.spark), "marts", f"fct_transactions-{uuid.uuid4().hex}")
    sinks.write_table(fct, path, partition_by=("transaction_year", "transaction_month"), placed=True)
    return sinks.read_back(x.spark, path, fct)


@query("table_row_counts")
def _table_row_counts(x: Inputs) -> DataFrame:
    return sinks.row_counts({**dict(x.raw.items()), "nz_cities": x.cities})


# ---------------------------------------------------------------- incremental

def _cut_watermarks(x: Inputs) -> DataFrame:
    return INC.initial_watermarks(x.spark, tv.INCREMENTAL_CUTS)


@query("watermark_table")
def _watermark_table(x: Inputs) -> DataFrame:
    return INC.full_load_watermarks(x.raw, "last_modified_date", RUN_TS)


@query("incremental_extract")
def _incremental_extract(x: Inputs) -> DataFrame:
    wm = _cut_watermarks(x)
    return INC.extract_since(x.raw["transactions"], "last_modified_date",
                             INC.watermark_of(wm, "transactions"))


@query("watermark_advance")
def _watermark_advance(x: Inputs) -> DataFrame:
    wm = _cut_watermarks(x)
    for table in tv.RAW_NAMES:
        batch = INC.extract_since(x.raw[table], "last_modified_date", INC.watermark_of(wm, table))
        wm = INC.advance_watermark(wm, batch, table, "last_modified_date", RUN_TS)
    return wm


def _split_latest(x: Inputs, table: str):
    """Latest rows up to the cut (the loaded table) and after it (the increment),
    plus whether the increment is proven small enough to broadcast its keys."""
    key, order = DEDUP_ORDER[table]
    raw, cut = x.raw[table], F.lit(tv.INCREMENTAL_CUTS[table]).cast("timestamp_ntz")
    increment = raw.where(F.col("last_modified_date") > cut)
    old = keep_latest(raw.where(F.col("last_modified_date") <= cut), [key], [order])
    new = keep_latest(increment, [key], [order])
    small = bounded_rows(increment.select(key), broadcast_row_limit(increment.select(key)))
    return old, new, key, small


@query("upsert_by_key")
def _upsert_by_key(x: Inputs) -> DataFrame:
    old, new, key, small = _split_latest(x, "customers")
    return INC.upsert(old, new, [key], broadcast_new_keys=small)


@query("insert_if_absent")
def _insert_if_absent(x: Inputs) -> DataFrame:
    old, new, key, small = _split_latest(x, "accounts")
    return INC.insert_if_absent(old, new, [key], broadcast_new_keys=small)


def _first_load(x: Inputs) -> Models:
    """The models of what had been modified up to the cuts; everything newer is the increment."""
    first = {}
    for t in tv.RAW_NAMES:
        cut = F.lit(tv.INCREMENTAL_CUTS[t]).cast("timestamp_ntz")
        first[t] = x.raw[t].where(~F.coalesce(F.col("last_modified_date") > cut, F.lit(False)))
    return Models(first, x.cities, AS_OF)


@query("fct_transactions_incremental")
def _fct_transactions_incremental(x: Inputs) -> DataFrame:
    """The fact loaded in two runs: what had been modified up to the cuts, then everything newer."""
    existing = sinks.written(_first_load(x).fct_of_raw(), "fct-first")
    return fct_transactions_incremental(existing, x.raw, x.cities, tv.INCREMENTAL_CUTS, AS_OF)


@query("fct_transactions_merged")
def _fct_transactions_merged(x: Inputs) -> DataFrame:
    """The fact table after a first load and a merge that rewrites the touched months."""
    table = f"fct_transactions_{uuid.uuid4().hex}"
    fct = _first_load(x).fct_of_raw(by_month=True)
    sinks.write_table(fct, table, MART_PARTITIONS["fct_transactions"], as_table=True, placed=True)
    merge_fct_transactions(x.spark, table, x.raw, x.cities, tv.INCREMENTAL_CUTS, AS_OF)
    return x.spark.table(table).select(*fct.columns)


@query("dim_customers_incremental")
def _dim_customers_incremental(x: Inputs) -> DataFrame:
    """The dimension loaded in two runs, as the fact."""
    existing = sinks.written(_first_load(x)["dim_customers"], "dim-first")
    return dim_customers_incremental(existing, x.raw, tv.INCREMENTAL_CUTS, AS_OF)


@query("dim_customers_history")
def _dim_customers_history(x: Inputs) -> DataFrame:
    """Every state that a customer has been in, with its validity."""
    return dim_customers_history(x.raw["customers"])


@query("fct_customer_as_of")
def _fct_customer_as_of(x: Inputs) -> DataFrame:
    """Every transaction with its customer as of its date."""
    return fct_customer_as_of(x.m["stg_transactions"], x.m["stg_accounts"], dim_customers_history(x.raw["customers"]))


# ---------------------------------------------------------------- projections and scalars

@query("scalar_upper")
def _scalar_upper(x):
    r = x.raw["accounts"]
    return r.select("account_id", S.upper_clean("account_type").alias("account_type"),
                    S.upper_clean("status").alias("account_status"),
                    S.upper_clean("currency").alias("currency"))


@query("scalar_initcap")
def _scalar_initcap(x):
    r = x.raw["transactions"]
    return r.select("transaction_id", S.title("merchant_name").alias("merchant_name"),
                    S.title("merchant_city").alias("merchant_city"))


@query("scalar_full_name")
def _scalar_full_name(x):
    return x.raw["customers"].select("customer_id", S.full_name("first_name", "last_name").alias("full_name"))


@query("scalar_coalesce")
def _scalar_coalesce(x):
    r = x.raw["loan_applications"]
    return r.select("application_id",
                    S.default("decline_reason", "NOT APPLICABLE").alias("decline_reason"),
                    S.default("approved_amount", 0).alias("approved_amount"),
                    S.default("interest_rate", 0).alias("interest_rate"),
                    S.default("term_months", 0).alias("term_months"),
                    S.default("credit_score", 0).alias("credit_score"),
                    S.default("debt_to_income", 0).alias("debt_to_income"))


@query("scalar_abs")
def _scalar_abs(x):
    return x.raw["transactions"].select("transaction_id", S.abs_value("amount").alias("abs_amount"))


@query("scalar_id_to_string")
def _scalar_id_to_string(x):
    return x.raw["transactions"].select(S.id_to_string("transaction_id").alias("transaction_id"),
                                        "account_id")


@query("scalar_date_parts")
def _scalar_date_parts(x):
    r = x.raw["transactions"]
    return r.select("transaction_id", S.year_of("transaction_date").alias("transaction_year"),
                    S.month_of("transaction_date").alias("transaction_month"),
                    S.hour_of("transaction_date").alias("transaction_hour"))


@query("account_age_days")
def _account_age_days(x):
    return x.raw["accounts"].select(
        "account_id", S.days_between(S.as_of_date(AS_OF), "open_date").alias("account_age_days"))


@query("customer_age_years")
def _customer_age_years(x):
    return x.raw["customers"].select("customer_id", S.age_years("date_of_birth", AS_OF).alias("age_years"))


@query("loan_decision_days")
def _loan_decision_days(x):
    return x.raw["loan_applications"].select(
        "application_id", S.days_between("decision_date", "application_date").alias("decision_time_days"))


@query("loan_approved_pct")
def _loan_approved_pct(x):
    return x.raw["loan_applications"].select(
        "application_id", S.pct_of("approved_amount", "applied_amount").alias("loan_amount_approved_pct"))


@query("credit_utilisation_pct")
def _credit_utilisation_pct(x):
    a = x.m["stg_accounts"]
    return a.select("account_id", S.utilisation_pct("balance", "credit_limit").alias("credit_utilisation_pct"))


@query("flags_ci")
def _flags_ci(x):
    r = x.raw["transactions"]
    return r.select("transaction_id", S.ci_flag("transaction_type", "DEBIT").alias("is_debit"),
                    S.ci_flag("transaction_type", "CREDIT").alias("is_credit"))


@query("flags_raw_status")
def _flags_raw_status(x):
    r = x.raw["loan_applications"]
    return r.select("application_id", S.upper_clean("status").alias("status"),
                    S.raw_flag("status", "APPROVED").alias("is_approved"),
                    S.raw_flag("status", "DECLINED").alias("is_declined"),
                    S.raw_flag("status", "PENDING").alias("is_pending"))


@query("flag_is_closed")
def _flag_is_closed(x):
    return x.raw["accounts"].select("account_id", S.not_null_flag("close_date").alias("is_closed"))


@query("filter_equals")
def _filter_equals(x):
    t = x.m["stg_transactions"]
    return t.where(F.col("merchant_category") == "GAMBLING").select("transaction_id", "account_id", "abs_amount")


@query("filter_not_null")
def _filter_not_null(x):
    return x.raw["customers"].where(F.col("email").isNotNull()).select("customer_id", "email")


@query("clean_template")
def _clean_template(x):
    """Soft-delete filter, trim and timestamp cast (closed accounts count as deleted)."""
    r = x.raw["accounts"]
    return (r.where(F.col("close_date").isNull())
             .select(F.col("account_id").alias("id"), S.clean_text("product_name").alias("name"),
                     S.to_timestamp_ntz("open_date").alias("created_at"),
                     S.to_timestamp_ntz("last_modified_date").alias("updated_at")))


# ---------------------------------------------------------------- bands and rules

@query("band_account_age")
def _band_account_age(x):
    a = x.m["stg_accounts"]
    return a.select("account_id", "account_age_days", B.account_age_band("account_age_days").alias("account_age_band"))


@query("band_balance")
def _band_balance(x):
    a = x.m["stg_accounts"]
    return a.select("account_id", "balance", B.balance_band("balance").alias("balance_band"))


@query("band_credit_health")
def _band_credit_health(x):
    a = x.m["stg_accounts"]
    return a.select("account_id", B.credit_health_flag("balance", "credit_limit").alias("credit_health_flag"))


@query("band_credit_score")
def _band_credit_score(x):
    r = x.raw["loan_applications"]
    return r.select("application_id", "credit_score", B.credit_score_band("credit_score").alias("credit_score_band"))


@query("band_dti")
def _band_dti(x):
    l = x.m["stg_loans"]
    return l.select("application_id", "debt_to_income",
                    B.debt_to_income_band("debt_to_income").alias("debt_to_income_band"))


@query("band_loan_size")
def _band_loan_size(x):
    l = x.m["stg_loans"]
    return l.select("application_id", "applied_amount", B.loan_size_band("applied_amount").alias("loan_size_band"))


@query("band_transaction_size")
def _band_transaction_size(x):
    t = x.m["stg_transactions"]
    return t.select("transaction_id", "abs_amount",
                    B.transaction_size_band("abs_amount").alias("transaction_size_band"))


@query("band_fraud_hour")
def _band_fraud_hour(x):
    r = x.raw["transactions"]
    h = S.hour_of("transaction_date")
    return r.select("transaction_id", h.alias("transaction_hour"), B.fraud_risk_band(h).alias("fraud_risk_band"))


@query("flag_high_risk_loan")
def _flag_high_risk_loan(x):
    l = x.m["stg_loans"]
    return l.select("application_id", B.is_high_risk_loan("credit_score", "debt_to_income").alias("is_high_risk"))


@query("flag_merchant_category")
def _flag_merchant_category(x):
    t = x.m["stg_transactions"]
    return t.select("transaction_id", B.is_category("merchant_category", "GAMBLING").alias("is_gambling"),
                    B.is_category("merchant_category", "CRYPTO").alias("is_crypto"))


@query("flag_fraud")
def _flag_fraud(x):
    t = x.m["stg_transactions"]
    return t.select("transaction_id", "fraud_score", B.is_fraud("fraud_score").alias("is_fraud"))


@query("flag_overseas")
def _flag_overseas(x):
    t = x.m["stg_transactions"]
    j = t.join(I.city_lookup(x.cities), F.col("merchant_city") == F.col("_city"), "left")
    return j.select("transaction_id", "merchant_city", B.is_overseas("_city").alias("is_overseas"))


@query("risk_transaction")
def _risk_transaction(x):
    return x.m["fct_transactions"].select("transaction_id", "is_fraud", "is_overseas", "is_gambling",
                                          "fraud_score", "transaction_risk_level")


# ---------------------------------------------------------------- distinct and dedup

@query("distinct_rows")
def _distinct_rows(x):
    return distinct_rows(x.raw["customers"])


for _key, _table in (("dedup_latest_customers", "customers"), ("dedup_latest_accounts", "accounts"),
                     ("dedup_latest_loans", "loan_applications"),
                     ("dedup_latest_transactions", "transactions")):
    REGISTRY[_key] = (lambda t: lambda x: keep_latest(x.raw[t], [DEDUP_ORDER[t][0]], [DEDUP_ORDER[t][1]]))(_table)


# ---------------------------------------------------------------- joins

@query("join_accounts_customers")
def _join_accounts_customers(x):
    return x.m["int_accounts_enriched"].select("account_id", "customer_id", "customer_name",
                                               "customer_segment", "kyc_status")


@query("join_loans_customers")
def _join_loans_customers(x):
    return x.m["int_loans_enriched"].select("application_id", "customer_id", "customer_name", "age_years")


@query("join_account_transactions")
def _join_account_transactions(x):
    return x.m["int_transactions_enriched"].select("transaction_id", "account_id", "customer_id",
                                                   "customer_name", "account_type")


@query("join_city_lookup")
def _join_city_lookup(x):
    t = x.m["stg_transactions"]
    seed = x.cities.select(F.col("city_name").alias("_city"), "country", "region")
    seed = F.broadcast(seed) if bounded_rows(x.cities, broadcast_row_limit(x.cities)) else seed
    j = t.join(seed, F.col("merchant_city") == F.col("_city"), "left")
    return j.select("transaction_id", "merchant_city", F.col("_city").alias("city_name"), "country", "region")


@query("join_fact_star")
def _join_fact_star(x):
    return x.m["fct_transactions"].select("transaction_id", "account_id", "customer_id", "customer_name",
                                          "account_number", "transaction_size_band", "is_overseas")


@query("join_customer_360")
def _join_customer_360(x):
    return x.m["dim_customers"].select("customer_id", "full_name", "total_accounts", "total_balance",
                                       "total_loan_applications", "has_declined_loan",
                                       "latest_credit_score_band")


# ---------------------------------------------------------------- aggregations

@query("agg_count_distinct")
def _agg_count_distinct(x):
    return x.m["int_transactions_enriched"].groupBy("customer_id").agg(
        A.count_distinct("transaction_id").alias("total_transactions"))


@query("agg_count_if")
def _agg_count_if(x):
    return x.m["int_accounts_enriched"].groupBy("customer_id").agg(
        A.count_if(F.col("is_active")).alias("active_accounts_count"),
        A.count_if(F.col("account_type") == "SAVINGS").alias("savings_accounts_count"))


@query("agg_sum")
def _agg_sum(x):
    return x.m["int_accounts_enriched"].groupBy("customer_id").agg(A.sum_of("balance").alias("total_balance"))


@query("agg_sum_if")
def _agg_sum_if(x):
    return x.m["int_transactions_enriched"].groupBy("customer_id").agg(
        A.sum_if(F.col("is_debit"), "abs_amount").alias("total_debits"),
        A.sum_if(F.col("is_credit"), "abs_amount").alias("total_credits"))


@query("agg_min_date")
def _agg_min_date(x):
    return x.m["int_accounts_enriched"].groupBy("customer_id").agg(
        A.min_of("open_date").alias("first_account_open_date"))


@query("agg_max_if")
def _agg_max_if(x):
    return x.m["int_accounts_enriched"].groupBy("customer_id").agg(
        A.max_if(F.col("account_type") == "CREDIT", "credit_utilisation_pct").alias("max_credit_utilisation_pct"))


@query("agg_any_flag")
def _agg_any_flag(x):
    return x.m["int_loans_enriched"].groupBy("customer_id").agg(
        A.any_flag(F.col("is_declined")).alias("has_declined_loan"),
        A.any_flag(F.col("is_high_risk")).alias("has_high_risk_loan"))


@query("agg_max_string")
def _agg_max_string(x):
    return x.m["int_loans_enriched"].groupBy("customer_id").agg(
        A.max_text("credit_score_band").alias("latest_credit_score_band"))


@query("agg_avg_round")
def _agg_avg_round(x):
    return x.m["int_loans_enriched"].groupBy("customer_id").agg(
        A.avg_round("debt_to_income", 2).alias("avg_debt_to_income"))


@query("account_summary")
def _account_summary(x):
    return M.account_summary(x.m["int_accounts_enriched"])


@query("loan_summary")
def _loan_summary(x):
    return M.loan_summary(x.m["int_loans_enriched"])


@query("transaction_summary")
def _transaction_summary(x):
    return M.transaction_summary(x.m["int_transactions_enriched"])


# ---------------------------------------------------------------- set operations

@query("union_all")
def _union_all(x):
    """Every staged key with its entity name, as one UNION ALL."""
    parts = [("customer", "stg_customers", "customer_id"), ("account", "stg_accounts", "account_id"),
             ("loan", "stg_loans", "application_id"), ("transaction", "stg_transactions", "transaction_id")]
    out = None
    for entity, model, key in parts:
        p = x.m[model].select(F.lit(entity).alias("entity"), F.col(key).cast("string").alias("entity_id"))
        out = p if out is None else out.unionByName(p)
    return out


# ---------------------------------------------------------------- data quality

DQ_UNIQUE = [("customers", "customer_id"), ("customers", "email"), ("accounts", "account_id"),
             ("accounts", "account_number"), ("transactions", "transaction_id"),
             ("loan_applications", "application_id")]
DQ_NOT_NULL = [("customers", ["first_name", "last_name", "date_of_birth"]),
               ("accounts", ["account_number", "open_date"]),
               ("transactions", ["transaction_date", "amount"])]
DQ_RELATIONSHIPS = [("accounts", "customer_id", "customers", "customer_id"),
                    ("transactions", "account_id", "accounts", "account_id"),
                    ("loan_applications", "customer_id", "customers", "customer_id")]
# The accepted value domains of the source data.
DQ_ACCEPTED = [
    ("stg_customers", "customer_segment", ["RETAIL", "SME", "CORPORATE", "PRIVATE_BANKING"]),
    ("stg_customers", "kyc_status", ["VERIFIED", "PENDING", "FLAGGED"]),
    ("stg_accounts", "account_type", ["CHEQUE", "SAVINGS", "CREDIT", "TERM_DEPOSIT"]),
    ("stg_accounts", "account_status", ["ACTIVE", "DORMANT", "CLOSED"]),
    ("stg_transactions", "channel", ["EFTPOS", "ONLINE", "ATM", "DIRECT_DEBIT", "DIRECT_CREDIT",
                                     "MOBILE_APP", "BRANCH", "INTERNET_BANKING"]),
    ("stg_transactions", "merchant_category", ["GROCERIES", "FUEL", "DINING", "UTILITIES", "TRANSPORT",
                                               "RETAIL", "HEALTHCARE", "GOVERNMENT", "ONLINE", "ATM"]),
    ("stg_transactions", "transaction_type", ["DEBIT", "CREDIT"]),
    ("stg_transactions", "status", ["SETTLED", "PENDING", "REVERSED"]),
    ("stg_loans", "loan_type", ["HOME_LOAN", "PERSONAL_LOAN", "AUTO_LOAN", "BUSINESS_LOAN"]),
    ("stg_loans", "status", ["APPROVED", "DECLINED", "SUBMITTED", "WITHDRAWN"]),
]


DQ_MODEL_UNIQUE = [("stg_customers", "customer_id"), ("stg_accounts", "account_id"), ("stg_loans", "application_id"),
                   ("stg_transactions", "transaction_id"), ("dim_customers", "customer_id"),
                   ("fct_transactions", "transaction_id"), ("nz_cities", "city_name")]


@query("dq_unique_models")
def _dq_unique_models(x):
    """Keys of the staged tables, the marts and the seed."""
    return Q.run_checks({**{t: x.m[t] for t, _ in DQ_MODEL_UNIQUE[:-1]}, "nz_cities": x.cities}, unique=DQ_MODEL_UNIQUE)


@query("dq_unique")
def _dq_unique(x):
    return Q.run_checks(x.raw, unique=DQ_UNIQUE)


@query("dq_not_null")
def _dq_not_null(x):
    return Q.run_checks(x.raw, not_null=DQ_NOT_NULL)


@query("dq_relationships")
def _dq_relationships(x):
    return Q.run_checks(x.raw, relationships=DQ_RELATIONSHIPS)


@query("dq_accepted_values")
def _dq_accepted_values(x):
    return Q.run_checks(x.m, accepted=DQ_ACCEPTED)


FCT_CHANNELS = next(v for t, c, v in DQ_ACCEPTED if (t, c) == ("stg_transactions", "channel"))


@query("fct_transactions_checked")
def _fct_transactions_checked(x):
    """The fact written with its checks in the write: rows by reason of rejection (good: none)."""
    fct = E.with_reference(x.m["fct_transactions"], "account_id", x.m["stg_accounts"], "account_id", "_known_account")
    target = os.path.join(shared_dir(x.spark), "marts", f"fct_checked-{uuid.uuid4().hex}")
    E.write_checked(fct, target, [
        E.not_null("transaction_date"), E.known("_known_account", "account_id"),
        E.accepted_values("channel", FCT_CHANNELS), E.between("fraud_score", 0, 50)], drop=["_known_account"])
    like = x.m["fct_transactions"]
    parts = E.good(x.spark, target, like).select(F.lit("good").alias("reason")).unionByName(
        E.rejects(x.spark, target, like).select(F.col(E.REASON).alias("reason")))
    return parts.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


@query("scan_transactions_checked")
def _scan_transactions_checked(x):
    """Raw transactions as text, some values spoilt, read onto the declared schema: rows and amounts by reason."""
    raw = x.raw["transactions"]
    spoilt = {"amount": (97, "n/a"), "transaction_date": (101, "soon"), "account_id": (89, "12x")}
    text = raw.select(*[F.when(F.col("transaction_id") % spoilt[c][0] == 0, F.lit(spoilt[c][1])).otherwise(F.col(c).cast("string")).alias(c)
                        if c in spoilt else F.col(c).cast("string").alias(c) for c in raw.columns])
    return conform_checked(text, "transactions").groupBy(F.coalesce(REASON, F.lit("good")).alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("amount"))


@query("agg_distinct_sketched")
def _agg_distinct_sketched(x):
    """Distinct merchants and cities per customer from monthly sketches: exact count, and whether the estimate is near."""
    names = ("merchant_name", "merchant_city")
    rows = x.m["fct_transactions"].select("customer_id", "transaction_date", *names)
    estimated = distinct_in(monthly_sketches(rows, ["customer_id"], "transaction_date", names), ["customer_id"], names)
    exact = rows.groupBy(F.col("customer_id").alias("_c")).agg(*[F.count_distinct(n).alias(f"{n}_exact") for n in names])
    near = [(F.abs(F.col(f"{n}_distinct") - F.col(f"{n}_exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col(f"{n}_exact")))
            .alias(f"{n}_near") for n in names]
    return estimated.join(exact, F.col("customer_id").eqNullSafe(F.col("_c"))).select(
        "customer_id", *[f"{n}_exact" for n in names], *near)


# ---------------------------------------------------------------- complete models

for _model in ("stg_customers", "stg_accounts", "stg_loans", "stg_transactions", "int_accounts_enriched",
               "int_loans_enriched", "int_transactions_enriched", "dim_customers", "fct_transactions"):
    REGISTRY[_model] = (lambda n: lambda x: x.m[n])(_model)


# Planned inputs per session and data directory.  DataFrames are immutable
# plans, so queries over the same tables reuse the analysed sources and models
# (a plan cache: no data is cached, every query still executes in full).
_PLANS: "weakref.WeakKeyDictionary[SparkSession, dict[str, Inputs]]" = weakref.WeakKeyDictionary()


def inputs_for(spark: SparkSession, sf_dir: str) -> Inputs:
    per_session = _PLANS.setdefault(spark, {})
    key = sf_dir.rstrip("/")
    if key not in per_session:
        per_session[key] = Inputs(spark, key)
    return per_session[key]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda f: lambda spark, sf_dir: f(inputs_for(spark, sf_dir)))(fn)
            for name, fn in REGISTRY.items()}
