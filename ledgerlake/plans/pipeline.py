"""Build every model from the raw tables: the whole DAG as lazy DataFrames.

``plans.merge`` holds the incremental forms of the marts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import intermediate as I
from . import marts as M
from . import staging as S

MODEL_ORDER = ("stg_customers", "stg_accounts", "stg_loans", "stg_transactions",
               "int_accounts_enriched", "int_loans_enriched", "int_transactions_enriched",
               "dim_customers", "fct_transactions")


class Models(dict):
    """The model DAG, each model planned on first use from its parents.

    ``raw`` maps customers/accounts/transactions/loan_applications to DataFrames.
    """

    def __init__(self, raw: dict[str, DataFrame], cities: DataFrame, as_of=None):
        super().__init__()
        self.raw, self.cities, self.as_of = raw, cities, as_of

    def __missing__(self, name: str) -> DataFrame:
        r, m = self.raw, self
        build = {
            "stg_customers": lambda: S.stg_customers(r["customers"], self.as_of),
            "stg_accounts": lambda: S.stg_accounts(r["accounts"], self.as_of),
            "stg_loans": lambda: S.stg_loans(r["loan_applications"]),
            "stg_transactions": lambda: S.stg_transactions(r["transactions"]),
            "int_accounts_enriched": lambda: I.int_accounts_enriched(m["stg_accounts"], m["stg_customers"]),
            "int_loans_enriched": lambda: I.int_loans_enriched(m["stg_loans"], m["stg_customers"]),
            "int_transactions_enriched": lambda: I.int_transactions_enriched(
                m["stg_accounts"], m["stg_customers"], m["stg_transactions"], self.cities),
            "dim_customers": lambda: M.dim_customers(m["stg_customers"], m["stg_accounts"], m["stg_loans"]),
            "fct_transactions": lambda: M.fct_transactions(m["stg_transactions"], m["stg_accounts"],
                                                           m["stg_customers"], self.cities),
        }
        if name not in build:
            raise KeyError(name)
        df = build[name]()
        self[name] = df
        return df

    def fct_of_raw(self, by_month: bool = False) -> DataFrame:
        """``fct_transactions`` from the raw transactions, with less to shuffle (see ``M.fct_of_versions``).

        ``by_month`` rebalances the rows for a write by ``MART_PARTITIONS`` (``placed``).
        """
        return M.fct_of_versions(S.latest_transactions(self.raw["transactions"]), self["stg_accounts"],
                                 self["stg_customers"], self.cities, by_month)


def build_all(raw: dict[str, DataFrame], cities: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """Every model, planned lazily (nothing runs until a model is written or read)."""
    models = Models(raw, cities, as_of)
    return {name: models[name] for name in MODEL_ORDER}


STAGING = ("stg_customers", "stg_accounts", "stg_loans", "stg_transactions")
MARTS = ("dim_customers", "fct_transactions")
# Fixed value: the property that the source sets on its fact table.
MART_PROPERTIES = {"fct_transactions": {"delta.columnMapping.mode": "name"}}
#: The key by which a staged table meets the others: customers' tables by customer, transactions by account.
STAGING_BUCKETS = {"stg_customers": "customer_id", "stg_accounts": "customer_id", "stg_loans": "customer_id",
                   "stg_transactions": "account_id"}
MART_PARTITIONS = {"fct_transactions": ("transaction_year", "transaction_month")}


def require_unique_cities(cities: DataFrame) -> None:
    """Fails if the city seed names a city twice."""
    twice = cities.groupBy("city_name").count().where("count > 1").select("city_name").first()
    if twice:
        raise ValueError(f"the city seed names {twice[0]!r} more than once")


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], cities: DataFrame, out_dir: str,
                 as_of=None, materialize_staging: bool = True, schema: str | None = None,
                 buckets: int | None = None) -> dict[str, DataFrame]:
    """Build and write the marts (full overwrite), returning them read back.

    The staged and enriched models are registered as views.  With ``schema``
    the marts become tables of that catalog schema, with their properties;
    otherwise they are folders under ``out_dir``.

    ``out_dir`` must be storage every executor shares (e.g. the folder named
    by ``spark.checkpoint.dir``).  With ``materialize_staging`` the staged
    tables are written first and the marts are planned from those files:
    the dedup shuffles run once per run instead of once per mart, and a lost
    executor recomputes from the written staging rather than from raw.  With
    ``schema`` and ``buckets`` the staged tables are catalog tables bucketed by
    ``STAGING_BUCKETS`` (except on a hot key, see ``write_bucketed``): joins of
    accounts and loans to customers and the customer summaries then shuffle
    nothing, and the fact's join doesn't shuffle the transactions.
    """
    from ..sources.sinks import read_back, register_views, write_bucketed, write_table

    require_unique_cities(cities)
    staged = Models(raw, cities, as_of)
    if materialize_staging:
        for name in STAGING:
            if schema and buckets:
                table, like = f"{schema}.{name}_bucketed", staged[name]
                write_bucketed(like, table, STAGING_BUCKETS[name], buckets)
                staged[name] = spark.table(table).select(*like.columns)
                continue
            path = os.path.join(out_dir, "staging", name)
            write_table(staged[name], path)
            staged[name] = read_back(spark, path, staged[name])
    register_views({name: staged[name] for name in MODEL_ORDER if name not in MARTS})
    out = {}
    for name in MARTS:
        partitions, properties = MART_PARTITIONS.get(name, ()), MART_PROPERTIES.get(name)
        if schema:
            write_table(staged[name], f"{schema}.{name}", partitions, properties, as_table=True)
            out[name] = spark.table(f"{schema}.{name}").select(*staged[name].columns)
        else:
            path = os.path.join(out_dir, "mart", name)
            write_table(staged[name], path, partitions)
            out[name] = read_back(spark, path, staged[name])
    return out
