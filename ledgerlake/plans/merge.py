"""Incremental forms of the marts: only what an increment touches is computed and rewritten.

* ``fct_transactions_incremental``  the whole new fact, as a DataFrame
* ``merge_fct_transactions``        the fact table, rewriting the months that hold touched ids
* ``dim_customers_incremental``     the whole new dimension, recomputing the affected customers
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import age_years, id_to_string
from ..operators.incremental import extract_since
from ..operators.joins import bounded_rows, broadcast_row_limit
from ..operators.texts import text_columns, with_texts_packed, with_texts_unpacked
from ..sources.sinks import rebalanced, written
from . import marts as M
from . import staging as S
from .pipeline import MART_PARTITIONS


def _counted(keys: DataFrame, name: str) -> DataFrame:
    """Distinct keys, written once and broadcast where a count proves them small."""
    keys = written(keys.distinct(), name)
    return F.broadcast(keys) if bounded_rows(keys, broadcast_row_limit(keys)) else keys


def fct_increment(existing_fct: DataFrame, raw: dict[str, DataFrame], cities: DataFrame, since,
                  as_of=None) -> tuple[DataFrame, DataFrame]:
    """(touched ids, their rows after the increment).

    ``since`` maps customers, accounts and transactions to their bookmarks
    (modification times).  ``existing_fct`` must be the fact of the raw rows
    up to them.  Touched are the transactions that

    * have a raw version modified after the bookmark (late rows and changes
      of any date; all their versions are read, so the staging order decides
      which one is the latest), or
    * stand in the fact under an account that was modified since, or whose
      customer was.

    Ids (column _id, in the raw table's type, so that the scan of raw can be
    pruned by them) are matched null-safely.  Left out on purpose, as in the
    source's extract (strict ``>``): raw rows whose modification time is NULL
    or not after the bookmark, and changes of the city seed, which need a full
    build.
    """
    changed = {t: extract_since(raw[t], "last_modified_date", since[t]) for t in ("customers", "accounts", "transactions")}
    accounts = written(S.stg_accounts(raw["accounts"], as_of).select("account_id", *M.FACT_ACCOUNT_COLS), "staged-accounts")
    customers = _counted(changed["customers"].select(F.col("customer_id").alias("_customer")), "touched-customers")
    of_customers = accounts.join(customers, F.col("customer_id") == F.col("_customer"), "left_semi")
    touched_accounts = _counted(changed["accounts"].select("account_id").unionByName(of_customers.select("account_id"))
                                .withColumnRenamed("account_id", "_account"), "touched-accounts")
    stale = existing_fct.join(touched_accounts, F.col("account_id") == F.col("_account"), "left_semi")
    id_type = raw["transactions"].schema["transaction_id"].dataType
    ids = _counted(changed["transactions"].select(F.col("transaction_id").alias("_id")).unionByName(
        stale.select(F.col("transaction_id").cast(id_type).alias("_id"))), "touched-transactions")
    delta = M.fct_of_versions(_latest_of(raw["transactions"], ids), accounts, S.stg_customers(raw["customers"], as_of), cities)
    return ids, delta


def _latest_of(raw_transactions: DataFrame, ids: DataFrame) -> DataFrame:
    """The versions that staging keeps of the transactions ``ids``.

    Plain equality, so that a shuffle of the raw rows for the match serves the
    staging's window too, with their texts as one column; the NULL id, one
    transaction at most, is found apart.
    """
    texts = text_columns(raw_transactions, besides=["transaction_id"])
    packed = with_texts_packed(raw_transactions, texts).join(ids, F.col("transaction_id") == F.col("_id"), "left_semi")
    known = with_texts_unpacked(packed, texts, like=raw_transactions).select(*raw_transactions.columns)
    nulls = raw_transactions.where(F.col("transaction_id").isNull()).join(
        F.broadcast(ids.where(F.col("_id").isNull())), F.lit(True), "left_semi")
    return S.latest_transactions(known).unionByName(S.latest_transactions(nulls))


def _without(fct: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of other transactions; where the ids are too many for a broadcast, texts are shuffled as one column."""
    match = F.col("transaction_id").eqNullSafe(id_to_string("_id"))
    if bounded_rows(ids, broadcast_row_limit(ids)):
        return fct.join(ids, match, "left_anti")
    texts = text_columns(fct, besides=["transaction_id"])
    kept = with_texts_unpacked(with_texts_packed(fct, texts).join(ids, match, "left_anti"), texts, like=fct)
    return kept.select(*fct.columns)


def fct_transactions_incremental(existing_fct: DataFrame, raw: dict[str, DataFrame], cities: DataFrame,
                                 since, as_of=None) -> DataFrame:
    """The fact after an increment, equal to a full rebuild from ``raw`` (see ``fct_increment``)."""
    ids, delta = fct_increment(existing_fct, raw, cities, since, as_of)
    return _without(existing_fct, ids).unionByName(delta)


def _in_partitions(values: list, columns) -> object:
    """Rows of any of these partitions: a literal filter on partition columns, so other partitions aren't listed or read."""
    def one(row):
        return reduce(lambda a, b: a & b, [F.col(c).isNull() if row[c] is None else F.col(c) == F.lit(row[c]) for c in columns])
    return reduce(or_, [one(row) for row in values], F.lit(False))


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def replace_partitions(df: DataFrame, table: str, columns) -> None:
    """Overwrites the partitions of ``table`` that ``df`` has rows of, and no others.

    ``insertInto`` takes the mode from the session alone: as an option it is
    ignored and the whole table would be replaced.
    """
    spark = df.sparkSession
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rebalanced(df, columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _literal(value) -> str:
    return "null" if value is None else repr(value)


def merge_fct_transactions(spark: SparkSession, table: str, raw: dict[str, DataFrame], cities: DataFrame,
                           since, as_of=None) -> list[tuple]:
    """Merges an increment into the partitioned fact table ``table``; returns the partitions it rewrote.

    Rewritten are the months in which a touched id stands or stood (a row
    whose date moved leaves its old month); files of all other months are not
    read for it and stay as they are.  The new contents are written to the
    shared folder first and then replace the months by dynamic partition
    overwrite; months that lost their last row are dropped.  A run that fails
    between can be repeated with the same bookmarks: it finds the ids in
    whatever months they stand then.
    """
    columns = MART_PARTITIONS["fct_transactions"]
    existing = spark.table(table)
    ids, delta = fct_increment(existing, raw, cities, since, as_of)
    delta = written(delta.select(*existing.columns), "fct-delta")
    touched = existing.join(ids, F.col("transaction_id").eqNullSafe(id_to_string("_id")), "left_semi").select(*columns)
    # One row per partition of the table: as many as it has folders.
    months = touched.unionByName(delta.select(*columns)).distinct().collect()
    if not months:
        return []
    fresh = written(_without(existing.where(_in_partitions(months, columns)), ids).unionByName(delta), "fct-months")
    filled = {tuple(r) for r in fresh.select(*columns).distinct().collect()}
    replace_partitions(fresh, table, columns)
    for month in months:
        if tuple(month) not in filled:
            spec = ", ".join(f"{c} = {_literal(month[c])}" for c in columns)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)
    return sorted(map(tuple, months), key=str)


def _customers_of(versions: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Customers that stand in any version of the rows whose ``key`` changed: a moved row counts for both its owners."""
    keys = _counted(changed.select(F.col(key).alias("_key")), "changed-keys")
    return versions.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select("customer_id")


def _versions_for(versions: DataFrame, customers: DataFrame, key: str) -> DataFrame:
    """All versions of the rows that any version gives to one of ``customers``."""
    own = versions.join(customers, F.col("customer_id") == F.col("_customer"), "left_semi")
    keys = _counted(own.select(F.col(key).alias("_key")), "owned-keys")
    return versions.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def dim_customers_incremental(existing_dim: DataFrame, raw: dict[str, DataFrame], since, as_of=None) -> DataFrame:
    """The dimension after an increment, equal to a full rebuild from ``raw``.

    Minima, maxima and any-flags can't be undone, so the summaries of affected
    customers are computed anew from all their accounts and loans, and only
    theirs: customers that changed, and those that own or owned (in any
    version) an account or loan that changed.  The other rows are kept; their
    age, which follows ``as_of``, is set again from the date of birth.
    Bookmarks are taken as in ``fct_increment``.
    """
    changed = {t: extract_since(raw[t], "last_modified_date", since[t]) for t in ("customers", "accounts", "loan_applications")}
    affected = _counted(
        changed["customers"].select("customer_id")
        .unionByName(_customers_of(raw["accounts"], changed["accounts"], "account_id"))
        .unionByName(_customers_of(raw["loan_applications"], changed["loan_applications"], "application_id"))
        .withColumnRenamed("customer_id", "_customer"), "affected-customers")
    customers = raw["customers"].join(affected, F.col("customer_id").eqNullSafe(F.col("_customer")), "left_semi")
    accounts = S.stg_accounts(_versions_for(raw["accounts"], affected, "account_id"), as_of)
    loans = S.stg_loans(_versions_for(raw["loan_applications"], affected, "application_id"))
    delta = M.dim_customers(S.stg_customers(customers, as_of), accounts, loans)
    kept = existing_dim.join(affected, F.col("customer_id").eqNullSafe(F.col("_customer")), "left_anti")
    return kept.withColumn("age_years", age_years("date_of_birth", as_of)).select(*existing_dim.columns).unionByName(delta)
