"""Quality checks within the write: one pass writes good rows and rejects and measures both.

``Expectation`` is a row rule.  ``write_checked`` tags every row with the
first rule it breaks, counts rows and failures with an ``Observation`` while
the rows are written, and writes good and rejected rows to one table
partitioned by whether they were rejected, so that the input is evaluated
once.  ``good`` and ``rejects`` read their partition only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REASON, REJECTED = "reject_reason", "is_rejected"


@dataclass(frozen=True)
class Expectation:
    name: str
    holds: Column  # a row passes unless this is false or NULL


def not_null(column: str) -> Expectation:
    return Expectation(f"not_null:{column}", F.col(column).isNotNull())


def accepted_values(column: str, values: Sequence) -> Expectation:
    """NULL passes, as in the aggregate check."""
    return Expectation(f"accepted_values:{column}", F.col(column).isNull() | F.col(column).isin(list(values)))


def between(column: str, low, high) -> Expectation:
    return Expectation(f"between:{column}", F.col(column).isNull() | F.col(column).between(low, high))


def known(flag: str, foreign_key: str) -> Expectation:
    """The row's foreign key was found (see ``with_reference``); NULL passes."""
    return Expectation(f"relationships:{foreign_key}", F.col(foreign_key).isNull() | F.col(flag))


def with_reference(df: DataFrame, foreign_key: str, parent: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` plus ``flag``: whether the foreign key stands among the parent's keys (unique keys, skew-splittable left join)."""
    keys = parent.select(F.col(key).alias("_ref")).where("_ref is not null").distinct().withColumn(flag, F.lit(True))
    joined = df.join(keys, F.col(foreign_key) == F.col("_ref"), "left").drop("_ref")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def tagged(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``df`` plus the name of the first expectation that a row breaks (NULL if none)."""
    broken = [F.when(~F.coalesce(e.holds, F.lit(False)), F.lit(e.name)) for e in expectations]
    return df.withColumn(REASON, F.coalesce(*broken, F.lit(None).cast("string")))


def write_checked(df: DataFrame, target: str, expectations: Sequence[Expectation], drop: Sequence[str] = ()) -> dict[str, int]:
    """Writes ``df`` to the folder ``target``; returns rows, rejected and the failures of each expectation.

    A row that breaks several expectations counts for each and is rejected
    for the first.  ``drop`` names helper columns that are not written.
    """
    seen = Observation()
    failures = [F.count_if(~F.coalesce(e.holds, F.lit(False))).alias(e.name) for e in expectations]
    checked = tagged(df, expectations).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REASON).isNotNull()).alias("rejected"), *failures)
    checked.drop(*drop).withColumn(REJECTED, F.col(REASON).isNotNull()).write.mode("overwrite").partitionBy(REJECTED).parquet(target)
    return {k: int(v) for k, v in seen.get.items()}


def _part(spark: SparkSession, target: str, like: DataFrame, rejected: bool) -> DataFrame:
    schema = like.withColumn(REASON, F.lit(None).cast("string")).withColumn(REJECTED, F.lit(False)).schema
    return spark.read.schema(schema).parquet(target).where(F.col(REJECTED) == rejected).drop(REJECTED)


def good(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """The rows that passed, with the columns of ``like``."""
    return _part(spark, target, like, False).select(*like.columns)


def rejects(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """The rows that didn't, with their reason."""
    return _part(spark, target, like, True)
