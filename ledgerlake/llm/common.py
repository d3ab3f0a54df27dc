"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_dir

# White space and words as the operators define them: ASCII only.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage durably."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure-ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (bound as a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the needed columns, under internal names: other columns can't clash."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])
