"""Raw-table scans with strict schemas, and the city seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.joins import mark_row_count

# The city seed (city_name, country, region), in source order.
NZ_CITIES = [
    ("Auckland", "NZ", "Auckland"),
    ("Wellington", "NZ", "Wellington"),
    ("Christchurch", "NZ", "Canterbury"),
    ("Hamilton", "NZ", "Waikato"),
    ("Tauranga", "NZ", "Bay of Plenty"),
    ("Dunedin", "NZ", "Otago"),
    ("Queenstown", "NZ", "Otago"),
    ("Napier", "NZ", "Hawke's Bay"),
    ("Palmerston North", "NZ", "Manawatu"),
    ("Nelson", "NZ", "Nelson"),
]


def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Scan one raw table with its declared schema (no inference).

    ``path`` is a storage path, or a catalog table name when ``fmt`` is
    ``"table"`` (e.g. ``raw.transactions``).

    Only columns whose stored type differs from the declared one are cast
    (e.g. 32-bit ids widened to 64 bits); the others stay plain column
    references, so filters on them reach the parquet scan as pushed filters
    and unused columns are pruned from the read schema.
    """
    df = spark.table(path) if fmt == "table" else spark.read.format(fmt).load(path)
    return conform(df, table)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto the declared schema of ``table`` (names, order, types)."""
    schema = schemas.RAW_SCHEMAS[table]
    stored = {f.name: f.dataType for f in df.schema.fields}
    if [(f.name, f.dataType) for f in schema.fields] == list(stored.items()):
        return df
    return df.select(*[F.col(f.name) if stored.get(f.name) == f.dataType
                       else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


CORRUPT = "_corrupt_record"
REASON = "reject_reason"


def read_text_table(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """A raw table from csv (with a header) or json: every column as text, a record that doesn't parse in ``CORRUPT``."""
    names = [f.name for f in schemas.RAW_SCHEMAS[table].fields]
    schema = ", ".join(f"`{n}` string" for n in [*names, CORRUPT])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("header", True).option("primitivesAsString", True).format(fmt).load(path))


def _checked_columns(df: DataFrame, table: str) -> tuple[list, Column]:
    """The declared columns computed from ``df``, and why a row can't have them (NULL: it can)."""
    stored = {f.name: f.dataType for f in df.schema.fields}
    values, broken = [], []
    if CORRUPT in stored:
        broken.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")))
    for f in schemas.RAW_SCHEMAS[table].fields:
        if f.name not in stored:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif stored[f.name] == f.dataType:
            values.append(F.col(f.name))
        else:
            value = F.col(f.name).try_cast(f.dataType)
            values.append(value.alias(f.name))
            broken.append(F.when(F.col(f.name).isNotNull() & value.isNull(), F.lit(f"type:{f.name}")))
    return values, F.coalesce(*broken, F.lit(None).cast("string"))


def conform_checked(df: DataFrame, table: str) -> DataFrame:
    """``df`` on the declared schema of ``table`` plus ``REASON``, NULL in good rows.

    Stored types are widened or parsed; a value that doesn't fit its declared
    type rejects the row (``type:<column>``, the first in schema order), a
    record that could not be parsed is ``malformed``.  Columns that are
    missing are NULL.  No row is dropped.
    """
    values, reason = _checked_columns(df, table)
    return df.select(*values, reason.alias(REASON))


def split_malformed(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(good rows with the declared schema, rejects as (reject_reason, record)); together every row of ``df``.

    ``record`` is the row as it came, as JSON.
    """
    values, reason = _checked_columns(df, table)
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    good = df.where(reason.isNull()).select(*values)
    return good, df.where(reason.isNotNull()).select(reason.alias(REASON), record.alias("record"))


def read_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The city lookup: a headed CSV on shared storage, or the built-in rows."""
    if path is None:
        # Built JVM-side from literals: no Python worker is needed to scan it.
        rows = [F.struct(*[F.lit(v).alias(f.name) for v, f in zip(r, schemas.CITIES.fields)])
                for r in NZ_CITIES]
        return mark_row_count(spark.range(1).select(F.inline(F.array(*rows))), len(NZ_CITIES))
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .schema(schemas.CITIES).csv(path))
