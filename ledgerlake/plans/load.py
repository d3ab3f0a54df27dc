"""The incremental run: read the marks, extract, merge, write the run's tables, then publish them by views.

Every run writes its marts and marks as catalog tables of its own
(``fct_transactions_r<run>`` and so on); ``CREATE OR REPLACE VIEW`` makes them
what readers of ``fct_transactions``, ``dim_customers`` and ``load_marks`` see.
Marks are published last.  A run that fails before has changed nothing that
its readers or its successor see; one that fails between leaves older marks,
and the next run extracts and merges the same rows again to the same result.

With ``in_place`` the fact is one table whose touched months are replaced
(``merge.merge_fct_transactions``): at volume a run then writes what changed
instead of a copy of the fact.  Its months are replaced one after another, so
a reader may see some before others.

The tables need a catalog that outlives the session (a metastore); the
in-memory one serves tests.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import full_load_watermarks
from ..sources.sinks import register_views, write_table
from .merge import dim_customers_incremental, fct_transactions_incremental, merge_fct_transactions
from .pipeline import MART_PARTITIONS, MART_PROPERTIES, MARTS, MODEL_ORDER, Models, require_unique_cities

MARKS = "load_marks"


def read_marks(spark: SparkSession, schema: str) -> dict | None:
    """Bookmark per raw table (four rows); None before the first run."""
    if not spark.catalog.tableExists(f"{schema}.{MARKS}"):
        return None
    return {r["table_name"]: r["last_watermark"] for r in spark.table(f"{schema}.{MARKS}").collect()}


def run_table(schema: str, name: str, run: str) -> str:
    return f"{schema}.{name}_r{run}"


def publish(spark: SparkSession, schema: str, name: str, run: str) -> None:
    """Readers of the view ``name`` see the run's table from now on."""
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS SELECT * FROM {run_table(schema, name, run)}")


def published_run(spark: SparkSession, schema: str) -> str | None:
    """The run that the marks' view shows; None before the first."""
    if not spark.catalog.tableExists(f"{schema}.{MARKS}"):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.{MARKS}").where("col_name = 'View Text'").first()["data_type"]
    return text.rpartition("_r")[2].strip("` ")


def runs_of(spark: SparkSession, schema: str, name: str) -> list[str]:
    """The run tables of a mart, oldest first (run names begin with their time)."""
    found = spark.sql(f"SHOW TABLES IN {schema} LIKE '{name}_r2*'").collect()
    return sorted(r["tableName"] for r in found)


def drop_old_runs(spark: SparkSession, schema: str, keep: int = 2) -> None:
    """Drops all but the newest ``keep`` tables of each mart; never the published ones."""
    for name in (*MARTS, MARKS):
        for table in runs_of(spark, schema, name)[:-max(1, keep)]:
            if not table.endswith(f"_r{published_run(spark, schema)}"):
                spark.sql(f"DROP TABLE {schema}.{table}")


def load(spark: SparkSession, raw: dict[str, DataFrame], cities: DataFrame, schema: str, as_of=None,
         in_place: bool = False) -> dict[str, DataFrame]:
    """One run into the catalog schema ``schema``: full the first time, then incremental; returns the marts.

    The staged and enriched models are registered as views of the session, as
    ``run_pipeline`` does.
    """
    require_unique_cities(cities)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    models, since = Models(raw, cities, as_of), read_marks(spark, schema)
    register_views({name: models[name] for name in MODEL_ORDER if name not in MARTS})
    run = f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"
    # The marks are those of the raw rows that this run reads.
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    write_table(full_load_watermarks(raw, "last_modified_date", now), run_table(schema, MARKS, run), as_table=True)

    fct, dim = f"{schema}.fct_transactions", f"{schema}.dim_customers"
    options = dict(partition_by=MART_PARTITIONS["fct_transactions"], properties=MART_PROPERTIES["fct_transactions"], as_table=True)
    first_fct = fct if in_place else run_table(schema, "fct_transactions", run)
    if since is None:
        write_table(models.fct_of_raw(by_month=True), first_fct, placed=True, **options)
        new_dim = models["dim_customers"]
    else:
        if in_place:
            merge_fct_transactions(spark, fct, raw, cities, since, as_of)
        else:
            write_table(fct_transactions_incremental(spark.table(fct).select(*models["fct_transactions"].columns),
                                                     raw, cities, since, as_of), first_fct, **options)
        new_dim = dim_customers_incremental(spark.table(dim).select(*models["dim_customers"].columns), raw, since, as_of)
    write_table(new_dim, run_table(schema, "dim_customers", run), as_table=True)
    for name in (*(() if in_place else ("fct_transactions",)), "dim_customers", MARKS):
        publish(spark, schema, name, run)
    return {mart: spark.table(f"{schema}.{mart}").select(*[F.col(c) for c in models[mart].columns]) for mart in MARTS}
