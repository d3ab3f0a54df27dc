"""Dataset-level quality checks in long form: (check_name, table_name, column_name, failing_rows).

Semantics follow the usual schema tests:

* unique           number of non-NULL values that occur more than once
* not_null         number of rows where the column is NULL
* relationships    child rows whose non-NULL key has no parent row
* accepted_values  number of distinct non-NULL values outside the list

Every check kind reads each table once: the checked columns are tagged and
exploded into (column_name, value) pairs and aggregated together, with
map-side partial aggregation, so a hot value costs one row per input
partition in the shuffle.  Columns without failures still get a row (0).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT_COLS = ("check_name", "table_name", "column_name", "failing_rows")


def _row(check: str, table: str, column: str, failing) -> list:
    return [F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"), failing.cast("long").alias("failing_rows")]


def _tagged_values(df: DataFrame, columns: Sequence[str], bad=None) -> DataFrame:
    """One row per (column_name, value) for the given columns, from a single scan.

    ``bad(column)`` optionally keeps only failing values.  NULL values are skipped.
    """
    tagged = []
    for c in columns:
        keep = F.col(c).isNotNull() if bad is None else F.col(c).isNotNull() & bad(c)
        tagged.append(F.when(keep, F.struct(F.lit(c).alias("column_name"),
                                            F.col(c).cast("string").alias("value"))))
    return (df.select(F.explode(F.array(*tagged)).alias("t"))
              .where(F.col("t").isNotNull())
              .select("t.column_name", "t.value"))


def _with_zero_rows(found: DataFrame, check: str, table: str, columns: Sequence[str]) -> DataFrame:
    """Attach the per-column failure counts to the full list of checked columns (0 if none)."""
    spark = found.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"))
    return (names.join(F.broadcast(found), "column_name", "left")
                 .select(*_row(check, table, "", F.lit(0))[:2], F.col("column_name"),
                         F.coalesce(F.col("failing"), F.lit(0)).cast("long").alias("failing_rows")))


def check_unique(df: DataFrame, table: str, columns: Sequence[str] | str) -> DataFrame:
    """Duplicated values per column; all columns of a table in one scan and one shuffle."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    dup = (_tagged_values(df, columns).groupBy("column_name", "value").count()
           .where(F.col("count") > 1)
           .groupBy("column_name").agg(F.count(F.lit(1)).alias("failing")))
    return _with_zero_rows(dup, "unique", table, columns)


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """All columns of one table in a single scan, then one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("failing"))
                      for i, c in enumerate(columns)])
    return (counts.select(F.inline(pairs))
                  .select(*_row("not_null", table, "", F.lit(0))[:2], F.col("column_name"),
                          F.col("failing").cast("long").alias("failing_rows")))


def check_relationships(child: DataFrame, table: str, column: str,
                        parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent.  Rows are counted per key first
    (partial aggregation), so the anti join sees one row per distinct key."""
    per_key = (child.select(column).where(F.col(column).isNotNull())
                    .groupBy(column).agg(F.count(F.lit(1)).alias("_rows")))
    keys = parent.select(F.col(parent_column).alias("_pk"))
    orphans = per_key.join(keys, F.col(column) == F.col("_pk"), "left_anti")
    return orphans.agg(*_row("relationships", table, column, F.coalesce(F.sum("_rows"), F.lit(0))))


def check_accepted_values(df: DataFrame, table: str, accepted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct unaccepted values per column; all columns of a table in one scan."""
    columns = list(accepted)
    bad = (_tagged_values(df, columns, lambda c: ~F.col(c).isin(list(accepted[c])))
           .distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("failing")))
    return _with_zero_rows(bad, "accepted_values", table, columns)


def run_checks(frames: Mapping[str, DataFrame], unique=(), not_null=(), relationships=(),
               accepted=()) -> DataFrame:
    """Run check specs against named frames and return one long-form result.

    unique:        [(table, column)]
    not_null:      [(table, [columns])]
    relationships: [(child_table, column, parent_table, parent_column)]
    accepted:      [(table, column, [values])]
    """
    by_table: dict[str, list] = {}
    for t, c in unique:
        by_table.setdefault(t, []).append(c)
    parts = [check_unique(frames[t], t, cols) for t, cols in by_table.items()]
    parts += [check_not_null(frames[t], t, cols) for t, cols in not_null]
    parts += [check_relationships(frames[t], t, c, frames[p], pc) for t, c, p, pc in relationships]
    acc: dict[str, dict] = {}
    for t, c, vals in accepted:
        acc.setdefault(t, {})[c] = vals
    parts += [check_accepted_values(frames[t], t, cols) for t, cols in acc.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
