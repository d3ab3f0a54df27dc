"""Command line: build the marts, load an increment, or run the data-quality checks.

    spark-submit --py-files ledgerlake.zip run_ledgerlake.py run  --raw <dir|schema> --out <shared dir> [--as-of YYYY-MM-DD]
    spark-submit --py-files ledgerlake.zip run_ledgerlake.py load --raw <dir|schema> --schema <catalog schema> [--in-place] [--as-of YYYY-MM-DD]
    spark-submit --py-files ledgerlake.zip run_ledgerlake.py test --raw <dir|schema> [--select TABLE ...]

``--raw`` holds one table per name (customers, accounts, transactions,
loan_applications): folders under a path, or tables of a catalog schema with
``--format table``.  The session comes from ``getOrCreate``; the settings that
results and scale depend on (time zone, ANSI mode, AQE, shuffle sizes from
the input's volume) are applied to it.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .catalog import DQ_ACCEPTED, DQ_MODEL_UNIQUE, DQ_NOT_NULL, DQ_RELATIONSHIPS
from .config import apply_settings, input_bytes
from .operators.quality import run_checks
from .plans.load import load, published_run
from .plans.pipeline import Models, run_pipeline
from .sources.raw import read_raw, read_seed

RAW = ("customers", "accounts", "transactions", "loan_applications")


def _raw(spark: SparkSession, where: str, fmt: str) -> dict:
    locate = (lambda t: f"{where}.{t}") if fmt == "table" else (lambda t: os.path.join(where, t))
    return {t: read_raw(spark, locate(t), t, fmt) for t in RAW}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "load", "test"):
        p = sub.add_parser(name)
        p.add_argument("--raw", required=True)
        p.add_argument("--format", default="parquet")
        p.add_argument("--seed", default=None, help="headed CSV of the city lookup (default: built-in rows)")
        p.add_argument("--as-of", default=None, help="evaluation date (default: today)")
        p.add_argument("--input-bytes", type=int, default=None,
                       help="volume that sizes the shuffles (default: the size of the raw tables)")
        if name == "run":
            p.add_argument("--out", required=True, help="shared output folder")
        elif name == "load":
            p.add_argument("--schema", required=True, help="catalog schema of the marts and marks")
            p.add_argument("--in-place", action="store_true", help="replace the fact's touched months instead of writing a copy")
        else:
            p.add_argument("--select", nargs="*", default=None, help="tables to check (default: all)")
            p.add_argument("--accepted", action="store_true", help="check accepted values too")
        if name == "run":
            p.add_argument("--schema", default=None, help="write the marts as tables of this catalog schema")
            p.add_argument("--buckets", type=int, default=None, help="with --schema: bucket the staged tables by their join keys")
            p.add_argument("--no-materialize-staging", action="store_true")
    args = ap.parse_args(argv)

    # A batch job: no live web UI (use the event log for stage timings).
    spark = (SparkSession.builder.appName(f"ledgerlake-{args.cmd}")
             .config("spark.ui.enabled", "false").getOrCreate())
    raw = _raw(spark, args.raw, args.format)
    apply_settings(spark, args.input_bytes or input_bytes(raw.values()))
    cities = read_seed(spark, args.seed)
    if args.cmd == "run":
        marts = run_pipeline(spark, raw, cities, args.out, args.as_of,
                             materialize_staging=not args.no_materialize_staging, schema=args.schema,
                             buckets=args.buckets)
        for name in marts:
            print(f"{name}: written to {f'{args.schema}.{name}' if args.schema else os.path.join(args.out, 'mart', name)}")
        return 0
    if args.cmd == "load":
        load(spark, raw, cities, args.schema, args.as_of, args.in_place)
        print(f"loaded: run {published_run(spark, args.schema)}")
        return 0

    models = Models(raw, cities, args.as_of)
    names = {t for t, _ in DQ_MODEL_UNIQUE} | {t for t, *_ in DQ_ACCEPTED} | set(raw)
    chosen = set(args.select or names)
    if chosen - names:
        ap.error(f"unknown tables: {', '.join(sorted(chosen - names))}")
    frames = {n: raw[n] if n in raw else cities if n == "nz_cities" else models[n] for n in names}
    pick = lambda checks: [c for c in checks if c[0] in chosen]
    # Raw tables hold every extracted version of a row: uniqueness is checked from the staged tables on.
    result = run_checks(frames, unique=pick(DQ_MODEL_UNIQUE), not_null=pick(DQ_NOT_NULL),
                        relationships=pick(DQ_RELATIONSHIPS),
                        accepted=pick(DQ_ACCEPTED) if args.accepted else [])
    rows = result.orderBy("check_name", "table_name", "column_name").collect()
    failed = 0
    for r in rows:
        status = "PASS" if r.failing_rows == 0 else "FAIL"
        failed += status == "FAIL"
        print(f"{status} {r.check_name}({r.table_name}.{r.column_name}): {r.failing_rows} failing")
    print(f"{len(rows) - failed} passed, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
