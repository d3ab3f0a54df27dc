"""Compare a Spark DataFrame with a DuckDB query over the same parquet tables.

Checks column names, Arrow types (reported, not fatal) and the multiset of
rows.  Used by the pytest suite and by ``python -m tests.oracle_compare``.
"""

from __future__ import annotations

import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    return (type(v).__name__, str(v))


def rows_of(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, Counter(tuple(_norm(col[i]) for col in data) for i in range(table.num_rows))


def compare(spark_df, con, sql: str) -> dict:
    t0 = time.time()
    left = spark_df.toArrow()
    t1 = time.time()
    right = con.sql(sql).to_arrow_table()
    t2 = time.time()
    out = {"spark_rows": left.num_rows, "oracle_rows": right.num_rows,
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    lcols, lrows = rows_of(left)
    rcols, rrows = rows_of(right)
    out["names_match"] = lcols == rcols
    if lcols != rcols:
        out["names"] = {"spark_only": sorted(set(lcols) - set(rcols)),
                        "oracle_only": sorted(set(rcols) - set(lcols))}
    ltypes = {f.name: str(f.type) for f in left.schema}
    rtypes = {f.name: str(f.type) for f in right.schema}
    out["type_diffs"] = {k: (ltypes[k], rtypes.get(k)) for k in ltypes if ltypes[k] != rtypes.get(k)}
    out["values_match"] = out["names_match"] and lrows == rrows
    if out["names_match"] and not out["values_match"]:
        only_l = list((lrows - rrows).elements())[:3]
        only_r = list((rrows - lrows).elements())[:3]
        out["sample_spark_only"] = [dict(zip(lcols, r)) for r in only_l]
        out["sample_oracle_only"] = [dict(zip(rcols, r)) for r in only_r]
    return out


def main(argv):
    import json
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from ledgerlake.config import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = set(argv)
    spark = local_session()
    con = duck_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            df = fn(spark, sf_dir)
            print(json.dumps({"query": name, "rows_only": df.count()}))
            continue
        try:
            res = compare(fn(spark, sf_dir), con, sqls[name])
        except Exception as exc:  # report and continue
            res = {"error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        ok = res.get("values_match") and not res.get("type_diffs")
        bad += 0 if res.get("values_match") else 1
        print(json.dumps({"query": name, "ok": ok, **res}, default=str))
    print(json.dumps({"mismatches": bad}))


if __name__ == "__main__":
    main(sys.argv[1:])
