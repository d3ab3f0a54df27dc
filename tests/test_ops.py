"""Quality checks, incremental load / merges, sinks and the seed reader."""

import datetime as dt
from collections import Counter
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.config import shared_dir
from ledgerlake.operators import incremental as INC
from ledgerlake.operators import quality as Q
from ledgerlake.operators.joins import bounded_rows
from ledgerlake.sources import sinks
from ledgerlake.sources.raw import NZ_CITIES, read_seed

TS = dt.datetime


def as_dict(df):
    return {(r.check_name, r.table_name, r.column_name): r.failing_rows for r in df.collect()}


def test_quality_checks_long_form(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    child = spark.createDataFrame([(1, "A"), (3, "B"), (None, "b"), (3, None)], "pid long, v string")
    out = as_dict(Q.run_checks({"p": parent, "c": child}, unique=[("p", "id"), ("c", "v")],
                               not_null=[("c", ["pid", "v"])],
                               relationships=[("c", "pid", "p", "id")],
                               accepted=[("c", "v", ["A"])]))
    assert out == {("unique", "p", "id"): 1, ("unique", "c", "v"): 0,
                   ("not_null", "c", "pid"): 1, ("not_null", "c", "v"): 1,
                   ("relationships", "c", "pid"): 2,
                   ("accepted_values", "c", "v"): 2}


def test_watermark_extract_is_strict_and_advance_keeps_old_value(spark):
    df = spark.createDataFrame([(1, TS(2024, 1, 1)), (2, TS(2024, 1, 2)), (3, TS(2024, 1, 3))],
                               "id long, ts timestamp_ntz")
    wm = INC.initial_watermarks(spark, {"t": "2024-01-02 00:00:00", "u": "2024-05-01 00:00:00"})
    batch = INC.extract_since(df, "ts", INC.watermark_of(wm, "t"))
    assert sorted(r.id for r in batch.collect()) == [3]           # equal to the mark: not extracted
    new = {r.table_name: r for r in INC.advance_watermark(wm, batch, "t", "ts", "2024-06-01").collect()}
    assert new["t"].last_watermark == TS(2024, 1, 3) and new["t"].rows_extracted == 1
    empty = INC.extract_since(df, "ts", INC.watermark_of(wm, "u"))
    kept = {r.table_name: r for r in INC.advance_watermark(wm, empty, "u", "ts", "2024-06-01").collect()}
    assert kept["u"].last_watermark == TS(2024, 5, 1) and kept["u"].rows_extracted == 0
    assert INC.extract_since(df, "ts", None).count() == 3          # first run: full load


def test_upsert_and_insert_if_absent(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k long, v string")
    new = spark.createDataFrame([(1, "new"), (3, "new")], "k long, v string")
    up = {r.k: r.v for r in INC.upsert(old, new, ["k"]).collect()}
    assert up == {1: "new", 2: "old", 3: "new"}
    ins = {r.k: r.v for r in INC.insert_if_absent(old, new, ["k"]).collect()}
    assert ins == {1: "old", 2: "old", 3: "new"}


def test_write_table_with_property_and_read_back(spark):
    df = spark.createDataFrame([(1, 2001, "a"), (2, 2002, None)], "id long, y int, v string")
    path = os.path.join(shared_dir(spark), "t_roundtrip")
    sinks.write_table(df, path, partition_by=["y"])
    back = sinks.read_back(spark, path, df)
    assert back.columns == df.columns and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    name = "ledgerlake_prop_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.write_table(df, name, as_table=True,
                      properties={"delta.feature.allowColumnDefaults": "supported"})
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props.get("delta.feature.allowColumnDefaults") == "supported"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_row_counts(spark):
    a = spark.range(5)
    b = spark.range(2)
    assert {r.table_name: r.row_count for r in sinks.row_counts({"a": a, "b": b}).collect()} == {"a": 5, "b": 2}


def test_seed_csv_and_builtin_rows_agree(spark):
    d = tempfile.mkdtemp(prefix="ledgerlake-seed-")
    with open(os.path.join(d, "cities.csv"), "w") as f:
        f.write("city_name,country,region\n")
        for r in NZ_CITIES:
            f.write(",".join(r) + "\n")
    csv = read_seed(spark, os.path.join(d, "cities.csv"))
    assert sorted(map(tuple, csv.collect())) == sorted(map(tuple, read_seed(spark).collect())) == sorted(NZ_CITIES)
    assert bounded_rows(csv, 10) and not bounded_rows(csv, 9)
    assert bounded_rows(read_seed(spark), 10)


def test_read_raw_schema_and_pushdown(spark):
    from ledgerlake import schemas
    from ledgerlake.catalog import Inputs
    from ledgerlake.sources.raw import read_raw
    path = os.path.join(shared_dir(spark), "raw_accounts_test")
    raw = Inputs(spark, "/root/testdata/sf0.001").raw["accounts"]
    # store ids as 32-bit ints, as the source DDL does
    raw.withColumn("account_id", F.col("account_id").cast("int")).write.mode("overwrite").parquet(path)
    df = read_raw(spark, path, "accounts")
    assert df.schema == schemas.ACCOUNTS
    q = df.where(F.col("status") == "active").select("account_id", "status")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,active)]" in plan
    assert "ReadSchema: struct<account_id:int,status:string>" in plan
    assert q.count() == raw.where(F.col("status") == "active").count()


def test_register_views_exposes_models_to_sql(spark):
    from ledgerlake.catalog import Inputs
    from ledgerlake.plans.pipeline import MODEL_ORDER
    x = Inputs(spark, "/root/testdata/sf0.001")
    models = {n: x.m[n] for n in MODEL_ORDER}
    sinks.register_views(models)
    n = spark.sql("SELECT count(*) AS n FROM fct_transactions WHERE transaction_risk_level = 'HIGH'").first().n
    assert n == models["fct_transactions"].where("transaction_risk_level = 'HIGH'").count()
    joined = spark.sql("""SELECT d.customer_id, count(f.transaction_id) AS n
                          FROM dim_customers d LEFT JOIN fct_transactions f ON d.customer_id = f.customer_id
                          GROUP BY d.customer_id""")
    assert joined.count() == models["dim_customers"].count()


def test_settings_for_volume():
    from ledgerlake.config import settings_for_volume
    s = settings_for_volume(100 * 1024 ** 4)            # 100 TiB
    assert s["spark.sql.shuffle.partitions"] == str(400 * 1024)
    assert settings_for_volume(1)["spark.sql.shuffle.partitions"] == "8"


def test_read_raw_from_catalog_table(spark):
    from ledgerlake import schemas
    from ledgerlake.catalog import Inputs
    from ledgerlake.sources.raw import read_raw
    raw = Inputs(spark, "/root/testdata/sf0.001").raw["loan_applications"]
    spark.sql("DROP TABLE IF EXISTS ledgerlake_raw_loans")
    raw.write.saveAsTable("ledgerlake_raw_loans")
    df = read_raw(spark, "ledgerlake_raw_loans", "loan_applications", fmt="table")
    assert df.schema == schemas.LOAN_APPLICATIONS and df.count() == raw.count()
    spark.sql("DROP TABLE IF EXISTS ledgerlake_raw_loans")


def test_broadcast_budget_counts_bytes(spark):
    from ledgerlake.operators.joins import broadcast_row_limit, row_bytes
    narrow = spark.range(1)
    wide = spark.range(1).selectExpr(*[f"'x' AS s{i}" for i in range(100)])
    assert row_bytes(wide) == 100 * 64
    assert broadcast_row_limit(wide) < broadcast_row_limit(narrow) <= 1_000_000


def test_cli_run_and_test(spark, capsys):
    from ledgerlake.__main__ import main
    from ledgerlake.catalog import Inputs
    root = os.path.join(shared_dir(spark), "cli_test")
    x = Inputs(spark, "/root/testdata/sf0.001")
    for t in ("customers", "accounts", "transactions", "loan_applications"):
        x.raw[t].write.mode("overwrite").parquet(os.path.join(root, "raw", t))
    assert main(["run", "--raw", os.path.join(root, "raw"), "--out", os.path.join(root, "out"),
                 "--as-of", "2002-01-01"]) == 0
    fct = spark.read.parquet(os.path.join(root, "out", "mart", "fct_transactions"))
    assert fct.count() == x.m["fct_transactions"].count()
    assert spark.conf.get("spark.sql.ansi.enabled") == "true" and spark.conf.get("spark.sql.session.timeZone") == "UTC"
    models = ["stg_customers", "stg_accounts", "stg_loans", "stg_transactions", "dim_customers", "fct_transactions",
              "nz_cities"]
    raw = ["--raw", os.path.join(root, "raw")]
    assert main(["test", *raw, "--select", *models]) == 0      # re-extracted versions are no duplicates
    out = capsys.readouterr().out
    assert "PASS unique(stg_transactions.transaction_id)" in out and "PASS unique(nz_cities.city_name)" in out
    assert main(["test", *raw, "--select", "transactions"]) == 1  # orphans among the raw rows
    assert "FAIL relationships(transactions.account_id)" in capsys.readouterr().out
    seed = os.path.join(root, "seed")
    twice = read_seed(spark).limit(1)
    read_seed(spark).unionByName(twice).coalesce(1).write.mode("overwrite").option("header", True).csv(seed)
    assert main(["test", *raw, "--select", "nz_cities", "--seed", seed]) == 1
    with pytest.raises(ValueError, match="more than once"):
        main(["run", *raw, "--out", os.path.join(root, "out"), "--seed", seed])


def test_settings_follow_the_volume(spark):
    from ledgerlake.config import apply_settings, input_bytes
    before = {k: spark.conf.get(k) for k in apply_settings(spark, 1)}
    try:
        apply_settings(spark, 100 * 1024 ** 4)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    docs = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert 50_000 < input_bytes([docs]) < 1_000_000


def test_size_check_moves_no_rows(spark):
    df = spark.range(1000).repartition(4)
    seen = df.agg(F.count(F.lit(1)))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Limit" not in plan and not bounded_rows(df, 999) and bounded_rows(df, 1000)


def test_upsert_matches_null_keys(spark):
    old = spark.createDataFrame([(None, "old"), (1, "old")], "k long, v string")
    new = spark.createDataFrame([(None, "new")], "k long, v string")
    assert Counter(map(tuple, INC.upsert(old, new, ["k"]).collect())) == Counter([(1, "old"), (None, "new")])


def test_run_registers_views_and_sets_properties(spark):
    from ledgerlake.catalog import Inputs
    from ledgerlake.plans.pipeline import MART_PROPERTIES, run_pipeline
    x = Inputs(spark, "/root/testdata/sf0.001")
    out = os.path.join(shared_dir(spark), "table_run")
    spark.sql("CREATE DATABASE IF NOT EXISTS marts_test")
    marts = run_pipeline(spark, x.raw, x.cities, out, "2002-01-01", schema="marts_test")
    assert spark.table("stg_accounts").count() == x.m["stg_accounts"].count()
    assert spark.table("int_loans_enriched").count() == x.m["int_loans_enriched"].count()
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES marts_test.fct_transactions").collect()}
    assert MART_PROPERTIES["fct_transactions"].items() <= properties.items()
    assert marts["fct_transactions"].count() == x.m["fct_transactions"].count()
    spark.sql("DROP DATABASE marts_test CASCADE")


def test_upsert_with_broadcast_keys_streams_the_old_table(spark):
    old = spark.range(1000).selectExpr("id AS k", "'old' AS v")
    new = spark.createDataFrame([(1, "new"), (5000, "new")], "k long, v string")
    merged = INC.upsert(old, new, ["k"], broadcast_new_keys=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    got = {r.k: r.v for r in merged.collect()}
    assert len(got) == 1001 and got[1] == "new" and got[5000] == "new" and got[2] == "old"


def test_insert_if_absent_with_broadcast_keys(spark):
    old = spark.range(1000).selectExpr("id AS k", "'old' AS v")
    new = spark.createDataFrame([(1, "new"), (5000, "new"), (None, "null-key")], "k long, v string")
    plain = INC.insert_if_absent(old, new, ["k"])
    fast = INC.insert_if_absent(old, new, ["k"], broadcast_new_keys=True)
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, fast.collect()))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    got = {r.k: r.v for r in fast.collect()}
    assert got[1] == "old" and got[5000] == "new" and got[None] == "null-key"
