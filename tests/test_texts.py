"""Texts that are shuffled as one column come back as they were, and the fact's joins shuffle them so."""

import re

import pytest

from ledgerlake.catalog import Inputs
from ledgerlake.operators.texts import text_columns, with_texts_packed, with_texts_unpacked
from ledgerlake.plans import merge
from ledgerlake.sources.sinks import rebalanced

SF = "/root/testdata/sf0.001"


def test_texts_come_back(spark):
    odd = [None, "", " ", "a", "\x01", "\x02", "\x01n", "\x01a", "\x01b", "\x02a", "\x01\x02", "\x02\x01n\x02", "\n\t\"',|", "\x00", "\u00e9\u6f22\U0001f600", "a" * 3000]
    rows = [(i, x, 7, y) for i, (x, y) in enumerate((x, y) for x in odd for y in odd)]
    df = spark.createDataFrame(rows, "id long, x string, n int, y string")
    names = text_columns(df)
    assert names == ["x", "y"] and text_columns(df, besides=["x"]) == ["y"]
    packed = with_texts_packed(df, names)
    assert packed.columns == ["id", "n", "_texts"]
    back = with_texts_unpacked(packed.repartition(3, "id"), names).select(*df.columns)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(tuple(r) for r in back.collect()) == rows
    one = with_texts_unpacked(with_texts_packed(df, ["y"]).repartition(3, "id"), ["y"]).select(*df.columns)
    assert sorted(tuple(r) for r in one.collect()) == rows


@pytest.fixture()
def plain_plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.debug.maxToStringFields")


def shuffled(df, key):
    """The columns below each exchange by ``key`` in the plan of ``df``."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if re.search(rf"Exchange (hashpartitioning|rebalance).*{key}", line)]


def test_fact_shuffles_its_texts_as_one_column(spark, plain_plans):
    x = Inputs(spark, SF)
    made = "\n".join(shuffled(x.m.fct_of_raw(by_month=True), "account_id"))
    assert "AS _texts" in made and "AS _account_texts" in made


def test_increment_shuffles_texts_as_one_column(spark, plain_plans, monkeypatch):
    monkeypatch.setattr(merge, "broadcast_row_limit", lambda df: 0)
    x = Inputs(spark, SF)
    fct, raw = x.m.fct_of_raw(), x.raw["transactions"]
    ids = raw.where("transaction_id % 3 = 0").selectExpr("transaction_id as _id").distinct()
    kept = merge._without(fct, ids)
    assert kept.schema == fct.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, fct.where("cast(transaction_id as long) % 3 != 0").collect()))
    assert any("AS _texts" in p for p in shuffled(kept, "transaction_id"))
    assert any("AS _texts" in p for p in shuffled(merge._latest_of(raw, ids), "transaction_id"))


def test_partitioned_writes_shuffle_texts_as_one_column(spark, plain_plans):
    fct = Inputs(spark, SF).m["fct_transactions"]
    placed = rebalanced(fct, ["transaction_year", "transaction_month"])
    assert placed.schema == fct.schema
    above, _, below = placed._jdf.queryExecution().optimizedPlan().toString().partition("RebalancePartitions")
    assert "_texts" in below.splitlines()[1] and "split(_texts" in above
    assert sorted(map(str, placed.collect())) == sorted(map(str, fct.collect()))
