"""Checks within the write, malformed input, and mergeable distinct counts."""

import datetime as dt
import random
import uuid
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.config import shared_dir
from ledgerlake.operators import expectations as E
from ledgerlake.operators.sketches import distinct_in, monthly_sketches
from ledgerlake.sources.raw import conform_checked, read_text_table, split_malformed
from tests.test_load import frame, tx


def test_write_checked_measures_and_routes_in_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        seen.add(1)
        return i

    rows = [(i, None if i % 7 == 0 else i % 5, "ab"[i % 2] if i % 11 else "z", i % 13) for i in range(200)]
    parent = spark.createDataFrame([(k,) for k in range(10)] * 3 + [(None,)], "k long")
    source = spark.createDataFrame(rows, "id long, a long, b string, fk long").withColumn("id", counted("id"))
    df = E.with_reference(source, "fk", parent, "k", "_known")
    target = f"{shared_dir(spark)}/checked-{uuid.uuid4().hex}"
    rules = [E.not_null("a"), E.accepted_values("b", ["a", "b"]), E.known("_known", "fk"), E.between("id", 0, 180)]
    found = E.write_checked(df, target, rules, drop=["_known"])
    assert seen.value == len(rows)  # each row was made once, for good rows, rejects and counts

    def reason(r):
        i, a, b, fk = r
        return ("not_null:a" if a is None else "accepted_values:b" if b == "z" else "relationships:fk" if fk > 9
                else "between:id" if i > 180 else None)

    reasons = Counter(map(reason, rows))
    assert found == {"rows": 200, "rejected": 200 - reasons[None], "not_null:a": sum(r[1] is None for r in rows),
                     "accepted_values:b": sum(r[2] == "z" for r in rows), "relationships:fk": sum(r[3] > 9 for r in rows),
                     "between:id": 19}
    good = E.good(spark, target, source)
    assert good.columns == source.columns
    assert Counter(map(tuple, good.collect())) == Counter(r for r in rows if reason(r) is None)
    assert Counter((r[0], r[E.REASON]) for r in E.rejects(spark, target, source).collect()) == Counter(
        (r[0], reason(r)) for r in rows if reason(r))


def test_empty_input_is_measured(spark):
    target = f"{shared_dir(spark)}/checked-{uuid.uuid4().hex}"
    df = spark.createDataFrame([], "id long")
    assert E.write_checked(df, target, [E.not_null("id")]) == {"rows": 0, "rejected": 0, "not_null:id": 0}
    assert E.good(spark, target, df).count() == E.rejects(spark, target, df).count() == 0


def test_malformed_text_is_kept_as_rejects(spark, tmp_path):
    root = str(tmp_path)
    names = ("application_id,customer_id,loan_type,applied_amount,approved_amount,interest_rate,term_months,application_date,"
             "decision_date,status,decline_reason,credit_score,debt_to_income,last_modified_date")
    lines = ["1,2,HOME,10.50,,1.25,12,2024-01-02,,OPEN,,700,0.30,2024-01-03 04:05:06",
             "x1,2,HOME,10.50,,1.25,12,2024-01-02,,OPEN,,700,0.30,2024-01-03 04:05:06",       # an id that is none
             "3,2,HOME,ten,,1.25,12,soon,,OPEN,,700,0.30,2024-01-03 04:05:06",                # two bad values: the first counts
             "4,2,HOME,10.50",                                                                # too short
             "5,2,HOME,10.50,,1.25,12,2024-01-02,,OPEN,,700,0.30,2024-01-03 04:05:06,extra",  # too long
             "99999999999999999999,2,HOME,1,,1,12,2024-01-02,,OPEN,,700,0.3,2024-01-03 04:05:06"]  # out of range
    with open(f"{root}/loans.csv", "w") as f:
        f.write("\n".join([names, *lines]) + "\n")
    text = read_text_table(spark, f"{root}/loans.csv", "loan_applications")
    good, rejected = split_malformed(text, "loan_applications")
    assert [(r["application_id"], r["applied_amount"], r["last_modified_date"]) for r in good.collect()] == [
        (1, Decimal("10.50"), dt.datetime(2024, 1, 3, 4, 5, 6))]
    assert Counter(r["reject_reason"] for r in rejected.collect()) == {
        "type:application_id": 2, "type:applied_amount": 1, "malformed": 2}
    assert all("HOME" in r["record"] for r in rejected.collect())
    assert good.count() + rejected.count() == len(lines)

    with open(f"{root}/loans.json", "w") as f:
        f.write('{"application_id": 7, "applied_amount": 1.5}\n{"application_id": \n{"application_id": "eight"}\n')
    text = read_text_table(spark, f"{root}/loans.json", "loan_applications", "json")
    good, rejected = split_malformed(text, "loan_applications")
    assert [r["application_id"] for r in good.collect()] == [7]
    assert Counter(r["reject_reason"] for r in rejected.collect()) == {"malformed": 1, "type:application_id": 1}


def test_types_that_fit_are_widened(spark):
    raw = frame(spark, "transactions", [tx(1, 2, None, None)])
    narrow = raw.withColumn("transaction_id", F.col("transaction_id").cast("int")).drop("reference")
    out = conform_checked(narrow, "transactions").first()
    assert (out["transaction_id"], out["reference"], out["reject_reason"]) == (1, None, None)


def test_sketches_unite(spark):
    rng = random.Random(2)
    rows = [(k, dt.datetime(2020, rng.randint(1, 12), 1), rng.randint(0, n)) for k, n in ((1, 30), (2, 20000), (None, 5))
            for _ in range(40000 if k == 2 else 300)] + [(3, None, None)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v long")
    sketches = monthly_sketches(df, ["k"], "t", ["v"])
    exact = {k: len({v for kk, _, v in rows if kk == k and v is not None}) for k in (1, 2, None, 3)}
    found = {r["k"]: r["v_distinct"] for r in distinct_in(sketches, ["k"], ["v"]).collect()}
    assert found.keys() == exact.keys()
    assert all(abs(found[k] - exact[k]) <= (0.05 * exact[k] if k == 2 else 0) for k in exact)
    # A part of the months, and one month added later, give what the rows of those months give.
    early = sketches.where("month < '2020-06-01'")
    late = monthly_sketches(df.where("t >= '2020-06-01'"), ["k"], "t", ["v"])
    assert {r["k"]: r["v_distinct"] for r in distinct_in(early.unionByName(late), ["k"], ["v"]).collect()} == {
        k: n for k, n in found.items() if k != 3}
