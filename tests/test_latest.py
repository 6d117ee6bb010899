"""First / last per key against brute force, with one key holding 40 % of rows."""

import random

import pandas as pd

from shoplake.operators.latest import earliest_per_key, flag_first_per_key, latest_per_key


def _data(spark, n=4000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 50)}"
        rows.append((k, rnd.randint(0, 500), seq, rnd.random()))
    return rows, spark.createDataFrame(rows, "k string, ts bigint, seq bigint, v double")


def test_flag_first_per_key(spark):
    rows, df = _data(spark)
    got = {r.seq for r in flag_first_per_key(df, ["k"], ["ts", "seq"]).where("is_first").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "ts", "seq", "v"]).sort_values(["ts", "seq"])
    want = set(pdf.groupby("k").head(1)["seq"])
    assert got == want
    assert flag_first_per_key(df, ["k"], ["ts", "seq"]).count() == len(rows)


def test_earliest_and_latest_per_key(spark):
    rows, df = _data(spark)
    pdf = pd.DataFrame(rows, columns=["k", "ts", "seq", "v"])
    first = {r.k: r.seq for r in earliest_per_key(df, ["k"], ["ts", "seq"]).collect()}
    want_first = pdf.sort_values(["ts", "seq"]).groupby("k").head(1).set_index("k")["seq"].to_dict()
    assert first == want_first
    last = {r.k: (r.seq, r.v) for r in latest_per_key(df, ["k"], "seq").collect()}
    lp = pdf.sort_values("seq").groupby("k").tail(1).set_index("k")
    assert last == {k: (int(r.seq), r.v) for k, r in lp.iterrows()}


def test_first_flag_is_a_hash_aggregate(spark):
    df = spark.createDataFrame([("a", 5, 2), ("a", 5, 1), ("a", -7, -3), ("b", 1, 9)], "k string, ts bigint, seq bigint")
    out = flag_first_per_key(df, ["k"], ["ts", "seq"])
    assert {(r.k, r.ts, r.seq) for r in out.where("is_first").collect()} == {("a", -7, -3), ("b", 1, 9)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
