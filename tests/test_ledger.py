"""A queue of requests against a plain walk over it."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pressroom import fixed_values as fv
from pressroom.operators import ledger


def walk(rows, opening, stop):
    """rows: (month, ts, id, reserve, cost) in billionths; what is spent before each, and whether it is admitted."""
    spent, out = defaultdict(int, opening), {}
    for month, _, ident, reserve, cost in sorted(rows):
        fits = spent[month] < stop and spent[month] + reserve <= stop
        out[ident] = (spent[month], fits)
        spent[month] += cost * fits
    return out


@pytest.mark.parametrize("n, chunk, stop", [(100_000, 20_000, 300.0), (3_000, 150, 5.0), (400, 1, 0.5), (50, 50_000, 0.0)])
def test_queue_equals_plain_walk(spark, n, chunk, stop):
    rng = random.Random(n)
    model = next(iter(fv.PRICES))
    rows = [(f"2024-0{1 + (i % 3 == 2) + (i % 7 == 0)}", rng.randrange(n // 2), i, model, rng.randrange(100_000 if i % 5 else 500), rng.randrange(10, 3_000), rng.random() * 0.02) for i in range(n)]
    df = spark.createDataFrame(rows, "month string, ts int, id int, model string, input_tokens long, max_output_tokens long, cost_usd double")
    totals = spark.createDataFrame([("2024-01", stop / 3), ("2024-09", 1.0)], "month string, spent_usd double")
    price = fv.PRICES[model]
    reserve = lambda r: round((r[4] / 1e6 * price["input"] + r[5] / 1e6 * price["output"] + 0.01) * 1e9)
    want = walk([(r[0], r[1], r[2], reserve(r), round(r[6] * 1e9)) for r in rows], {"2024-01": round(stop / 3 * 1e9)}, round(stop * 1e9))
    out = ledger.admit_queue(df, totals, {**fv.BUDGET, "internal_stop_usd": stop}, chunk=chunk)
    got = {r.id: (round(r.spent_usd * 1e9), r.admitted) for r in out.select("id", "spent_usd", "admitted").collect()}
    assert got == want
    if stop > 1:
        assert {a for _, a in got.values()} == {True, False}


def test_empty_queue(spark):
    df = spark.createDataFrame([], "month string, ts int, id int, model string, input_tokens long, max_output_tokens long, cost_usd double")
    assert ledger.admit_queue(df).filter(F.col("admitted")).count() == 0


def test_no_task_of_a_queue_reads_a_whole_month(spark, monkeypatch):
    plans, real = {}, ledger.materialize
    monkeypatch.setattr(ledger, "materialize", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and real(df, name))
    calls = spark.range(50).select("id", F.timestamp_seconds("id").alias("ts"), F.concat(F.lit("2024-0"), F.col("id") % 2 + 1).alias("month"), F.lit("gpt-5.6-terra").alias("model"),
                                   F.lit(10).alias("input_tokens"), F.lit(10).alias("max_output_tokens"), F.lit(0.1).alias("cost_usd"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert ledger.admit_queue(calls, chunk=7).count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [month" in plans["queue-placed"]
