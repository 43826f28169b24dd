"""Usage ledger: call cost, monthly totals, budget level, admission of a call."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import dates
from pressroom.operators import merge
from pressroom.session import materialize


def call_cost(model: Column, input_tokens: Column, output_tokens: Column, cached_tokens: Column | None = None,
              prices: dict | None = None) -> Column:
    """USD of a call: uncached input, cached input and output at their prices; unknown model: error."""
    prices = fv.PRICES if prices is None else prices
    cached = F.lit(0) if cached_tokens is None else cached_tokens.cast("bigint")

    def rate(kind: str) -> Column:
        out = None
        for name, table in prices.items():
            out = F.when(model == name, table[kind]) if out is None else out.when(model == name, table[kind])
        return out.otherwise(F.raise_error(F.concat(F.lit("Modelo sin precio configurado: "), model)).cast("double"))

    fresh = F.greatest(input_tokens.cast("bigint") - cached, F.lit(0))
    return (
        fresh / F.lit(1_000_000) * rate("input")
        + cached / F.lit(1_000_000) * rate("cached_input")
        + output_tokens.cast("bigint") / F.lit(1_000_000) * rate("output")
    )


def monthly_totals(ledger: DataFrame, by: list | None = None) -> DataFrame:
    """Calls and spend per local month (sums are combined before the shuffle)."""
    keys = [dates.month_key(F.col("ts")).alias("month"), *(by or [])]
    return ledger.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"), F.sum(F.col("cost_usd").cast("decimal(28,9)")).cast("double").alias("spent_usd")
    )


def budget_level(spent: Column, budget: dict | None = None) -> Column:
    b = fv.BUDGET if budget is None else budget
    return (
        F.when(spent >= b["internal_stop_usd"], "STOP")
        .when(spent >= b["critical_usd"], "CRITICO")
        .when(spent >= b["warning_usd"], "ADVERTENCIA")
        .otherwise("NORMAL")
    )


def with_budget(totals: DataFrame, budget: dict | None = None) -> DataFrame:
    b = fv.BUDGET if budget is None else budget
    return totals.withColumns({
        "level": budget_level(F.col("spent_usd"), b),
        "remaining_usd": F.greatest(F.lit(b["internal_stop_usd"]) - F.col("spent_usd"), F.lit(0.0)),
    })


def admit(requests: DataFrame, totals: DataFrame, budget: dict | None = None, margin: float = 0.01) -> DataFrame:
    """Judge each request against what its month has spent: worst-case cost plus a margin must fit.

    `requests` have month, model, input_tokens and max_output_tokens; `totals` has a row per month.
    """
    b = fv.BUDGET if budget is None else budget
    reserve = call_cost(F.col("model"), F.col("input_tokens"), F.col("max_output_tokens")) + margin
    known = requests.join(totals.select("month", "spent_usd"), "month", "left").withColumns({
        "spent_usd": F.coalesce("spent_usd", F.lit(0.0)), "reserve_usd": reserve,
    })
    projected = known.withColumn("projected_usd", F.col("spent_usd") + F.col("reserve_usd"))
    stop = b["internal_stop_usd"]
    return projected.withColumn("admitted", (F.col("spent_usd") < stop) & (F.col("projected_usd") <= stop))


# --- a queue of requests ---------------------------------------------------------------------------

QUEUE_CHUNK = 50_000
NANO = 1_000_000_000  # amounts are whole billionths of a dollar, so that sums do not depend on their order


def _walk(stop: int):
    def walk(key: tuple, chunk: pa.Table) -> pa.Table:
        """The requests of a chunk one by one, from the amount spent before it."""
        chunk = chunk.sort_by("place")
        reserve, cost = (chunk.column(c).to_pylist() for c in ("reserve", "cost"))
        spent, before, admitted = chunk.column("start")[0].as_py(), [], []
        for r, c in zip(reserve, cost):
            before.append(spent)
            admitted.append(spent < stop and spent + r <= stop)
            if admitted[-1]:
                spent += c
        out = chunk.select(["month", "chunk", "place", "start"])
        return out.append_column("before", pa.array(before, pa.int64())).append_column("admitted", pa.array(admitted, pa.bool_()))

    return walk


def admit_queue(requests: DataFrame, totals: DataFrame | None = None, budget: dict | None = None, margin: float = 0.01, id: str = "id",
                chunk: int = QUEUE_CHUNK) -> DataFrame:
    """Judge a queue of requests in the order of ts, then id: an admitted call spends its cost, a blocked one spends nothing.

    Rows need month, ts, id (unique), model, input_tokens, max_output_tokens and cost_usd, what the call costs once made; `totals` has
    what months have spent before. Adds reserve_usd, spent_usd (before the request), projected_usd and admitted.

    A month is cut into chunks of bounded size, and all that passes from one to the next is the amount spent. Each round walks the
    chunks whose starting amount changed, and adds up what the chunks admit to new starting amounts; it ends when none changes. The first chunk with a
    wrong start is right a round later, so the end is the plain walk's result; months below their stop need two rounds.
    """
    b = fv.BUDGET if budget is None else budget
    nano = lambda usd: F.round(usd * NANO).cast("bigint")
    reserve = call_cost(F.col("model"), F.col("input_tokens"), F.col("max_output_tokens")) + margin
    queue = requests.withColumns({"reserve": nano(reserve), "cost": nano(F.col("cost_usd"))})
    queue = materialize(merge.number_rows(queue, [F.col("month"), F.col("ts"), F.col(id)], "_n"), "queue")
    first = queue.groupBy("month").agg(F.min("_n").alias("_first"))  # a row per month: broadcast, so that no task reads a whole month
    place = F.col("_n") - F.col("_first")
    queue = materialize(queue.join(F.broadcast(first), "month").withColumns({"place": place, "chunk": F.floor(place / chunk)}).drop("_n", "_first"), "queue-placed")
    opening = F.lit(0).cast("bigint")
    chunks = queue.groupBy("month", "chunk").agg(F.sum("cost").alias("spends")).withColumn("opening", opening)
    if totals is not None:
        known = totals.groupBy("month").agg(F.sum(nano(F.col("spent_usd"))).alias("_known"))
        chunks = chunks.join(known, "month", "left").withColumn("opening", F.coalesce("_known", opening)).drop("_known")
    chunks = materialize(chunks, "queue-chunks")  # first guess: every call is made
    earlier = W.partitionBy("month").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)  # a row per chunk
    walked, schema = None, "month string, chunk bigint, place bigint, start bigint, before bigint, admitted boolean"
    while True:
        starts = chunks.withColumn("start", F.col("opening") + F.coalesce(F.sum("spends").over(earlier), F.lit(0)))
        if walked is not None:
            done = walked.select("month", "chunk", "start").distinct()
            due = materialize(starts.join(done, ["month", "chunk", "start"], "left_anti"), "queue-due")
            if due.isEmpty():
                break
            kept = walked.join(due.select("month", "chunk"), ["month", "chunk"], "left_anti")
        else:
            due, kept = starts, None
        again = queue.select("month", "chunk", "place", "reserve", "cost").join(due.select("month", "chunk", "start"), ["month", "chunk"])
        again = again.groupBy("month", "chunk").applyInArrow(_walk(round(b["internal_stop_usd"] * NANO)), schema)
        walked = materialize(again if kept is None else again.unionByName(kept), "queue-walked")
        spent = walked.filter("admitted").select("month", "place").join(queue.select("month", "place", "chunk", "cost"), ["month", "place"])
        spent = spent.groupBy("month", "chunk").agg(F.sum("cost").alias("_spends"))
        chunks = materialize(chunks.join(spent, ["month", "chunk"], "left").withColumn("spends", F.coalesce("_spends", F.lit(0))).drop("_spends"), "queue-chunks")
    out = queue.drop("chunk").join(walked.select("month", "place", "before", "admitted"), ["month", "place"])
    usd = lambda c: c / F.lit(NANO)
    return out.withColumns({
        "reserve_usd": usd(F.col("reserve")), "spent_usd": usd(F.col("before")), "projected_usd": usd(F.col("before") + F.col("reserve")),
    }).drop("place", "reserve", "cost", "before")
