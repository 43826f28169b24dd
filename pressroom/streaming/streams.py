"""The stateful rules on streams: de-duplication, spend windows, the history registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import dates
from pressroom.operators import history as hist, ledger as lg
from pressroom.sources import versions


def dedupe_stream(rows: DataFrame, key: str = "key", published: str = "published", arrived: str = "arrived") -> DataFrame:
    """First row per key within the look-back window; later than the window is late and dropped.

    Undated rows count from their arrival, because a row without an event time would be dropped.
    """
    window = f"{fv.PRIMARY_WINDOW_DAYS} days {fv.WINDOW_GRACE_HOURS} hours"
    timed = rows.withColumn("event_time", F.coalesce(published, arrived))
    return timed.withWatermark("event_time", window).dropDuplicatesWithinWatermark([key])


def spend_windows(calls: DataFrame, length: str = "1 day", late: str | None = None) -> DataFrame:
    """Calls and spend per tumbling window and model; `calls` have ts, model and cost_usd.

    Every call counts, however late: the state is one row per window and model. Only a caller who names `late`
    closes windows after that time and leaves later calls out.
    """
    timed = calls if late is None else calls.withWatermark("ts", late)
    grouped = timed.groupBy(F.window("ts", length), "model")
    return grouped.agg(
        F.count(F.lit(1)).alias("calls"), F.sum(F.col("cost_usd").cast("decimal(28,9)")).cast("double").alias("spent_usd")
    ).select(F.col("window.start").alias("start"), "model", "calls", "spent_usd")


def with_alert(spend: DataFrame, budget: dict | None = None) -> DataFrame:
    return spend.withColumn("level", lg.budget_level(F.col("spent_usd"), budget))


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append-mode stream over all that is there into a Parquet table and return the table."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_updates(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Run an aggregating stream in update mode and return the latest row per key.

    Each micro-batch goes to its own folder, so a repeated batch replaces itself.
    """
    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = stream.sparkSession.read.parquet(path)
    value = F.struct(*[c for c in stream.columns if c not in keys])
    return rows.groupBy(*keys).agg(F.max_by(value, "batch").alias("v")).select(*keys, "v.*")


MERGE_AT = 16


def register_stream(news: DataFrame, start: DataFrame, path: str, checkpoint: str, as_of, today: str, seq: str = "seq", merge_at: int = MERGE_AT) -> DataFrame:
    """Enter a stream of stories into the history, batch by batch, and return the registry.

    The registry is a versioned table with a folder per day. A batch reads today's folders only, writes its new rows to a folder
    of its own and then the manifest of the next version, so what it moves does not grow with the history. Days past the retention leave the
    manifest; today's folders become one when there are `merge_at`. Batch n starts from version n: run again after a failure it
    finds the same version and writes the same result. Versions but the last two are deleted with what only they name.
    """
    spark = news.sparkSession
    schema = start.select(*hist.COLUMNS).schema
    if versions.newest(spark, path)[0] < 0:
        first = hist.prune_history(start, as_of).select(*hist.COLUMNS, F.date_format(dates.day_of(F.col("date")), "yyyy-MM-dd").alias("day"))
        first.write.mode("overwrite").partitionBy("day").parquet(f"{path}/data/start")
        days = [r.day for r in first.select("day").distinct().collect()]  # at most the days of the retention
        versions.switch(spark, path, 0, [(day, f"{path}/data/start/day={day}") for day in days])

    def enter(batch: DataFrame, number: int) -> None:
        parts = versions.newest(spark, path, until=number)[1]
        oldest = spark.range(1).select(F.date_format(F.date_sub(F.lit(today).cast("date"), fv.KEEP_DAYS), "yyyy-MM-dd")).first()[0]
        mine = [folder for day, folder in parts if day == today]
        have = versions.read_folders(spark, mine, schema)
        added = hist.new_entries(batch, have.filter(F.col("date") == today), today, seq)
        folder = f"{path}/data/batch={number}"
        merging = len(mine) >= merge_at
        (have.unionByName(added) if merging else added).write.mode("overwrite").parquet(folder)
        kept = [(day, f) for day, f in parts if day >= oldest and not (merging and day == today)]
        versions.switch(spark, path, number + 1, [*kept, (today, folder)])
        versions.forget(spark, path)

    query = (
        news.writeStream.foreachBatch(enter).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return versions.published(spark, path, schema)
