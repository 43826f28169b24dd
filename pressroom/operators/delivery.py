"""Delivery checks: expected against found and delivered pieces, asset audits, the run guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.functions import text as tx


def expected_keys(numbers: list[str]) -> list[str]:
    """The cover, one piece per story, the closing piece."""
    return ["00", *numbers, f"{len(numbers) + 1:02d}"]


def reconcile(pieces: DataFrame, run: str, expected: list[str], key: str = "key", delivered: str = "delivered") -> DataFrame:
    """Per run: pieces expected, found and delivered, the missing keys, and whether it is complete.

    Sets of keys are limited to the expected ones, so the state per run is small whatever its size.
    """
    keys = tx.lit_array(expected)
    known = pieces.filter(F.col(key).isin(*expected))
    sets = known.groupBy(run).agg(
        F.collect_set(key).alias("found"), F.collect_set(F.when(F.col(delivered), F.col(key))).alias("sent")
    )
    missing = F.array_except(keys, "found")
    return sets.select(
        run, F.lit(len(expected)).cast("bigint").alias("expected"), F.size("found").cast("bigint").alias("found"),
        F.size("sent").cast("bigint").alias("delivered"), F.array_join(missing, ",").alias("missing"),
        F.array_join(F.array_except(keys, "sent"), ",").alias("undelivered"),
        ((F.size("sent") == len(expected)) & (F.size(missing) == 0)).alias("complete"),
    )


def not_exactly_one(pieces: DataFrame, run: str, expected: list[str], key: str = "key") -> DataFrame:
    """(run, key, pieces) for expected keys that have no piece or several."""
    runs = pieces.select(run).distinct().withColumn(key, F.explode(tx.lit_array(expected)))
    counts = pieces.groupBy(run, key).agg(F.count(F.lit(1)).alias("pieces"))
    return runs.join(counts, [run, key], "left").select(run, key, F.coalesce("pieces", F.lit(0)).alias("pieces")).filter("pieces <> 1")


def image_verdict(n_bytes: Column, width: Column, height: Column, min_bytes: int = 20_000, min_width: int = 600,
                  min_height: int = 338) -> Column:
    """'ok' or what is wrong with a story image."""
    size = F.concat(width.cast("string"), F.lit("x"), height.cast("string"))
    return (
        F.when(n_bytes.isNull(), "archivo inexistente")
        .when(n_bytes < min_bytes, F.concat(F.lit("archivo demasiado pequeño: "), n_bytes.cast("string"), F.lit(" bytes")))
        .when(width.isNull() | height.isNull(), "imagen inválida")
        .when((width < min_width) | (height < min_height), F.concat(F.lit("dimensiones insuficientes: "), size))
        .otherwise("ok")
    )


def piece_verdict(n_bytes: Column, fmt: Column, width: Column, height: Column, target=(1080, 1350), min_bytes: int = 10_000) -> Column:
    """'ok' or what is wrong with a finished piece."""
    size = F.concat(width.cast("string"), F.lit("x"), height.cast("string"))
    return (
        F.when(n_bytes.isNull(), "archivo inexistente")
        .when(n_bytes < min_bytes, "archivo demasiado pequeno")
        .when(fmt != "PNG", F.concat(F.lit("formato "), fmt))
        .when((width != target[0]) | (height != target[1]), F.concat(size, F.lit(f"; se esperaba {target[0]}x{target[1]}")))
        .otherwise("ok")
    )


def runs_to_do(runs: DataFrame, log: DataFrame, key: str = "date") -> DataFrame:
    """Runs the log does not have as completed."""
    done = log.filter("status = 'completed'").select(key).distinct()
    return runs.join(done, key, "left_anti")


def mark_completed(runs: DataFrame, log: DataFrame, at: str, key: str = "date") -> DataFrame:
    """The log (key, status, completed_at) with a row for each run that it does not have as completed.

    Running it again with its own result changes nothing.
    """
    new = runs_to_do(runs.select(key).distinct(), log, key)
    stamped = new.select(key, F.lit("completed").alias("status"), F.lit(at).cast("timestamp").alias("completed_at"))
    return log.select(key, "status", "completed_at").unionByName(stamped)


def status_counts(rows: DataFrame, status: str, names: dict[str, str], by: list[str] = ()) -> DataFrame:
    """Rows per status and `total`, in each group of `by`; `names` gives the column of a status.

    Null and unnamed statuses count in the total only.
    """
    counts = [F.count_if(F.col(status) == value).alias(name) for value, name in names.items()]
    return rows.groupBy(*by).agg(*counts, F.count(F.lit(1)).alias("total"))
