"""Merging feed rows that describe the same story, and what is counted from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import dates, text as tx
from pressroom.session import materialize


def canonical_rows(df: DataFrame, **aliases: list[str]) -> DataFrame:
    """Resolve alias chains: canonical_rows(df, title=["title", "titulo"]) -> column title."""
    present = set(df.columns)
    out = {
        name: tx.first_text(*[F.col(c) for c in chain if c in present]) if present & set(chain) else F.lit("")
        for name, chain in aliases.items()
    }
    return df.withColumns(out)


def merge_rows(rows: DataFrame, key: str = "key", seq: str = "seq") -> DataFrame:
    """One row per key.

    The first row by `seq` gives every column, but: categories_seen is the sorted union, the
    discovery window the smallest, published the first that is known. Every aggregate combines
    before the shuffle and keeps a bounded state, so a key that holds a third of all rows is fine.
    """
    special = {key, seq, "categories_seen", "discovery_window_days", "published"}
    plain = [c for c in rows.columns if c not in special]
    first = F.min_by(F.struct(*plain, F.col("categories_seen").alias("own_categories")), seq)
    window = F.coalesce(F.col("discovery_window_days"), F.lit(fv.FALLBACK_WINDOW_DAYS))
    known = F.when(F.col("published").isNotNull(), F.col(seq))
    merged = rows.groupBy(key).agg(
        F.min(seq).alias(seq),
        F.count(F.lit(1)).alias("merged_rows"),
        first.alias("first"),
        F.collect_set("categories_seen").alias("category_lists"),
        F.min(window).cast("int").alias("discovery_window_days"),
        F.min_by("published", known).alias("published"),
    )
    union = F.array_sort(F.array_distinct(F.flatten("category_lists")))
    return merged.select(
        key,
        seq,
        "merged_rows",
        *[F.col(f"first.{c}").alias(c) for c in plain],
        F.when(F.col("merged_rows") == 1, F.col("first.own_categories")).otherwise(union).alias("categories_seen"),
        "discovery_window_days",
        "published",
    )


def discovery_counts(merged: DataFrame) -> DataFrame:
    """Stories seen per branch; a story seen in two branches counts in both."""
    return merged.select(F.explode("categories_seen").alias("branch")).groupBy("branch").agg(
        F.count(F.lit(1)).alias("stories")
    )


def adaptive_window(
    rows: DataFrame,
    as_of,
    primary: int = fv.PRIMARY_WINDOW_DAYS,
    fallback: int = fv.FALLBACK_WINDOW_DAYS,
    minimum: int = fv.MIN_BRANCH_CANDIDATES,
) -> DataFrame:
    """Keep the rows of the primary window; a branch with too few distinct keys there is widened.

    Only the branches in need get the longer window. The decision table has one row per branch.
    """
    fresh = dates.in_window(F.col("published"), as_of, primary)
    stats = rows.groupBy("branch").agg(F.count_distinct(F.when(fresh, F.col("key"))).alias("fresh_keys"))
    chosen = stats.select(
        "branch", "fresh_keys", F.when(F.col("fresh_keys") < minimum, fallback).otherwise(primary).alias("window_days")
    )
    kept = rows.join(chosen, "branch").filter(
        fresh | ((F.col("window_days") == fallback) & dates.in_window(F.col("published"), as_of, fallback))
    )
    return kept.withColumn("discovery_window_days", F.when(fresh, primary).otherwise(fallback))


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows 1..n in the given total order, without one task that sees them all.

    Range-partition and sort, store, count rows per partition, add the counts of the partitions
    before. Storing first matters: range bounds are sampled and may differ on recomputation.
    """
    place = "_place"
    stored = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright(F.col(place), 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(
        F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("_part", before.alias("_before"))  # one row per partition
    local = F.col(place) - F.shiftleft(part, 33)
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + local + 1)
        .drop("_part", "_before", place)
    )


def candidate_ids(merged: DataFrame, seq: str = "seq") -> DataFrame:
    """Newest first, undated last, ties in arrival order; numbered from 1."""
    return number_rows(merged, [F.col("published").desc_nulls_last(), F.col(seq).asc()], "candidate_id")
