"""Quota top-k: caps per source, top rows per branch, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import text as tx


def branch_order(branch: Column, branches=None) -> Column:
    names = fv.BRANCHES if branches is None else branches
    return F.array_position(tx.lit_array(names), branch)


def top_in_group(df: DataFrame, keys: list, order: list, limit: int, name: str = "rank") -> DataFrame:
    """The first `limit` rows of each group, with their rank.

    Filtering on row_number lets Spark cut every input partition to `limit` rows per group before
    the shuffle, so a group with a third of all rows does not land in one task.
    """
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(name) <= limit)


def shortlist(
    scored: DataFrame,
    per_source: int = fv.MAX_PER_SOURCE,
    per_branch: int = fv.TOP_PER_BRANCH,
    seq: str = "seq",
) -> DataFrame:
    """At most `per_source` rows of a source, then the top `per_branch` of each branch, numbered.

    Order: score descending, arrival. Adds branch_rank and shortlist_id (branches in fixed order).
    """
    source_key = tx.word_normal(F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit(fv.NO_SOURCE)))
    order = [F.col("editorial_score").desc(), F.col(seq).asc()]
    capped = top_in_group(
        scored.withColumn("_source_key", source_key), ["editorial_branch", "_source_key"], order, per_source, "_in_source"
    )
    top = top_in_group(capped, ["editorial_branch"], order, per_branch, "branch_rank").drop("_source_key", "_in_source")
    # at most per_branch rows per branch are left, so one window over all of them is small
    place = W.orderBy(branch_order(F.col("editorial_branch")), F.col("branch_rank"))
    return top.withColumn("shortlist_id", F.row_number().over(place))


def by_branch(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The shortlist nested by branch: one row per branch, its stories in rank order."""
    item = F.struct("branch_rank", *[c for c in columns if c != "branch_rank"])
    return rows.groupBy("editorial_branch").agg(F.array_sort(F.collect_list(item)).alias("stories"))


def renumber(df: DataFrame, keys: list, order: list, name: str = "numero") -> DataFrame:
    """'01', '02', ... within each group."""
    return df.withColumn(name, F.lpad(F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("string"), 2, "0"))
