"""Stage outputs: overwritten tables, nested and split outputs, snapshots before an overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressroom.operators.history import split_blocked
from pressroom.operators.ranking import by_branch
from pressroom.session import materialize
from pressroom.sources import versions


def overwrite(df: DataFrame, path: str, run_id: str) -> int:
    """Replace a stage table: the rows are written beside the old ones and then become the newest version.

    df may read the table itself. A write that fails leaves the old version readable. Returns the version's number.
    """
    return versions.publish(df, path, run_id)


def stage_table(spark: SparkSession, path: str, schema, run_id: str | None = None) -> DataFrame:
    """The newest version of a stage table, or the snapshot that a run left."""
    return versions.published(spark, path, schema, run_id)


def write_shortlist(rows: DataFrame, path: str, nested_path: str, columns: list[str]) -> None:
    """The flat shortlist, and the same rows nested by branch."""
    stored = materialize(rows, "shortlist")
    stored.write.mode("overwrite").json(path)
    by_branch(stored, columns).write.mode("overwrite").json(nested_path)


def write_split(classified: DataFrame, history: DataFrame, kept_path: str, blocked_path: str) -> None:
    """Kept candidates, and blocked ones with reason and matched story."""
    kept, blocked = split_blocked(materialize(classified, "classified"), history)
    kept.write.mode("overwrite").json(kept_path)
    blocked.write.mode("overwrite").json(blocked_path)
