"""An equi-join that splits hot keys on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.session import materialize

HOT_ROWS = 10_000
MOST_HOT = 100_000


def hot_keys(left: DataFrame, right: DataFrame, keys: list[str], hot: int = HOT_ROWS, most: int = MOST_HOT) -> DataFrame:
    """(_key, _sl, _sr): into how many salts each side of a hot key is cut; at most `most` rows of 16 bytes.

    Counts are aggregated before the shuffle, so a hot key is one row per task. Keys are named by a 64-bit hash, so the size of the
    table does not depend on the keys' length; keys of one hash share their salts, which changes no result. If more keys are hot, the `most` with
    the most pairs are split; each of the others then has fewer than rows / most rows.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.xxhash64(*keys).alias("_key")).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > hot)

    heavy = counts(left, "_nl").join(counts(right, "_nr"), "_key", "full").select("_key", F.coalesce("_nl", F.lit(1)).alias("_nl"), F.coalesce("_nr", F.lit(1)).alias("_nr"))
    heavy = heavy.orderBy((F.col("_nl") * F.col("_nr").cast("double")).desc(), "_key").limit(most)
    return materialize(heavy.select("_key", *[F.ceil(F.col(n) / hot).cast("int").alias(s) for n, s in (("_nl", "_sl"), ("_nr", "_sr"))]), "hot-keys")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], left_id: Column, right_id: Column,
                hot: int = HOT_ROWS, how: str = "inner") -> DataFrame:
    """Inner or left join on `keys`, exact, where a key may hold a large part of either side.

    A key with n rows on one side is cut into ceil(n / hot) salts there and repeated for them on
    the other side, so a task never gets more than about `hot` x `hot` pairs of one key. The hot keys are broadcast, bounded
    by hot_keys, so rows get their salt where they are and no join sees a raw hot key.
    """
    salts = hot_keys(left, right, keys, hot)

    def side(df: DataFrame, own: str, other: str, row: Column) -> DataFrame:
        sized = df.withColumn("_key", F.xxhash64(*keys)).join(F.broadcast(salts), "_key", "left").withColumns({
            "_sl": F.coalesce("_sl", F.lit(1)), "_sr": F.coalesce("_sr", F.lit(1)),
        })
        sized = sized.withColumn(f"_salt{own}", F.pmod(F.xxhash64(row), F.col(f"_s{own}")).cast("int"))
        # in a left join the left side meets each right row once: it is not repeated, and the right one is not cut
        whole = how == "left" and own == "r"
        sized = sized.withColumn(f"_salt{own}", F.lit(0)) if whole else sized
        repeated = how != "left" or own == "r"
        sized = sized.withColumn(f"_salt{other}", F.explode(F.sequence(F.lit(0), F.col(f"_s{other}") - 1)) if repeated else F.lit(0))
        return sized.drop("_sl", "_sr", "_key")

    joined = side(left, "l", "r", left_id).join(side(right, "r", "l", right_id), [*keys, "_saltl", "_saltr"], how)
    return joined.drop("_saltl", "_saltr")
