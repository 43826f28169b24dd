"""Token-set similarity of short texts, split into a closed form and a character-level rest.

For two sets of words let S be the common words, A and B the remainders, each sorted and joined by
blanks. The ratio is 100 when S is not empty and A or B is; else the best of three: S against S+A
and S against S+B, which need only lengths, and S+A against S+B, which needs the longest common
subsequence of A and B. The last is the expensive one and is only asked for where the other two
and a length bound leave the answer open.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType

from pressroom.functions.pairwise import subsequence


def joined(tokens: Column) -> Column:
    return F.array_join(F.array_sort(tokens), " ")


def _length(tokens: Column) -> Column:
    """Length of the blank-joined tokens."""
    chars = F.aggregate(tokens, F.lit(0), lambda acc, w: acc + F.length(w) + 1)
    return F.greatest(chars - 1, F.lit(0))


def set_parts(a: Column, b: Column) -> Column:
    """Struct of the joined remainders and the lengths the ratio is made of."""
    only_a, only_b = F.array_except(a, b), F.array_except(b, a)
    return F.struct(
        _length(F.array_intersect(a, b)).alias("s"),
        joined(only_a).alias("only_a"),
        joined(only_b).alias("only_b"),
    )


def _sides(parts: Column) -> tuple[Column, Column, Column, Column]:
    s = parts["s"]
    gap = F.when(s > 0, 1).otherwise(0)
    return s, gap, s + gap + F.length(parts["only_a"]), s + gap + F.length(parts["only_b"])


def closed_ratio(parts: Column) -> Column:
    """The ratio as far as lengths alone decide it (a lower bound of the ratio)."""
    s, gap, left, right = _sides(parts)

    def near(whole: Column) -> Column:
        return 100.0 - 100.0 * (whole - s) / (s + whole)

    contained = (s > 0) & ((F.length(parts["only_a"]) == 0) | (F.length(parts["only_b"]) == 0))
    return (
        F.when((left == 0) | (right == 0), 0.0)
        .when(contained, 100.0)
        .when(s > 0, F.greatest(near(left), near(right)))
        .otherwise(0.0)
    )


def ratio_bound(parts: Column) -> Column:
    """An upper bound of the third term: the shorter remainder lies wholly inside the longer."""
    _, _, left, right = _sides(parts)
    total = left + right
    return F.when(total == 0, 0.0).otherwise(100.0 - 100.0 * F.abs(left - right) / total)


def rest_ratio(parts: Column, common: Column) -> Column:
    """The third term, given the longest common subsequence of the remainders."""
    _, _, left, right = _sides(parts)
    distance = F.length(parts["only_a"]) + F.length(parts["only_b"]) - 2 * common
    total = left + right
    return F.when(total == 0, 0.0).otherwise(100.0 - 100.0 * distance / total)


@F.pandas_udf(IntegerType())
def common_subsequence(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest common subsequence of two texts; 0 where either is null (not asked for)."""
    return pd.Series(
        [0 if x is None or y is None else subsequence(x, y) for x, y in zip(a, b)], dtype="int32"
    )


# Declared nondeterministic on purpose: Spark then keeps filters on its result above it, instead of
# pushing them down and repeating the set arithmetic for every use in the condition.
_common = common_subsequence.asNondeterministic()


def with_ratio(df: DataFrame, parts: str, name: str) -> DataFrame:
    """Add the exact ratio. The subsequence is skipped where the closed form already settles it."""
    p = F.col(parts)
    staged = df.withColumn("_closed", closed_ratio(p)).withColumn("_ask", F.col("_closed") < ratio_bound(p))
    staged = staged.withColumn("_lcs", _common(F.when(F.col("_ask"), p["only_a"]), F.when(F.col("_ask"), p["only_b"])))
    full = F.when(F.col("_ask"), F.greatest(F.col("_closed"), rest_ratio(p, F.col("_lcs")))).otherwise(F.col("_closed"))
    return staged.withColumn(name, full).drop("_closed", "_ask", "_lcs")


def with_ratio_test(df: DataFrame, parts: str, limit: str, settled: str, name: str) -> DataFrame:
    """Add `name`: already settled, or ratio >= limit, exactly.

    The subsequence is computed only for pairs it can decide.
    """
    p, at_least = F.col(parts), F.col(limit)
    staged = df.withColumn("_yes", F.col(settled) | (closed_ratio(p) >= at_least))
    staged = staged.withColumn("_ask", ~F.col("_yes") & (ratio_bound(p) >= at_least))
    staged = staged.withColumn("_lcs", _common(F.when(F.col("_ask"), p["only_a"]), F.when(F.col("_ask"), p["only_b"])))
    hit = F.col("_yes") | (F.col("_ask") & (rest_ratio(p, F.col("_lcs")) >= at_least))
    return staged.withColumn(name, hit).drop("_yes", "_ask", "_lcs")


def containment(a: Column, b: Column) -> Column:
    """|A and B| / min(|A|, |B|); 0 when either is empty."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / smaller)
