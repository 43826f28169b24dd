"""Contracts of selections and batches as tables of violations; the caller decides what to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import text as tx


def _found(rule: str, cond: Column, detail: Column, severity: str = "error") -> Column:
    return F.when(cond, F.struct(F.lit(rule).alias("rule"), detail.alias("detail"), F.lit(severity).alias("severity")))


def _listed(df: DataFrame, keys: list[str], checks: list[Column]) -> DataFrame:
    out = df.select(*keys, F.array_compact(F.array(*checks)).alias("found"))
    return out.select(*keys, F.inline_outer("found")).filter("rule is not null")


def choice_violations(chosen: DataFrame, candidates: DataFrame, batch: str, count: int = fv.FINAL_COUNT,
                      least: int = 1, most: int = 3, branches=None, taken: DataFrame | None = None) -> DataFrame:
    """What is wrong with the stories chosen per batch: (batch, rule, detail, severity).

    Wrong number; an id twice; an id that is no candidate, changed its branch, or (reserves) is
    taken already; a branch outside its limits. `least` = `most` = 2 is the reserve contract.
    """
    branches = fv.BRANCHES if branches is None else branches
    known = candidates.groupBy("candidate_id").agg(F.max("editorial_branch").alias("_branch"))
    rows = chosen.join(known, "candidate_id", "left")
    if taken is None:
        rows = rows.withColumn("_taken", F.lit(False))
    else:
        used = taken.select(batch, "candidate_id").distinct().withColumn("_taken", F.lit(True))
        rows = rows.join(used, [batch, "candidate_id"], "left").withColumn("_taken", F.coalesce("_taken", F.lit(False)))
    ident = F.col("candidate_id").cast("string")
    per_row = _listed(rows, [batch], [
        _found("overlap", F.col("_taken"), ident),
        _found("unknown_id", F.col("_branch").isNull(), ident),
        _found("branch_changed", F.col("_branch") != F.col("editorial_branch"),
               F.concat(ident, F.lit(": "), F.col("_branch"), F.lit(" -> "), F.col("editorial_branch"))),
    ])
    per_id = chosen.groupBy(batch, "candidate_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        batch, F.lit("duplicate_id").alias("rule"), ident.alias("detail"), F.lit("error").alias("severity")
    )
    counts = chosen.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("editorial_branch") == b).alias(b) for b in branches]
    )
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{b}="), F.col(b).cast("string")) for b in branches])
    outside = reduce(lambda a, b: a | b, [(F.col(b) < least) | (F.col(b) > most) for b in branches])
    per_batch = _listed(counts, [batch], [
        _found("count", F.col("n") != count, F.col("n").cast("string")), _found("branch_quota", outside, shown)
    ])
    return per_row.unionByName(per_id).unionByName(per_batch)


def batch_violations(stories: DataFrame, batch: str, place: str = "place", count: int = fv.FINAL_COUNT, branches=None) -> DataFrame:
    """What is wrong with finished batches: (batch, numero, rule, detail, severity).

    `place` is the 1-based position of a story in its batch. A highlight that is no literal part
    of its text is a warning; everything else is an error.
    """
    branches = fv.BRANCHES if branches is None else branches
    have = set(stories.columns)
    rows = stories.withColumns({f: F.lit(None).cast("string") for f in fv.REQUIRED_FIELDS if f not in have})

    def empty(name: str) -> Column:
        return _found("empty_field", tx.blank_if_null(F.col(name)) == "", F.lit(name))

    checks = [_found("missing_field", F.col(f).isNull(), F.lit(f)) for f in fv.REQUIRED_FIELDS]
    checks += [
        _found("numero", F.col("numero") != F.lpad(F.col(place).cast("string"), 2, "0"), F.col("numero")),
        _found("branch", ~F.col("rama").isin(*branches), F.col("rama")),
        *[empty(f) for f in ("titulo", "resumen", "categoria", "fuente", "url")],
    ]
    for marks, text in (("tituloDestacado", "titulo"), ("resumenDestacado", "resumen")):
        if dict(rows.dtypes)[marks] != "array<string>":
            continue
        parts = F.transform(F.col(marks), tx.blank_if_null)
        strange = F.filter(parts, lambda h: (h != "") & ~F.contains(tx.blank_if_null(F.col(text)), h))
        checks += [
            _found("highlight_count", ~F.size(F.col(marks)).between(1, 2), F.lit(marks)),
            _found("highlight_empty", F.exists(parts, lambda h: h == ""), F.lit(marks)),
            _found("highlight_not_literal", F.size(strange) > 0, F.concat(F.lit(f"{marks}: "), F.array_join(strange, " | ")), "warning"),
        ]
    per_row = _listed(rows, [batch, "numero"], checks)
    twice = rows.groupBy(batch, "numero").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        batch, "numero", F.lit("duplicate_numero").alias("rule"), F.col("numero").alias("detail"), F.lit("error").alias("severity")
    )
    counts = rows.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("rama") == b).alias(b) for b in branches]
    )
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{b}="), F.col(b).cast("string")) for b in branches])
    outside = reduce(lambda a, b: a | b, [~F.col(b).between(1, 3) for b in branches])
    per_batch = _listed(counts.withColumn("numero", F.lit("")), [batch, "numero"], [
        _found("count", F.col("n") != count, F.col("n").cast("string")), _found("branch_quota", outside, shown)
    ])
    return per_row.unionByName(twice).unionByName(per_batch)
