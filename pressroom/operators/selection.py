"""Choosing stories per batch: quotas, reserves, repair and substitution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import text as tx, urls
from pressroom.operators import history as hist, merge
from pressroom.operators.ranking import branch_order, top_in_group
from pressroom.session import materialize


def first_per_branch(rows: DataFrame, batch: str, order: list[Column], each: int = 2) -> DataFrame:
    """The first `each` rows of every branch of a batch; `complete` tells if all branches have them."""
    top = top_in_group(rows.filter(F.col("editorial_branch").isin(*fv.BRANCHES)), [batch, "editorial_branch"], order, each, "place")
    whole = W.partitionBy(batch)  # at most each * branches rows are left per batch
    return top.withColumn("complete", F.count(F.lit(1)).over(whole) == each * len(fv.BRANCHES))


def quota_select(rows: DataFrame, batch: str, score: str = "editorial_score", seq: str = "seq", each: int = 2, most: int = 3) -> DataFrame:
    """Two stories per branch; one slot that a poor branch leaves goes to the best third story.

    Allowed are 2/2/2 and the 3/2/1 family. `complete` is false for batches that reach neither.
    """
    total = each * len(fv.BRANCHES)
    order = [F.col(score).desc(), F.col(seq).asc()]
    top = top_in_group(rows.filter(F.col("editorial_branch").isin(*fv.BRANCHES)), [batch, "editorial_branch"], order, most, "branch_place")
    whole = W.partitionBy(batch)  # at most `most` rows per branch are left
    spare = F.col("branch_place") > each
    ranked = top.withColumns({
        "_base": F.count_if(~spare).over(whole),
        "_extra": F.row_number().over(W.partitionBy(batch, spare).orderBy(*order)),
    })
    chosen = ranked.filter(~spare | ((F.col("_base") == total - 1) & (F.col("_extra") == 1)))
    counts = chosen.withColumns({
        "_n": F.count(F.lit(1)).over(whole),
        "_branches": F.size(F.collect_set("editorial_branch").over(whole)),
    })
    return counts.withColumn("complete", (F.col("_n") == total) & (F.col("_branches") == len(fv.BRANCHES))).drop(
        "_base", "_extra", "_n", "_branches"
    )


def judge_reserves(proposed: DataFrame, chosen: DataFrame, candidates: DataFrame, batch: str, ordinal: str = "ordinal",
                   each: int = fv.RESERVES_PER_BRANCH) -> DataFrame:
    """Proposed reserves with `kept` and, for discarded ones, the reason; first come, first kept.

    An id is taken once it is chosen or kept; of the proposals still valid, the first of each id
    competes, and the first `each` per branch are kept.
    """
    known = candidates.groupBy("candidate_id").agg(F.max("editorial_branch").alias("_branch"))
    used = chosen.select(batch, "candidate_id").distinct().withColumn("_chosen", F.lit(True))
    rows = proposed.join(known, "candidate_id", "left").join(used, [batch, "candidate_id"], "left")
    own = (
        F.when(F.col("_chosen"), "solapada o duplicada")
        .when(F.col("_branch").isNull(), "candidate_id inexistente")
        .when(F.col("_branch") != F.col("editorial_branch"), "rama alterada")
        .when(~F.col("editorial_branch").isin(*fv.BRANCHES), "rama invalida")
    )
    rows = rows.withColumn("_own", own)
    first = rows.filter("_own is null").groupBy(batch, "candidate_id").agg(
        F.min(ordinal).alias("_first"), F.min_by("editorial_branch", ordinal).alias("editorial_branch")
    )
    kept = top_in_group(first, [batch, "editorial_branch"], [F.col("_first")], each, "_place").select(
        batch, "candidate_id", F.col("_first").alias("_kept_at")
    )
    judged = rows.join(kept, [batch, "candidate_id"], "left")
    is_kept = F.coalesce(F.col("_kept_at") == F.col(ordinal), F.lit(False))
    reason = (
        F.when(is_kept, None)
        .when(F.coalesce(F.col("_kept_at") < F.col(ordinal), F.lit(False)), "solapada o duplicada")
        .otherwise(F.coalesce("_own", F.lit("cupo de rama excedido")))
    )
    return judged.withColumns({"kept": is_kept, "reason": reason}).drop("_branch", "_chosen", "_own", "_kept_at")


def fill_reserves(judged: DataFrame, chosen: DataFrame, candidates: DataFrame, batch: str, order: list[Column],
                  each: int = fv.RESERVES_PER_BRANCH) -> DataFrame:
    """Kept reserves plus, per branch, the best unused candidates up to the quota.

    Output: batch, candidate_id, editorial_branch, origin ('kept' or 'filled').
    """
    kept = judged.filter("kept").select(batch, "candidate_id", "editorial_branch")
    used = kept.select(batch, "candidate_id").union(chosen.select(batch, "candidate_id")).distinct()
    have = kept.groupBy(batch, "editorial_branch").agg(F.count(F.lit(1)).alias("_have"))
    free = candidates.filter(F.col("editorial_branch").isin(*fv.BRANCHES)).join(used, [batch, "candidate_id"], "left_anti")
    best = top_in_group(free, [batch, "editorial_branch"], order, each, "_place")
    filled = best.join(have, [batch, "editorial_branch"], "left").filter(
        F.col("_place") <= each - F.coalesce("_have", F.lit(0))
    )
    return kept.withColumn("origin", F.lit("kept")).unionByName(
        filled.select(batch, "candidate_id", "editorial_branch", F.lit("filled").alias("origin"))
    )


# --- substitution: all batches and slots at once, in rounds ---------------------------------------

CHUNK = 10_000


def place_within(rows: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Number the rows of each group 1..n by `order`; a group may span any number of tasks."""
    numbered = materialize(merge.number_rows(rows, [F.col(c) for c in (*keys, order)], "_n"), "placed")
    first = numbered.groupBy(*keys).agg(F.min("_n").alias("_first"))
    return numbered.join(first, keys).withColumn(name, F.col("_n") - F.col("_first") + 1).drop("_n", "_first")


def count_before(rows: DataFrame, keys: list[str], place: str, flag: Column, name: str, chunk: int = CHUNK) -> DataFrame:
    """Add how many rows of the group with a smaller place have the flag: counted in chunks, plus the sums of the chunks before."""
    cut = rows.withColumns({"_chunk": F.floor((F.col(place) - 1) / chunk), "_flag": flag.cast("int")})
    sums = cut.groupBy(*keys, "_chunk").agg(F.sum("_flag").alias("_sum"))
    earlier = F.coalesce(F.sum("_sum").over(W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum("_flag").over(W.partitionBy(*keys, "_chunk").orderBy(place).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    whole = cut.withColumn("_within", within).join(sums.select(*keys, "_chunk", earlier.alias("_earlier")), [*keys, "_chunk"])
    return whole.withColumn(name, F.col("_within") + F.col("_earlier")).drop("_chunk", "_flag", "_within", "_earlier")


def _first_conflict(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Add `first`: the earliest time at which a story was accepted that the row would repeat, by title or by URL."""
    accepted = rows.filter("time is not null and told")
    titles = accepted.groupBy("batch", F.col("title_id").alias("o")).agg(F.min("time").alias("_t"))
    by_title = edges.join(titles, ["batch", "o"]).groupBy("batch", F.col("n").alias("title_id")).agg(F.min("_t").alias("_by_title"))
    by_url = accepted.filter("url <> ''").groupBy("batch", "url").agg(F.min("time").alias("_by_url"))
    found = rows.join(by_title, ["batch", "title_id"], "left").join(by_url, ["batch", "url"], "left")
    return found.withColumn("first", F.when(F.col("told"), F.least("_by_title", "_by_url"))).drop("_by_title", "_by_url")


def _round(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """One round: every row's time of acceptance anew, from the times of the round before."""
    judged = _first_conflict(rows, edges).withColumns({"_before": F.col("time"), "_alive": F.col("alive")})
    judged = materialize(judged, "round-judged")
    main, spare = judged.filter("not reserve"), judged.filter("reserve")
    free = F.col("first").isNull() | (F.col("first") >= F.col("slot"))
    main = main.withColumn("alive", F.when(F.col("recovering"), F.col("healthy")).otherwise(~F.col("blocked") & free))
    main = main.withColumn("time", F.when(F.col("alive"), F.when(F.col("recovering"), 0).otherwise(F.col("slot"))))
    keys = ["batch", "branch"]
    open_slots = count_before(main, keys, "place", ~F.col("alive"), "_turn").filter("not alive").select(*keys, "_turn", F.col("slot").alias("_slot"))
    # a reserve's turn comes at the open slot that the fit reserves before it leave; it is fit if it repeats nothing accepted until then
    asked = count_before(spare, keys, "place", F.col("alive"), "_turn").join(open_slots, [*keys, "_turn"], "left")
    asked = asked.withColumn("alive", F.col("_slot").isNull() | F.col("first").isNull() | (F.col("first") >= F.col("_slot")))
    asked = asked.withColumn("time", F.when(F.col("alive"), F.col("_slot"))).drop("_turn", "_slot")
    return main.unionByName(asked)


def substitute(batches: DataFrame, batch: str, classes=None, material=None, max_rows: int | None = None,
               used: DataFrame | None = None, id: str = "seq") -> DataFrame:
    """Replace stories that repeat the history or an accepted story by a clean reserve of the branch.

    Rows need seq (order in the batch), title, link, editorial_branch, reserve (bool), blocked
    (repeats the history) and healthy (false: replace anyway, keep the healthy ones first); null flags are false. Output: a
    row per main story: batch, slot, seq of the story placed there, status 'kept' | 'replaced' |
    'no_reserve'. Only where the caller sets `max_rows` do larger batches come back undecided, as 'invalid_batch'. Reserves that
    `used` (batch, `id`) names were placed before and are not placed again.

    The rule walks a batch slot by slot: a story is kept unless it repeats one accepted before, and an open slot takes the branch's
    first reserve that is fit then. Which titles repeat which is a table of pairs (history.batch_story_pairs). All slots of all batches are
    decided at once from the times of acceptance of the round before, until a round changes nothing. A decision depends on earlier times only, so
    that state is the walk's; rounds grow with the longest chain of decisions that turn on each other, not with the rows of a batch.
    """
    if used is not None:
        placed = used.select(batch, id).distinct().withColumn("reserve", F.lit(True))
        batches = batches.join(placed, [batch, id, "reserve"], "left_anti")
    flag = lambda name: F.coalesce(F.col(name), F.lit(False)).alias(name)
    rows = materialize(batches.select(
        F.col(batch).cast("bigint").alias("batch"), F.col("seq").cast("bigint").alias("seq"), F.coalesce("editorial_branch", F.lit("\u0001")).alias("branch"),
        flag("reserve"), flag("blocked"), flag("healthy"), hist.title_id(F.col("title")).alias("title_id"), urls.canonical_url(F.col("link")).alias("url"),
        (tx.blank_if_null(F.col("title")) != "").alias("told"),
    ), "batches")
    sizes = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("_rows"), F.max(~F.col("reserve") & ~F.col("healthy")).alias("recovering"))
    if max_rows is not None:
        undecided = rows.join(sizes.filter(F.col("_rows") > max_rows), "batch", "left_semi").filter("not reserve").select(
            "batch", F.lit(None).cast("bigint").alias("slot"), "seq", F.lit("invalid_batch").alias("status")
        )
        sizes = sizes.filter(F.col("_rows") <= max_rows)
    taking_part = rows.filter("not reserve or not blocked").join(sizes.drop("_rows"), "batch")
    in_branch = place_within(taking_part, ["batch", "branch", "reserve"], "seq", "place")
    main = place_within(in_branch.filter("not reserve"), ["batch"], "seq", "slot")
    main = main.withColumn("time", F.when(~F.col("blocked"), F.col("slot")))
    spare = in_branch.filter("reserve").withColumns({"slot": F.lit(None).cast("bigint"), "time": F.lit(None).cast("bigint")})
    now = materialize(main.unionByName(spare).withColumn("alive", F.lit(True)), "round")
    edges = materialize(hist.batch_story_pairs(now.filter("told"), "batch", classes, material), "conflicts")
    while True:
        after = materialize(_round(now, edges), "round")
        changed = after.filter(~F.col("time").eqNullSafe(F.col("_before")) | (F.col("alive") != F.col("_alive")))
        now = after.drop("first", "_before", "_alive")
        if changed.isEmpty():
            break
    picks = now.filter("reserve and time is not null").select("batch", F.col("time").alias("slot"), F.col("seq").alias("_pick"))
    status = F.when(F.col("alive"), "kept").when(F.col("_pick").isNotNull(), "replaced").otherwise("no_reserve")
    decided = now.filter("not reserve").join(picks, ["batch", "slot"], "left").select(
        "batch", "slot", F.when(F.col("alive"), F.col("seq")).otherwise(F.coalesce("_pick", "seq")).alias("seq"), status.alias("status")
    )
    return decided if max_rows is None else decided.unionByName(undecided)


def batch_repeats(batches: DataFrame, batch: str, classes=None, material=None, max_rows: int | None = None) -> DataFrame:
    """Pairs of stories of one batch, earlier against later, that still tell the same story: by title, or by an equal URL."""
    rows = batches.select(
        F.col(batch).cast("bigint").alias("batch"), F.col("seq").cast("bigint").alias("seq"), hist.title_id(F.col("title")).alias("title_id"),
        urls.canonical_url(F.col("link")).alias("url"), (tx.blank_if_null(F.col("title")) != "").alias("told"),
    )
    if max_rows is not None:
        rows = rows.join(rows.groupBy("batch").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") <= max_rows), "batch", "left_semi")
    rows = materialize(rows.filter("told"), "batches")
    edges = materialize(hist.batch_story_pairs(rows, "batch", classes, material), "conflicts")
    a = rows.select("batch", F.col("title_id").alias("n"), F.col("url").alias("url"), F.col("seq").alias("earlier"))
    b = rows.select("batch", F.col("title_id").alias("o"), F.col("url").alias("url"), F.col("seq").alias("later"))
    by_title = edges.join(a.drop("url"), ["batch", "n"]).join(b.drop("url"), ["batch", "o"])
    by_url = a.filter("url <> ''").join(b, ["batch", "url"])
    pairs = by_title.select("batch", "earlier", "later").unionByName(by_url.select("batch", "earlier", "later"))
    return pairs.filter("earlier < later").distinct()


def latest_rows(history: DataFrame, count: int = 30, seq: str = "hist_seq") -> DataFrame:
    """The last rows of the history, by a distributed top-k."""
    return history.orderBy(F.col(seq).desc()).limit(count)


def combined_order(rows: DataFrame, batch: str) -> DataFrame:
    """Stories of a batch in branch order, numbered '01', '02', ..."""
    place = F.row_number().over(W.partitionBy(batch).orderBy(branch_order(F.col("editorial_branch")), "place"))
    return rows.withColumn("numero", F.lpad(place.cast("string"), 2, "0"))
