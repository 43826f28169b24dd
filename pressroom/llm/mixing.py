"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sizes are counted once and stored; all later steps see numbers only. Targets come from water-filling rounds
(one small aggregate each), blocks go to sources by highest quotients, and each source's quota goes on to its
shards the same way. A source is cut into shards of a bounded number of words by a seeded hash, so a source with a
third of all rows is many windows, not one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom.operators.merge import number_rows
from pressroom.llm.words import numbered, stored, unused
from pressroom.session import materialize

BLOCK_WORDS = 8
SHARD_WORDS = 50_000
MOST_SHARDS = 16_384
WEIGHTS = (5.0, 2.0, 1.0)
NULL_LAST = "_null"


def size_of(text: Column) -> Column:
    """Number of words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, weights: tuple[float, ...] = WEIGHTS, most: float = 2.0) -> DataFrame:
    """sources (source, source_size) with weight and target.

    Sources in code point order, null last, weigh `weights` in turn and share `share` x all words; a target stops
    at `most` x its source's size and the excess goes to the others by weight until none is above.
    """
    order = [F.col("source").isNull().asc(), F.encode("source", "UTF-8").asc()]
    ranked = number_rows(sources.select("source", "source_size"), order, "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    rows = materialize(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("_cap")), "mix-sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, F.lit(False)
    while total:  # each round caps at least one more source, usually all of them within a few rounds
        capped, weight_left, n = rows.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)), F.sum(full.cast("long")),
        ).first()
        if not weight_left:
            break
        level = (share * total - capped) / weight_left
        full = F.col("weight") * level > F.col("_cap")
        if rows.agg(F.sum(full.cast("long"))).first()[0] == n:
            break
    return rows.select("source", "source_size", "weight", F.when(full, F.col("_cap")).otherwise(F.col("weight") * level).alias("target"))


def apportion(rows: DataFrame, share: Column, seats: int, order: Column) -> DataFrame:
    """rows with `_seats`: `seats` seats by the highest quotients share / (2k + 1), ties by `order`.

    Most seats follow from bounds of the divisor; only the few quotients between the bounds are ranked. Their
    number is at most three for each row.
    """
    rows = rows.withColumn("_share", share)
    total, n = rows.agg(F.coalesce(F.sum("_share"), F.lit(0.0)), F.sum((F.col("_share") > 0).cast("long"))).first()
    if not total or seats <= 0:
        return rows.withColumn("_seats", F.lit(0).cast("long")).drop("_share")
    least = F.when(F.lit(seats - n / 2 > 0), F.greatest(F.floor(F.col("_share") * max(seats - n / 2, 0.0) / total + 0.5) - 1, F.lit(0))).otherwise(0).cast("long")
    most = (F.floor(F.col("_share") * (seats + n / 2) / total + 0.5) + 1).cast("long")
    sure = materialize(rows.withColumns({"_least": least, "_most": F.when(F.col("_share") > 0, most).otherwise(0)}).withColumn("_key", order), "mix-seats")
    given = sure.agg(F.sum("_least")).first()[0]
    open_seats = sure.filter(F.col("_most") > F.col("_least")).select(
        "_key", "_share", F.explode(F.sequence("_least", F.col("_most") - 1)).alias("_k"),
    )
    won = (
        open_seats.withColumn("_quotient", F.col("_share") / (2 * F.col("_k") + 1))
        .orderBy(F.col("_quotient").desc(), "_key", "_k").limit(max(seats - given, 0))
        .groupBy("_key").agg(F.count(F.lit(1)).alias("_won"))
    )
    return sure.join(won, "_key", "left").withColumn("_seats", F.col("_least") + F.coalesce("_won", F.lit(0))).drop("_least", "_most", "_won", "_key", "_share")


def shard_quotas(shards: DataFrame, block_words: int) -> DataFrame:
    """shards (_source, _shard, _words, _quota of the source, source_size) with `_blocks`, by highest quotients within each source."""
    own = W.partitionBy("_source")
    rows = shards.withColumn("_n", F.count(F.lit(1)).over(own))
    share = F.col("_quota") * F.col("_words") / F.col("source_size")
    low = F.when(F.col("_quota") > F.col("_n") / 2, (F.col("_quota") - F.col("_n") / 2) * F.col("_words") / F.col("source_size")).otherwise(0.0)
    high = (F.col("_quota") + F.col("_n") / 2) * F.col("_words") / F.col("source_size")
    rows = rows.withColumns({
        "_least": F.greatest(F.floor(low + 0.5) - 1, F.lit(0)), "_most": F.floor(high + 0.5) + 1, "_fair": share,
    }).withColumn("_open", F.col("_quota") - F.sum("_least").over(own))
    seats = rows.withColumn("_k", F.explode(F.sequence("_least", "_most")))
    rank = F.row_number().over(own.orderBy((F.col("_fair") / (2 * F.col("_k") + 1)).desc(), "_shard", "_k"))
    taken = F.sum((F.col("_rank") <= F.col("_open")).cast("long"))
    return seats.withColumn("_rank", rank).groupBy("_source", "_shard").agg(
        (F.first("_least") + taken).alias("_blocks"), F.first("_words").alias("_words"),
    ).withColumn("_take", F.least(F.col("_blocks") * block_words, 2 * F.col("_words")))


def with_place(sized: DataFrame) -> DataFrame:
    """sized (_row, _same and others) with `_place`, the number of a row among those with its `_same`, from 0.

    Few rows are repeated, and only those are numbered; by range of hash and row, so one row repeated many times is no hot task.
    """
    repeated = materialize(sized.groupBy("_same").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_same"), "mix-repeated")
    if repeated.isEmpty():
        return sized.withColumn("_place", F.lit(0).cast("long"))
    ranked = materialize(number_rows(sized.select("_same", "_row").join(repeated, "_same"), [F.col("_same"), F.col("_row")], "_rank"), "mix-ranked")
    first = ranked.groupBy("_same").agg(F.min("_rank").alias("_first"))
    places = ranked.join(first, "_same").select("_row", (F.col("_rank") - F.col("_first")).cast("long").alias("_place"))
    return materialize(sized.join(places, "_row", "left").fillna(0, ["_place"]), "mix-places")


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 11, share: float = 1.5,
        weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of docs: _row, _id, source, size, source_size, target, quota_blocks, shard, taken.

    A shard is a ring of its documents in seeded order, cut into blocks of `block_words` words. Its quota is a run
    of whole blocks from a seeded first block on, as often round the ring as it needs; `taken` is the number of a document's
    words in that run, at most twice its size. Null texts have size 0 and are never taken; a null source is a source of
    its own; a source whose quota is below one block may take none. Order and draws depend on seed, id, source, text and the
    place among rows equal in these, so they are the same for every layout of the table.
    """
    own = numbered(docs.select(F.col(id).alias("_id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("_text")))
    same = F.xxhash64("_id", F.col("source").isNull(), "source", "_text")
    sized = with_place(materialize(own.select("_row", "_id", "source", size_of(F.col("_text")).alias("size"), same.alias("_same")), "mix-sizes"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = materialize(targets(sources, share, weights), "mix-targets")
    blocks = int(round((aimed.agg(F.sum("target")).first()[0] or 0.0) / block_words))
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(NULL_LAST))
    quota = materialize(
        apportion(aimed, F.col("target"), blocks, name).withColumns({
            "_source": name, "_shards": F.least(F.ceil(F.col("source_size") / shard_words), F.lit(MOST_SHARDS)).cast("long"),
        }).withColumnRenamed("_seats", "_quota"),
        "mix-quotas",
    )
    draw = F.xxhash64(F.lit(seed), F.col("_same"), F.col("_place"))
    few = quota.select("_source", "source_size", "target", "_quota", F.greatest("_shards", F.lit(1)).alias("_shards"))
    placed = sized.withColumns({"_source": name, "_draw": draw}).join(few, "_source")
    placed = placed.withColumn("_shard", F.pmod(F.xxhash64(F.col("_draw"), F.lit(1)), F.col("_shards")))
    placed = materialize(placed, "mix-placed")
    words = placed.groupBy("_source", "_shard").agg(F.sum("size").alias("_words")).filter("_words > 0")
    takes = shard_quotas(words.join(few.select("_source", "source_size", "_quota"), "_source"), block_words)
    order = W.partitionBy("_source", "_shard").orderBy("_draw", "_same", "_place")
    ring = placed.withColumn("_end", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    ring = ring.join(takes.select("_source", "_shard", "_blocks", "_words", "_take"), ["_source", "_shard"], "left")
    start = F.col("_end") - F.col("size")
    n_blocks = F.greatest(F.floor(F.col("_words") / block_words), F.lit(1))
    first = F.pmod(F.xxhash64(F.lit(seed), F.col("_source"), F.col("_shard")), n_blocks) * block_words
    rest = F.col("_take") % F.col("_words")

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.least(F.col("_end"), high) - F.greatest(start, low), F.lit(0))

    run = overlap(first, first + rest) + overlap(first - F.col("_words"), first + rest - F.col("_words"))
    taken = F.floor(F.col("_take") / F.col("_words")) * F.col("size") + run
    return ring.select(
        "_row", "_id", "source", "size", "source_size", "target", F.col("_blocks").alias("shard_blocks"),
        F.col("_shard").alias("shard"), F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them, with all their columns: each row as often as its taken words make whole copies.

    The first and last block of a shard's run may cut a document; such a document counts to the nearest whole copy. Documents without
    words have no size and are not taken; repeated rows are drawn one by one, whatever the names of other columns; an empty table gives no rows.
    """
    docs = stored(docs)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = mix(docs, **options).filter("taken > 0").select("_row", copies.alias("_copies")).filter("_copies > 0")
    key, many = unused(docs, "_row"), unused(docs, "_copies")
    joined = numbered(docs, key).join(taken.toDF(key, many), key)
    return joined.withColumn(many, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*[F.col(f"`{c}`") for c in docs.columns])
