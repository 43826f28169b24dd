"""Hard negatives by slots of scores.

Each positive of an anchor asks for the best negatives with scores inside a window that its own score sets. The windows of an
anchor overlap, so they are not searched one by one: the positives' upper limits, highest first, cut the scores into disjoint slots, and a
negative belongs to the one slot that holds its score. A combiner keeps the first `negatives` rows of each slot, first within a task,
then over all tasks. Slots are disjoint and in descending order, so a window's answer is read from its own slot on: the
first rows of that suffix, without those under the window's lower limit.

Anchors meet all rows in blocks: an anchor block and a row block are one task group of bounded size, whatever the labels, and what leaves it are a
few rows per anchor. Blocks are dealt by row, not by label or id, so a hot label is spread over all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom.llm.vectors import as_longs, matrix, product_kind, scaled, whole
from pressroom.session import materialize

ROW_BLOCK = 8192
ANCHOR_BLOCK = 4096
LEAST_BLOCKS = 32  # row blocks of a small table, so that it is more than one task's work
AT_ONCE = 1 << 20  # scores held at a time
FOUND = pa.schema([("_anchor", pa.int64()), ("_slot", pa.int32()), ("_score", pa.int64()), ("_id", pa.int64())])
FOUND_DDL = "_anchor long, _slot int, _score long, _id long"


def best(scores: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, column) of the highest finite scores of each row, one place after the other; the first column wins a tie. Changes scores."""
    out, rows = [], np.arange(len(scores))
    for _ in range(count):
        if not len(rows) or not scores.shape[1]:
            break
        at = scores[rows].argmax(axis=1) if len(rows) < len(scores) else scores.argmax(axis=1)
        there = scores[rows, at] > -np.inf
        rows, at = rows[there], at[there]
        out.append((rows, at))
        scores[rows, at] = -np.inf
    return out


def _sides(anchors: pa.Table, rows: pa.Table):
    """Anchor and row matrices of one exact number type, with ids and labels; rows by id, so that the first of equal scores has the smallest id."""
    rows = rows.sort_by("_id")
    width = max(matrix(t.column("_v")).shape[1] for t in (anchors, rows))
    x, y = matrix(anchors.column("_v"), width), matrix(rows.column("_v"), width)
    kind = product_kind(x, y)
    own = [t.column(c).to_numpy() for t in (anchors, rows) for c in ("_id", "_label")]
    return x.astype(kind), y.astype(kind), *own


def _made(found: list[tuple]) -> pa.Table:
    columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4)]
    return pa.table([pa.array(c, t) for c, t in zip(columns, FOUND.types, strict=True)], schema=FOUND)


def _same_label(count: int):
    def made(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The best rows of each anchor's own label in a block."""
        if not anchors.num_rows or not rows.num_rows:
            return _made([])
        x, y, anchor_id, anchor_label, row_id, row_label = _sides(anchors, rows)
        key, found = anchors.column("_anchor").to_numpy(), []
        by_label = np.argsort(row_label, kind="stable")
        sorted_labels = row_label[by_label]
        for label in np.unique(anchor_label):
            mine = np.flatnonzero(anchor_label == label)
            own = by_label[np.searchsorted(sorted_labels, label):np.searchsorted(sorted_labels, label, "right")]
            for i in range(0, len(mine), step := max(1, AT_ONCE // max(1, len(own)))):
                some = mine[i:i + step]
                scores = x[some] @ y[own].T
                scores[anchor_id[some][:, None] == row_id[own]] = -np.inf
                for at, place in best_copied(scores, count):
                    found.append((key[some[at]], np.zeros(len(at), np.int64), as_longs(place[1]), row_id[own[place[0]]]))
        return _made(found)

    return made


def best_copied(scores: np.ndarray, count: int):
    """As best, with the scores found: (row, (column, score))."""
    kept = scores.copy()
    return [(rows, (at, kept[rows, at])) for rows, at in best(scores, count)]


def _slots(count: int):
    def made(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The best rows of other labels in each slot of each anchor in a block."""
        if not anchors.num_rows or not rows.num_rows:
            return _made([])
        x, y, _, anchor_label, row_id, row_label = _sides(anchors, rows)
        key, found = anchors.column("_anchor").to_numpy(), []
        above, until = (anchors.column(c).combine_chunks() for c in ("_above", "_until"))
        n_slots = above.value_lengths().to_numpy(zero_copy_only=False)
        slots = int(n_slots.max())
        edges = []
        for limits in (above, until):  # slots that an anchor lacks are empty
            table = np.zeros((len(key), slots), np.int64)
            table[np.arange(slots) < n_slots[:, None]] = limits.flatten().to_numpy(zero_copy_only=False)
            edges.append(table.astype(object) if x.dtype == object else table)
        for i in range(0, len(key), step := max(1, AT_ONCE // len(row_id))):
            some = slice(i, i + step)
            scores = x[some] @ y.T
            scores[anchor_label[some][:, None] == row_label] = -np.inf
            for j in range(slots):
                inside = (scores > edges[0][some, j][:, None]) & (scores <= edges[1][some, j][:, None])
                use = np.flatnonzero(inside.any(axis=1))
                held = np.where(inside[use], scores[use], -np.inf)
                for at, place in best_copied(held, count):
                    found.append((key[some][use[at]], np.full(len(at), j), as_longs(place[1]), row_id[place[0]]))
        return _made(found)

    return made


def first_of(found: DataFrame, keys: list[str], count: int, name: str) -> DataFrame:
    """The first `count` rows of each key by score, then id; Spark cuts each task's rows to as many before it shuffles them."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("_score").desc(), F.col("_id")))
    return found.withColumn(name, place).filter(F.col(name) <= count)


def mine(rows: DataFrame, anchors: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """One row per hard negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are exact inner products of floor(scale * x). Positives of an anchor are its best `positives` other rows of its (integer) label,
    and negatives of a positive the best `negatives` rows of other labels with low * positive <= 100 * negative <= high * positive; ties go to
    the smaller id. Rows without id, label or vector, or with a null or non-finite component, take no part. Where vectors differ in length, the shorter is
    filled with zeros. A row with the anchor's id is not its positive; otherwise repeated rows are rows of their own, so a repeated anchor gives
    its rows again. Scores beyond a long are the nearest long. `anchors` is a condition on the given columns. Other columns are not
    read; an empty table gives no rows.
    """
    taken = rows.select(
        F.col(id).cast("long").alias("_id"), F.col(label).cast("long").alias("_label"), F.col(vector).alias("_vector"), F.coalesce(anchors, F.lit(False)).alias("_is_anchor"),
    )
    n_rows, n_anchors = taken.filter("_id is not null").agg(F.count(F.lit(1)), F.count_if("_is_anchor")).first()
    row_blocks, anchor_blocks = max(LEAST_BLOCKS, -(-n_rows // ROW_BLOCK)), max(1, -(-n_anchors // ANCHOR_BLOCK))
    numbered = taken.filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & whole(F.col("_vector"))).withColumn("_anchor", F.monotonically_increasing_id())
    kept = materialize(numbered.select(  # stored, so that numbers and blocks stay
        "_id", "_label", scaled(F.col("_vector"), scale).alias("_v"), "_is_anchor", "_anchor",
        F.pmod(F.xxhash64("_anchor"), F.lit(row_blocks)).cast("int").alias("_b"), F.pmod(F.xxhash64("_anchor", F.lit(1)), F.lit(anchor_blocks)).cast("int").alias("_a"),
    ), "negatives-rows")
    dealt = kept.filter("_is_anchor").drop("_b").withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    # columns under new names' ids: both sides of a cogroup come from one table
    blocks = kept.select(*[F.col(c).alias(c) for c in ("_id", "_label", "_v", "_b")], F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("_a")).groupBy("_a", "_b")

    near = dealt.select("_anchor", "_id", "_label", "_v", "_a", "_b").groupBy("_a", "_b").cogroup(blocks).applyInArrow(_same_label(positives), FOUND_DDL)
    chosen = materialize(first_of(near, ["_anchor"], positives, "_place").select("_anchor", "_place", F.col("_id").alias("positive_id"), F.col("_score").alias("positive_score")), "negatives-positives")

    exact = F.col("positive_score").cast("decimal(38,0)")
    until, least = F.floor(exact * high / 100), F.ceil(exact * low / 100)
    limits = chosen.select("_anchor", "_place", until.cast("long").alias("_u"), least.cast("long").alias("_l")).groupBy("_anchor").agg(F.sort_array(F.collect_list(F.struct("_place", "_u", "_l"))).alias("_w"))
    nexts = F.transform("_w", lambda w, i: F.greatest(w["_l"] - 1, F.coalesce(F.get("_w", i + 1)["_u"], w["_l"] - 1)))  # a slot ends above the next one, or at the lowest score that a window asks for
    limits = limits.select("_anchor", nexts.alias("_above"), F.col("_w._u").alias("_until"))
    searched = dealt.select("_anchor", "_id", "_label", "_v", "_a", "_b").join(limits, "_anchor")
    found = searched.groupBy("_a", "_b").cogroup(blocks).applyInArrow(_slots(negatives), FOUND_DDL)
    slots = first_of(found, ["_anchor", "_slot"], negatives, "_place").groupBy("_anchor").agg(F.sort_array(F.collect_list(F.struct((-F.col("_score")).alias("s"), F.col("_id").alias("id"), F.col("_slot").alias("slot")))).alias("_all"))

    names = kept.filter("_is_anchor").select("_anchor", F.col("_id").alias("anchor_id"))
    own = chosen.join(names, "_anchor").join(slots, "_anchor")
    suffix = F.slice(F.filter("_all", lambda x: x["slot"] >= F.col("_place") - 1), 1, negatives)
    inside = F.filter(suffix, lambda x: -x["s"] >= F.ceil(F.col("positive_score").cast("decimal(38,0)") * low / 100))
    return own.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("_k", "_n")).select(
        "anchor_id", "positive_id", (F.col("_k") + 1).cast("int").alias("rank"), F.col("_n.id").alias("negative_id"), "positive_score", (-F.col("_n.s")).alias("negative_score"),
    )
