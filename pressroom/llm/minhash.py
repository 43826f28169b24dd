"""Near duplicates by min-max hashing, confirmed on full shingle sets.

* One map over whole texts gives each document its set size, a 128-bit digest of the set, and a signature: every
  permutation yields its minimum and its maximum, so 72 permutations make 144 values, cut into 36 bands of 4. A pair at
  similarity 0.75 shares no band with chance (1 - 0.75^4)^36, about 1e-6.
* Documents with one digest are one class; only class representatives go on, so exact copies cost one row.
* Candidates of a bucket are compared with the bucket's leader only, not with one another. The leader is the member that
  meets most others over all its buckets, so the common source of edited copies leads wherever it is present.
* Confirmed links are joined to components. Where a bucket still holds several, the members outside its leader's
  component are the open ones: they are dealt into blocks, and every member of a bucket of that leader's component is held against
  whole blocks inside a task, on full sets. Only links leave the task. After that every two members of a bucket are
  in one component or have been compared.
* Leaders, blocks and members are dealt in cells of bounded size, each with its own copy of the texts it needs.
* Components by alternating large-star and small-star rounds on stored edges; nothing but counts reaches the driver.

Joins on a hot class or bucket read stored tables on both sides, so Spark's adaptive skew join can split them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.words import mix, numbered, shingles, stored, text_words, unused
from pressroom.session import materialize

BANDS, BAND_ROWS = 36, 4
SHINGLE = 5
LEAST_PERCENT = 75
CHUNK = 128
BLOCK = 256

_rng = np.random.default_rng(2)
SCALE = _rng.integers(1, 2**63, BANDS * BAND_ROWS // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _rng.integers(0, 2**63, BANDS * BAND_ROWS // 2, dtype=np.uint64)
BAND_STEP = _rng.integers(1, 2**63, BAND_ROWS, dtype=np.uint64) | np.uint64(1)
BAND_SEED = mix(np.arange(1, BANDS + 1, dtype=np.uint64))

FEATURES = "_row long, _id long, n_shingles long, _d1 long, _d2 long, _bands array<long>"


def signature(items: np.ndarray) -> np.ndarray:
    """Minima of all permutations, then their maxima."""
    low, high = None, None
    for at in range(0, len(items), 2048):
        seen = SCALE[:, None] * items[None, at:at + 2048] + SHIFT[:, None]
        a, b = seen.min(axis=1), seen.max(axis=1)
        low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
    return np.concatenate([low, high])


def bands(values: np.ndarray) -> np.ndarray:
    """One key per band; a band holds minima only or maxima only, so its values come from different permutations."""
    return mix((values.reshape(BANDS, BAND_ROWS) * BAND_STEP).sum(axis=1, dtype=np.uint64) + BAND_SEED)


def _features(batches):
    for batch in batches:
        n, d1, d2, keys, sizes = [], [], [], [], []
        for words in text_words(batch.column("_text"), lower=True):
            items = shingles(words, SHINGLE)
            n.append(len(items))
            if len(items):
                d1.append(items.sum(dtype=np.uint64))
                d2.append(mix(items).sum(dtype=np.uint64))
                keys.append(bands(signature(items)))
            else:
                d1.append(0)
                d2.append(0)
            sizes.append(BANDS if len(items) else 0)
        flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_id"), pa.array(n, pa.int64()), pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array(np.array(d2, np.uint64).view(np.int64)), lists],
            names=["_row", "_id", "n_shingles", "_d1", "_d2", "_bands"],
        )


def _confirm(batches):
    """Rows sorted by leader and chunk, the leader first: members that share enough shingles with it."""
    lead, own = None, None
    for batch in batches:
        a, b = [], []
        rows = zip(batch.column("_lead").to_pylist(), batch.column("_node").to_pylist(), text_words(batch.column("_text"), lower=True), strict=True)
        for head, node, words in rows:
            items = shingles(words, SHINGLE)
            if head == node:
                lead, own = head, items
            elif lead == head:
                at = np.minimum(np.searchsorted(own, items), len(own) - 1)
                both = int((own[at] == items).sum())
                if 100 * both >= LEAST_PERCENT * (len(own) + len(items) - both):
                    a.append(head)
                    b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs (a, b, degree of a) whose full sets are similar enough. texts (_row, _text) holds every node.

    A leader's degree is at least the number of its members, and for members that are confirmed about ten times as large.
    """
    chunk = F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / (8 * CHUNK)))
    members = pairs.select(F.col("a").alias("_lead"), chunk.alias("_chunk"), F.col("b").alias("_node"))
    leads = members.select("_lead", "_chunk").distinct().withColumn("_node", F.col("_lead"))
    asked = members.unionByName(leads).join(texts.withColumnRenamed("_row", "_node"), "_node")
    ordered = asked.repartition("_lead", "_chunk").sortWithinPartitions("_lead", "_chunk", F.col("_node") != F.col("_lead"))
    return ordered.select("_lead", "_node", "_text").mapInArrow(_confirm, "a long, b long")


def _against_block(batches):
    """Rows sorted by cell, the block's own rows first: links between the block and the other rows of its cell."""
    cell, block, tokens, owners, sizes = None, [], None, None, None
    for batch in batches:
        a, b = [], []
        rows = zip(*(batch.column(c).to_pylist() for c in ("_group", "_block", "_chunk", "_open", "_node")), text_words(batch.column("_text"), lower=True), strict=True)
        for *place, is_open, node, words in rows:
            items = shingles(words, SHINGLE)
            if place != cell:
                cell, block, tokens = place, [], None
            if is_open:
                block.append((node, items))
                continue
            if not block:
                continue
            if tokens is None:
                joined = np.concatenate([x for _, x in block])
                order = np.argsort(joined, kind="stable")
                tokens = joined[order]
                owners = np.repeat(np.arange(len(block)), [len(x) for _, x in block])[order]
                sizes = np.array([len(x) for _, x in block])
            low, high = np.searchsorted(tokens, items, "left"), np.searchsorted(tokens, items, "right")
            n = high - low
            at = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            both = np.bincount(owners[at], minlength=len(block))
            for i in np.flatnonzero(100 * both >= LEAST_PERCENT * (sizes + len(items) - both)).tolist():
                if block[i][0] != node:
                    a.append(block[i][0])
                    b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def open_links(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) across components. placed: _key, _row, _lead, _label of every member of a bucket."""
    spread = placed.groupBy("_key").agg(F.min("_label").alias("_x"), F.max("_label").alias("_y"), F.max(F.when(F.col("_row") == F.col("_lead"), F.col("_label"))).alias("_group"))
    mixed = placed.join(materialize(spread.filter("_x < _y").select("_key", "_group"), "near-spread"), "_key")
    nodes = materialize(mixed.groupBy("_group", "_row").agg(F.max(F.col("_label") != F.col("_group")).alias("_open")), "near-open")
    sizes = materialize(nodes.groupBy("_group").agg(
        F.ceil(F.sum(F.col("_open").cast("long")) / BLOCK).alias("_blocks"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("_chunks"),
    ), "near-cells")
    dealt = nodes.join(sizes, "_group")
    every = dealt.withColumn("_chunk", F.pmod(F.xxhash64("_row"), F.col("_chunks"))).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).withColumn("_open", F.lit(False))
    blocks = dealt.filter("_open").withColumn("_block", F.pmod(F.xxhash64("_row", F.lit(1)), F.col("_blocks"))).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)))
    columns = ["_group", "_block", "_chunk", "_open", F.col("_row").alias("_node")]
    asked = every.select(*columns).unionByName(blocks.select(*columns)).join(texts.withColumnRenamed("_row", "_node"), "_node")
    ordered = asked.repartition("_group", "_block", "_chunk").sortWithinPartitions("_group", "_block", "_chunk", F.col("_open").desc())
    return ordered.mapInArrow(_against_block, "a long, b long")


def settled(stars: DataFrame) -> bool:
    """Whether every u of the edges (u, v) has one v only and no v is a u: then v is the label of u."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("head")).unionByName(
        stars.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("head")),
    )
    wrong = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("head").alias("head")).filter("child + head > 1")
    return wrong.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a, b): label is the least node it is connected with."""
    stars = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-edges")
    while not settled(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "near-low")  # stored: u may be hot
        large = materialize(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "near-large")
        own = large.groupBy("u").agg(F.min("v").alias("m"))  # here u has few rows
        small = large.join(own, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        stars = materialize(small.filter("u <> v").distinct(), "near-stars")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label"))


def first_of(id: Column, row: Column) -> Column:
    """Orders rows by id, null ids last, then by row."""
    return F.struct(id.isNull().alias("n"), id.alias("id"), row.alias("row"))


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: _row, _id, n_shingles, component_id, class_id, kept.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z folded; a set is the distinct 5-word shingles, or the whole
    sequence of a shorter text. Sets are linked at 100 * intersection >= 75 * union. component_id is the smallest id
    reachable; class_id is the smallest id with the same set. `kept` marks one row per component: the smallest id,
    null ids last, the first row of repeated ids. Null, empty and blank texts have no set, are linked with nothing and kept. An
    empty table gives no rows. Rows are named by words.numbered; other columns are not read.
    """
    own = numbered(docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")))
    seen = materialize(own.mapInArrow(_features, FEATURES), "near-features")
    filled = seen.filter("n_shingles > 0")
    first = first_of(F.col("_id"), F.col("_row"))
    classes = materialize(
        filled.groupBy("_d1", "_d2", "n_shingles").agg(F.min("_row").alias("_rep"), F.min(first).alias("_first"), F.min_by("_bands", "_row").alias("_bands")),
        "near-classes",
    )
    keys = classes.select(F.col("_rep").alias("_row"), F.explode("_bands").alias("_key"))
    buckets = materialize(keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "near-buckets")
    # at most BANDS keys a node
    nodes = materialize(keys.join(buckets, "_key").groupBy("_row").agg(F.sum("_n").alias("_degree"), F.collect_list("_key").alias("_keys")), "near-nodes")
    found = nodes.select("_row", "_degree", F.explode("_keys").alias("_key"))
    best = found.groupBy("_key").agg(F.max(F.struct(F.col("_degree"), (-F.col("_row")).alias("_r"))).alias("_m"))
    leaders = materialize(best.select("_key", (-F.col("_m._r")).alias("_lead"), F.col("_m._degree").alias("_lead_degree")), "near-leads")
    members = materialize(found.select("_key", "_row").join(leaders, "_key"), "near-members")
    texts = materialize(own.select("_row", "_text").join(nodes.select("_row"), "_row", "left_semi"), "near-texts")
    pairs = members.filter("_row <> _lead").groupBy("_lead", "_row").agg(F.max("_lead_degree").alias("degree"))
    links = confirmed(materialize(pairs.select(F.col("_lead").alias("a"), F.col("_row").alias("b"), "degree"), "near-pairs"), texts)
    label = materialize(components(links), "near-labels")

    placed = materialize(members.join(label.withColumnRenamed("node", "_row"), "_row", "left").withColumn("_label", F.coalesce("label", "_row")).drop("label"), "near-placed")
    more = materialize(open_links(placed, texts), "near-more")
    if not more.isEmpty():
        ends = more
        for end in ("a", "b"):
            ends = ends.join(label.toDF(end, "_to"), end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
        higher = materialize(components(ends), "near-higher")
        merged = label.unionByName(higher.select(F.col("node"), F.col("node").alias("label"))).groupBy("node").agg(F.min("label").alias("_old"))
        label = materialize(merged.join(higher.toDF("_old", "label"), "_old", "left").select("node", F.coalesce("label", "_old").alias("label")), "near-labels")

    joined = materialize(classes.drop("_bands").join(label.withColumnRenamed("node", "_rep"), "_rep", "left").withColumn("_root", F.coalesce("label", "_rep")).drop("label"), "near-rooted")
    heads = materialize(joined.groupBy("_root").agg(F.min("_first").alias("_head")), "near-heads")
    named = materialize(joined.join(heads, "_root").select("_d1", "_d2", "n_shingles", F.col("_first.id").alias("class_id"), F.col("_head.id").alias("_comp"), F.col("_head.row").alias("_keep")), "near-named")
    out = seen.select("_row", "_id", "n_shingles", "_d1", "_d2")
    linked = out.filter("n_shingles > 0").join(named, ["_d1", "_d2", "n_shingles"]).select(
        "_row", "_id", "n_shingles", F.col("_comp").alias("component_id"), "class_id", (F.col("_row") == F.col("_keep")).alias("kept"),
    )
    alone = out.filter("n_shingles = 0").select("_row", "_id", "n_shingles", F.col("_id").alias("component_id"), F.col("_id").alias("class_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def drop_near(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that near_groups keeps, with all their columns, whatever their names.

    Nulls, texts without words, equal ids and repeated rows are dealt with as near_groups says; an empty table gives no rows.
    """
    docs = stored(docs)
    kept = near_groups(docs, id, text).filter("kept").select("_row")
    key = unused(docs, "_row")
    return numbered(docs, key).join(kept.withColumnRenamed("_row", key), key, "left_semi").drop(key)
