"""Exact duplicates through an extendible hash index on shared files.

1. Each input task normalises its texts and chains equal ones locally (same hash, then same bytes), so
   a text copied into a third of all rows leaves a task as few entries. Rows, entries and the bytes
   of entries are written once to the shared folder: the data file of the index.
2. The directory starts with as many address bits as the data need and doubles where a bucket
   is overfull: only rows of overfull buckets take part in the next doubling. A bucket whose entries all
   have one hash cannot be split further; its chain just grows.
3. Owner tasks get whole buckets in hash order and walk the chains: entries of one hash are told apart by
   their bytes. A task holds one chain's distinct texts, no more.

Bucket, chain and group results are tables; the driver sees only counts per doubling round.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.words import as_bytes, numbered, stored, unused
from pressroom.session import materialize

CHAIN_BYTES = 64 << 20
BUCKET_ROWS = 200_000
BUCKET_BYTES = 64 << 20
TASK_BYTES = 1 << 26
LAST_DEPTH = 48

PREPARED = "_row long, _id long, _entry long, _hash long, _sha string, _size long, _body binary"


def normal_bytes(text: bytes) -> bytes:
    """Each run of white space becomes one space; nothing is trimmed."""
    words = text.split()
    if not words:
        return b" " if text else b""
    body = b" ".join(words)
    return (b" " if text[:1].isspace() else b"") + body + (b" " if text[-1:].isspace() else b"")


def _local_chains(batches):
    seen, held = {}, 0
    schema = pa.schema([
        ("_row", pa.int64()), ("_id", pa.int64()), ("_entry", pa.int64()), ("_hash", pa.int64()),
        ("_sha", pa.string()), ("_size", pa.int64()), ("_body", pa.binary()),
    ])
    for batch in batches:
        data, bounds = as_bytes(batch.column("_text"))
        view = memoryview(data)
        entry, key, sha, size, body = [], [], [], [], []
        for i, row in enumerate(batch.column("_row").to_pylist()):
            text = normal_bytes(bytes(view[bounds[i]:bounds[i + 1]]))
            digest = hashlib.sha256(text).digest()
            first = next((r for r, t in seen.get(digest[:8], ()) if t == text), None)
            if first is None:
                if held > CHAIN_BYTES:
                    seen, held = {}, 0
                seen.setdefault(digest[:8], []).append((row, text))
                held += len(text) + 200
            entry.append(row if first is None else first)
            key.append(int.from_bytes(digest[:8], "big", signed=True))
            sha.append(digest.hex())
            size.append(len(text))
            body.append(text if first is None else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_id").cast(pa.int64()), *(pa.array(x, t.type) for x, t in zip((entry, key, sha, size, body), list(schema)[2:], strict=True))],
            schema=schema,
        )


def _walk_chains(batches):
    """Entries in hash order: each gets the first entry of its hash that has the same bytes."""
    current, chain = None, []
    for batch in batches:
        group = []
        for key, row, body in zip(*(batch.column(c).to_pylist() for c in ("_hash", "_entry", "_body")), strict=True):
            if key != current:
                current, chain = key, []
            first = next((r for r, t in chain if t == body), None)
            if first is None:
                chain.append((row, body))
            group.append(row if first is None else first)
        yield pa.RecordBatch.from_arrays([batch.column("_entry"), pa.array(group, pa.int64())], names=["_entry", "_group"])


def prefix(depth: Column) -> Column:
    """The first `depth` bits of the hash."""
    return F.expr("shiftrightunsigned(_hash, 64 - _depth)") if depth is None else F.call_function("shiftrightunsigned", F.col("_hash"), (F.lit(64) - depth).cast("int"))


def directory(entries: DataFrame, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES, first_depth: int | None = None) -> DataFrame:
    """Buckets (_depth, _prefix, rows, bytes) of entries (_hash, _size): every hash has exactly one.

    first_depth: address bits to start with; None takes those that the total size asks for.
    """
    rows, size = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum("_size"), F.lit(0))).first()
    depth = first_depth or max(1, int(max(rows / bucket_rows, size / bucket_bytes)).bit_length())
    done, left = None, entries
    while True:
        cells = left.groupBy(prefix(F.lit(depth)).alias("_prefix")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("_size").alias("bytes"), F.min("_hash").alias("_low"), F.max("_hash").alias("_high"),
        )
        over = ((F.col("rows") > bucket_rows) | (F.col("bytes") > bucket_bytes)) & (F.col("_low") < F.col("_high")) & F.lit(depth < LAST_DEPTH)
        cells = materialize(cells.select(F.lit(depth).alias("_depth"), "_prefix", "rows", "bytes", over.alias("_over")), "directory")
        settled = cells.filter(~F.col("_over")).drop("_over")
        done = settled if done is None else done.unionByName(settled)
        full = cells.filter("_over")
        if full.isEmpty():
            return done
        left = left.withColumn("_prefix", prefix(F.lit(depth))).join(full.select("_prefix"), "_prefix", "left_semi").drop("_prefix")
        depth += 1


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS,
                 bucket_bytes: int = BUCKET_BYTES, first_depth: int | None = None) -> DataFrame:
    """One row per row of docs: _row, _id, keep_id, group_size, kept, text_sha256, bucket.

    Texts are equal when identical after each run of white space is one space; null counts as empty. Of equal
    texts the row with the smallest id is kept; null ids come last, and of repeated ids the first row is
    kept. keep_id is null if all ids of the group are. An empty table gives no rows. Rows are named by
    words.numbered; other columns are not read, so their names don't matter.
    """
    own = numbered(docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")))
    prepared = materialize(own.mapInArrow(_local_chains, PREPARED), "exact-data")
    entries = prepared.filter(F.col("_entry") == F.col("_row")).select("_entry", "_hash", "_size", "_body")
    buckets = directory(entries.select("_hash", "_size"), bucket_rows, bucket_bytes, first_depth)
    depths = [r[0] for r in buckets.select("_depth").distinct().orderBy("_depth").collect()] or [1]  # at most 48 numbers
    probes = entries.withColumn("_depth", F.explode(F.array(*[F.lit(d) for d in depths]))).withColumn("_prefix", prefix(F.col("_depth"))) if len(depths) > 1 else entries.withColumn("_depth", F.lit(depths[0])).withColumn("_prefix", prefix(F.lit(depths[0])))
    placed = probes.join(buckets.select("_depth", "_prefix"), ["_depth", "_prefix"], "left_semi") if len(depths) > 1 else probes
    size = buckets.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))  # a task owns a few buckets, each a range of hashes
    owned = (
        placed.withColumn("_bucket", F.concat_ws("/", F.col("_depth").cast("string"), F.hex("_prefix")))
        .select("_bucket", "_hash", "_entry", "_body")
        .repartition(tasks, F.col("_bucket"))
        .sortWithinPartitions("_bucket", "_hash", "_entry")
    )
    groups = materialize(owned.mapInArrow(_walk_chains, "_entry long, _group long"), "exact-chains")
    first = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    tallies = prepared.select("_entry", "_row", "_id").groupBy("_entry").agg(F.count(F.lit(1)).alias("_rows"), F.min(first).alias("_first"))
    entry_totals = tallies.join(groups, "_entry")
    totals = entry_totals.groupBy("_group").agg(F.sum("_rows").alias("group_size"), F.min("_first").alias("_first"))
    named = materialize(
        groups.join(totals, "_group").select("_entry", "group_size", F.col("_first.id").alias("keep_id"), F.col("_first.row").alias("_keep")),
        "exact-groups",
    )
    return prepared.select("_row", "_id", "_entry", "_sha").join(named, "_entry").select(
        "_row", "_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep")).alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns, whatever their names.

    Nulls, empty texts, equal ids and repeated rows are dealt with as exact_groups says; an empty table gives no rows.
    """
    docs = stored(docs)
    kept = exact_groups(docs, id, text).filter("kept").select("_row")
    key = unused(docs, "_row")
    return numbered(docs, key).join(kept.withColumnRenamed("_row", key), key, "left_semi").drop(key)
