"""Packing by minimum bin slack.

Texts are tokenised once, in one map, and the ids are stored. Whole windows of a document stand alone; what remains
has one of `window` - 1 lengths, so all the driver needs is a histogram of that many numbers, whatever the corpus. The plan opens each
window with the longest remaining length and fills the gap by bitset subset-sum dynamic programming over the remaining multiset;
counts are backtracked from the bitsets, and a filling is repeated as often as its lengths allow. Where no multiset fills the gap, one more
remainder is cut to fit and its rest goes back to the multiset, so only the very last window is padded.

A remainder finds its place by its number among the remainders of its length: numbered in its own input task, plus the
counts of the tasks before. Placements are intervals of these numbers; their table depends on the number
of lengths, not of documents, and is broadcast.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from pressroom.llm.words import numbered
from pressroom.session import scratch_path

WINDOW = 1024
END_ID = 0
CACHE_WORDS = 800_000
LONGEST_CACHED = 48
LONG_TEXT = 10_000
LONG_BLANK = re.compile(r"\s{2000}")
_STATE = {}


# Fixed value: the pre-tokeniser's pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _tokenizer(path: str):
    """An encoder with the vocabulary of a byte-level tokenizer file, whose ids are in the order of its merges.

    It gives the ids of the tokenizers library (tests compare them) at several times the speed for single words. It knows no added
    tokens: encode_documents finds those.
    """
    if _STATE.get("path") != path:
        import tiktoken

        # the file writes each byte as a printable character: printable bytes as themselves, the others from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        as_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"] for x in spec.get("added_tokens", ())}
        ranks = {bytes(as_byte[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        _STATE.update(library=None, added=_added(spec))
        _STATE.update(path=path, made=tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), head={}, rest={})
    return _STATE["made"]


def _added(spec: dict) -> tuple[list[str], re.Pattern | None, dict[str, bytes]]:
    """The file's added tokens, their pattern (None if one has options, so that only the library can find it) and their ids."""
    tokens = [x for x in spec.get("added_tokens", ()) if x["content"]]
    names = sorted((x["content"] for x in tokens), key=len, reverse=True)
    plain = not any(x.get(k) for x in tokens for k in ("single_word", "lstrip", "rstrip", "normalized"))
    ids = {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in tokens}
    return names, re.compile("|".join(map(re.escape, names))) if names and plain else None, ids


def _library(path: str, plain: bool):
    """The tokenizers library's own encoder of the file; `plain` reads added tokens as text."""
    if _STATE.get("library") is None:
        from tokenizers import Tokenizer

        _STATE["library"] = Tokenizer.from_file(path)
    _STATE["library"].encode_special_tokens = plain
    return _STATE["library"]


def _ids(made, text: str) -> bytes:
    if len(text) > LONG_TEXT and LONG_BLANK.search(text):  # the fast encoder's pattern overflows its stack on such runs
        return np.array(_library(_STATE["path"], True).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return array("I", made.encode_ordinary(text)).tobytes()


def encode(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit numbers; added tokens of the file are read as text (see encode_documents).

    The byte-level pre-tokeniser never joins across a single space that follows no white space, so a text is the
    parts between spaces, each with its leading space, and equal parts have equal ids: they are encoded once and kept. Texts with
    runs of white space that could be split wrongly are encoded whole.
    """
    made = _tokenizer(path)
    head, rest = _STATE["head"], _STATE["rest"]
    if len(head) + len(rest) > CACHE_WORDS:
        head.clear()
        rest.clear()
    out = []
    for text in texts:
        first, *parts = text.split(" ")
        own = head.get(first)
        if own is None:
            own = _ids(made, first)
            if len(first) <= LONGEST_CACHED:
                head[first] = own
        found = [own]
        for p in parts:
            own = rest.get(p)
            if own is None:
                if not p or p[0].isspace():
                    found = None
                    break
                own = _ids(made, " " + p)
                if len(p) <= LONGEST_CACHED:
                    rest[p] = own
            found.append(own)
        out.append(_ids(made, text) if found is None else b"".join(found))
    return out


def encode_documents(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as the library gives them at its default setting: an added token of the file in a text has its own id."""
    _tokenizer(path)
    names, pattern, ids = _STATE["added"]
    out = encode([t if not any(x in t for x in names) else "" for t in texts], path)
    for i, text in enumerate(texts):
        if any(x in text for x in names):
            if pattern is None:
                out[i] = np.array(_library(path, False).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            between, found = encode(pattern.split(text), path), pattern.findall(text)
            out[i] = b"".join(x for pair in zip(between, [*(ids[x] for x in found), b""], strict=True) for x in pair)
    return out


def tokenised(docs: DataFrame, path: str, id: str, text: str, window: int, end_id: int) -> DataFrame:
    """_row, _id, _part, tokens, _full (whole windows), _full_before, _class (remaining length), _rank (in part and class), _ids."""
    end = np.array([end_id], "<u4").tobytes()

    def made(batches):
        full_so_far, ranks, part = 0, {}, TaskContext.get().partitionId()
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for at in range(0, max(len(texts), 1), 1000):
                own = batch.slice(at, 1000)
                ids = [x + end for x in encode_documents(texts[at:at + 1000], path)]
                n = [len(x) // 4 for x in ids]
                before, rank = [], []
                for k in n:
                    before.append(full_so_far)
                    full_so_far += k // window
                    rank.append(ranks.get(k % window, 0))
                    ranks[k % window] = rank[-1] + 1
                yield pa.RecordBatch.from_arrays(
                    [own.column("_row"), own.column("_id"), pa.array([part] * len(n), pa.int64()), *(pa.array(x, pa.int64()) for x in (n, [k // window for k in n], before, [k % window for k in n], rank)), pa.array(ids, pa.binary())],
                    names=["_row", "_id", "_part", "tokens", "_full", "_full_before", "_class", "_rank", "_ids"],
                )

    own = numbered(docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")))
    return own.mapInArrow(made, "_row long, _id long, _part long, tokens long, _full long, _full_before long, _class long, _rank long, _ids binary")


def fill(gap: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths with the sum closest to gap from below, by bitset subset sums; longest lengths first."""
    mask, reach, steps = (1 << (gap + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= gap and counts[x] > 0), reverse=True):
        left, size = min(counts[length], gap // length), 1
        while left:
            size = min(size, left)
            steps.append((length, size, reach))
            reach |= (reach << (length * size)) & mask
            left -= size
            size *= 2
        if reach >> gap & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, size, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + size
            total -= length * size
    return taken


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int, int]]:
    """Placements (class, first, last + 1, start, length, sequence of the first, offset) of all remainders.

    Remainders first..last of a class put `length` ids from `start` on into sequences counted up from the one given.
    """
    counts = {x: n for x, n in counts.items() if n > 0}
    queues = {x: deque([(x, 0, n, 0)]) for x, n in counts.items()}
    placed, sequence = [], 0

    def place(length: int, times: int, offset: int, cut: int | None = None) -> None:
        """Put `times` remainders of a length into the next sequences; `cut` ids of each, the rest goes back."""
        at, left = sequence, times
        while left:
            kind, first, n, start = queues[length].popleft()
            use = min(n, left)
            if use < n:
                queues[length].appendleft((kind, first + use, n - use, start))
            placed.append((kind, first, first + use, start, length if cut is None else cut, at, offset))
            if cut is not None:
                rest = length - cut
                queues.setdefault(rest, deque()).append((kind, first, use, start + cut))
                counts[rest] = counts.get(rest, 0) + use
            at += use
            left -= use
        counts[length] -= times

    while any(counts.values()):
        longest = max(x for x, n in counts.items() if n)
        counts[longest] -= 1
        pattern = fill(window - longest, counts)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        slack = window - sum(x * m for x, m in pattern.items())
        times = min(counts[x] // m for x, m in pattern.items())
        cut = None
        if slack:
            spare = [x for x, n in counts.items() if n > pattern.get(x, 0) and x > slack]
            if spare:
                cut = max(spare)
                times = min(counts[x] // (pattern.get(x, 0) + (x == cut)) for x in {*pattern, cut})
            else:
                times = 1
        offset = 0
        for length in sorted(pattern, reverse=True):
            for _ in range(pattern[length]):
                place(length, times, offset)
                offset += length
        if cut:
            place(cut, times, offset, slack)
        sequence += times
    return placed


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: _row, _id, start, length, tokens (of the document, with the end id), sequence_id, offset, ids.

    `ids` are little-endian 32-bit. Null and empty texts are the end id alone; repeated rows and ids are packed one by one; an empty
    table gives no pieces. All sequences but at most one are full. Other columns are not read.
    """
    spark = docs.sparkSession
    at = scratch_path(spark, "pack-ids")
    tokenised(docs, tokenizer, id, text, window, end_id).write.option("compression", "zstd").parquet(at)
    tokens = spark.read.parquet(at)
    parts = tokens.groupBy("_part").agg(F.sum("_full").alias("_n"))  # one row per input task
    before = parts.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    n_full = parts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    whole = tokens.filter("_full > 0").join(F.broadcast(before), "_part").withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_full") - 1)))
    bytes_of = F.lit(4 * window)
    whole = whole.select(
        "_row", "_id", (F.col("_k") * window).alias("start"), F.lit(window).cast("long").alias("length"), "tokens",
        (F.col("_before") + F.col("_full_before") + F.col("_k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.substring("_ids", (F.col("_k") * bytes_of + 1).cast("int"), bytes_of).alias("ids"),
    )
    rest = tokens.filter("_class > 0")
    tally = rest.groupBy("_class", "_part").agg(F.count(F.lit(1)).alias("_n"))
    counts = {r[0]: r[1] for r in tally.groupBy("_class").agg(F.sum("_n")).collect()}  # at most window - 1 rows
    schema = "_class long, _first long, _end long, _start long, length long, _sequence long, offset long"
    places = spark.createDataFrame(plan(counts, window), schema)
    earlier = tally.select("_class", "_part", F.coalesce(F.sum("_n").over(W.partitionBy("_class").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    tails = rest.select("_row", "_id", "_part", "_class", "_rank", "tokens", "_full", F.substring("_ids", (F.col("_full") * bytes_of + 1).cast("int"), bytes_of).alias("_tail"))
    ranked = tails.join(earlier, ["_class", "_part"]).withColumn("_global", F.col("_rank") + F.col("_earlier"))
    inside = (F.col("_global") >= F.col("_first")) & (F.col("_global") < F.col("_end"))
    tails = ranked.join(F.broadcast(places.withColumnRenamed("_class", "_c")), (F.col("_class") == F.col("_c")) & inside).select(
        "_row", "_id", (F.col("_full") * window + F.col("_start")).alias("start"), "length", "tokens",
        (F.col("_sequence") + (F.col("_global") - F.col("_first")) + n_full).alias("sequence_id"), "offset",
        F.substring("_tail", (F.col("_start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("ids"),
    )
    return whole.unionByName(tails)
