"""Words, shingles and row numbers of whole texts, as numpy arrays inside Spark tasks.

A word is `[^\\x20\\x09-\\x0D]+`. Texts are read as the UTF-8 bytes of an Arrow column, a run of
documents of about a megabyte at a time, so a batch of long texts never becomes Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.session import materialize

RUN_BYTES = 1 << 20
SEEDS = 100
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.random.default_rng(21).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_POWERS = {}


def reads_files(df: DataFrame) -> bool:
    """Whether df is columns and filters of one Parquet table, whose rows have a file and a place in it."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().head()
    return node.nodeName().startswith("LogicalRelation") and node.relation().getClass().getSimpleName() == "HadoopFsRelation" and node.relation().fileFormat().toString() == "Parquet"


def stored(df: DataFrame) -> DataFrame:
    """df where its rows can be named by file and place, else a copy of it that is written once."""
    return df if reads_files(df) else materialize(df, "stored")


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """df with a 64-bit row number, never negative: a hash of the file's path, and the row's place in the file below it.

    Unlike numbers counted in tasks these do not depend on how a scan is split, so every scan of the same files gives the same
    ones. The place takes as many bits as the longest file needs and the hash the others; one look at the paths and places, no other column,
    finds a seed with which no two files agree. Who numbers a df twice passes it through `stored` first.
    """
    df = stored(df)
    path, place = (df.metadataColumn("_metadata")[c] for c in ("file_path", "row_index"))
    files = materialize(df.select(path.alias("p"), place.alias("i")).groupBy("p").agg(F.max("i").alias("i")), "files")  # a row per file
    n, longest = files.agg(F.count(F.lit(1)), F.coalesce(F.max("i"), F.lit(0))).first()
    bits = max(1, longest.bit_length())

    def high(column: Column, seed: int) -> Column:
        return F.shiftleft(F.shiftrightunsigned(F.xxhash64(column, F.lit(seed)), bits + 1), bits)

    seed = next(s for s in range(SEEDS) if files.select(high(F.col("p"), s).alias("h")).distinct().count() == n)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], high(path, seed).bitwiseOR(place).alias(name))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: close inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the bounds of its values; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, bounds


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, bytes, bounds within them) of runs of documents of about `limit` bytes."""
    if not len(column):
        return
    data, bounds = as_bytes(column)
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def word_bounds(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each document the number of its first word (n + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~between[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(inside & (cut[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (cut[1:] | np.r_[~inside[1:], True])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS.get("n", 0) < n:
        size = max(n, RUN_BYTES) + 1
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _POWERS.update(n=size, up=np.cumprod(up), down=np.cumprod(down))
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word, from prefix sums of a rolling hash; `lower` folds A-Z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[LOWER[data] if lower else data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of n words."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total += words[i:i + count] * _STEP[i]
    return mix(total)


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Distinct n-word shingles, sorted; a shorter text is one shingle, a text without words has none."""
    if not len(words):
        return words
    return np.unique(grams(words, n)) if len(words) >= n else mix(grams(words, len(words)) + np.uint64(len(words)))


def text_words(column: pa.Array, lower: bool = False) -> Iterator[np.ndarray]:
    """The word hashes of each document in turn."""
    for _, data, bounds in runs(column):
        starts, ends, first = word_bounds(data, bounds)
        hashes = word_hashes(data, starts, ends, lower)
        for i in range(len(bounds) - 1):
            yield hashes[first[i]:first[i + 1]]
