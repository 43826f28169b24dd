"""License notices in whole texts: MinHash bands over overlapping windows, then exact shingle containment.

Words are runs of letters and digits, A-Z folded, so punctuation and line breaks don't matter. Templates fall into classes by their
number of five-word shingles: class s holds those with s/2 < n <= s. A text is cut into blocks of s shingles and each two
neighbouring blocks are a window, so every run of s shingles lies inside a window. Signatures hold minimum and maximum under
32 permutations; each of the 64 values is a band of its own. A notice of which three quarters are present has a similarity of at least
0.375 / 2.125 = 0.176 with its window, so it is missed with chance 0.824^64, below 1e-5; one-shingle templates use windows of one
shingle, which collide for certain. Block values of class 2s come from pairs of class s, so all classes cost little more than one.

The templates are a fixed list that every task holds; the search is one map over the texts, nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.license_texts import TEMPLATES
from pressroom.llm.words import grams, mix, numbered, runs, word_bounds, word_hashes

SHINGLE = 5
LEAST = 0.75
PERMUTATIONS = 32
PIECE = 1 << 14

_rng = np.random.default_rng(10)
SCALE = _rng.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)

BETWEEN = np.ones(256, bool)
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def without_marks(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with blanks for typographic quotes, dashes, dots and spaces (U+2000 to U+206F, U+00A0, U+00AB, U+00BB), which part words as their plain forms do."""
    if len(data) < 2 or not (data >= 128).any():
        return data
    gone = np.zeros(len(data) + 2, bool)
    general = np.flatnonzero((data[:-1] == 0xE2) & ((data[1:] == 0x80) | (data[1:] == 0x81)))
    general = general[general + 2 < len(data)]
    general = general[(data[general + 1] == 0x80) | (data[general + 2] <= 0xAF)]
    latin = np.flatnonzero((data[:-1] == 0xC2) & np.isin(data[1:], (0xA0, 0xAB, 0xBB)))
    for at, width in ((general, 3), (latin, 2)):
        for k in range(width):
            gone[at + k] = True
    return np.where(gone[:len(data)], np.uint8(0x20), data)


def text_words(column: pa.Array):
    """The word hashes of each document in order, letters folded."""
    for _, data, bounds in runs(column):
        data = without_marks(data)
        starts, ends, first = word_bounds(data, bounds, BETWEEN)
        hashes = word_hashes(data, starts, ends, True)
        for i in range(len(bounds) - 1):
            yield hashes[first[i]:first[i + 1]]


def shingles_of(words: np.ndarray) -> np.ndarray:
    """Shingle hashes in order, repeats included; a text below five words is one shingle."""
    if len(words) >= SHINGLE:
        return grams(words, SHINGLE)
    return mix(grams(words, len(words)) + np.uint64(len(words))) if len(words) else words


def text_shingles(column: pa.Array):
    """The shingle hashes of each document."""
    return map(shingles_of, text_words(column))


def size_class(n: int) -> int:
    return 1 << (n - 1).bit_length()


class Index:
    """Templates by class, with their distinct shingles and signatures."""

    def __init__(self, templates: dict[str, str]):
        names = [n for n in templates if templates[n]]
        self.names, self.sets, self.sizes = names, [], []
        self.by_class: dict[int, list[int]] = {}
        self.short: list[tuple[int, int, np.uint64]] = []  # templates below five words are found as they stand: (template, words, hash)
        for i, words in enumerate(text_words(pa.array([templates[n] for n in names], pa.string()))):
            items = shingles_of(words)
            own = np.unique(items)
            self.sets.append(own)
            self.sizes.append(len(items))
            if 0 < len(words) < SHINGLE:
                self.short.append((i, len(words), grams(words, len(words))[0]))
            elif len(own):
                self.by_class.setdefault(size_class(len(items)), []).append(i)
        self.signs = [signature(x) if len(x) else None for x in self.sets]

    def candidates(self, items: np.ndarray) -> set[int]:
        """Templates that share a band with a window of the text."""
        found = set()
        for i in self.by_class.get(1, ()):
            if (items == self.sets[i][0]).any():
                found.add(i)
        last = max(self.by_class, default=1)
        if last == 1 or not len(items):
            return found
        low = high = None
        size = 1
        while size < last:
            size *= 2
            if low is None:
                parts = [block_values(items[at:at + PIECE]) for at in range(0, len(items), PIECE)]
                low, high = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts], axis=1)
            else:
                low, high = halved(low, np.minimum), halved(high, np.maximum)
            for i in self.by_class.get(size, ()):
                if i in found:
                    continue
                sign = self.signs[i]
                if window_hit(low, sign[:PERMUTATIONS], np.less) or window_hit(high, sign[PERMUTATIONS:], np.greater):
                    found.add(i)
        return found

    def contained(self, items: np.ndarray, i: int) -> tuple[float, int, int]:
        """Largest share of the template's distinct shingles within twice its size; first and last shingle of that run."""
        own, width = self.sets[i], 2 * self.sizes[i]
        at = np.minimum(np.searchsorted(own, items), len(own) - 1)
        places = np.flatnonzero(own[at] == items)
        kinds = at[places].tolist()
        best, seen, first, count = (0, 0, 0), {}, 0, 0
        for j, p in enumerate(places.tolist()):
            seen[kinds[j]] = seen.get(kinds[j], 0) + 1
            count += seen[kinds[j]] == 1
            while places[first] <= p - width:
                seen[kinds[first]] -= 1
                count -= seen[kinds[first]] == 0
                first += 1
            if count > best[0]:
                best = (count, int(places[first]), p)
        return best[0] / len(own), best[1], best[2]


def signature(items: np.ndarray) -> np.ndarray:
    values = SCALE[:, None] * items[None, :] + SHIFT[:, None]
    return np.concatenate([values.min(axis=1), values.max(axis=1)])


def block_values(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of blocks of two shingles under every permutation."""
    values = SCALE[:, None] * items[None, :] + SHIFT[:, None]
    return halved(values, np.minimum), halved(values, np.maximum)


def halved(values: np.ndarray, pick) -> np.ndarray:
    n = values.shape[1] // 2
    out = pick(values[:, 0:2 * n:2], values[:, 1:2 * n:2])
    return out if values.shape[1] % 2 == 0 else np.concatenate([out, values[:, -1:]], axis=1)


def window_hit(blocks: np.ndarray, sign: np.ndarray, beyond) -> bool:
    """Whether some window of two neighbouring blocks has one of the template's values as its extreme."""
    same = blocks == sign[:, None]
    if not same.any():
        return False
    hidden = beyond(blocks, sign[:, None])
    left = np.concatenate([hidden[:, 1:], np.zeros((len(sign), 1), bool)], axis=1)
    right = np.concatenate([np.zeros((len(sign), 1), bool), hidden[:, :-1]], axis=1)
    return bool((same & ~(left & right)).any())


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """One row per row of docs and template found: _row, _id, license, containment, start_word, n_words.

    A template is found where at least `least` of its distinct shingles lie within a run of twice its number of shingles; one of fewer than
    five words where these stand next to one another. Words are counted as this module cuts them: runs of letters and digits, case folded,
    typographic marks like plain ones. Null and empty texts have no license; repeated rows are scanned one by one; an empty table
    or list of templates gives no rows; other columns are not read.
    """
    index = Index(dict(templates))

    def found(batches):
        for batch in batches:
            out = []
            for row, id_, words in zip(batch.column("_row").to_pylist(), batch.column("_id").to_pylist(), text_words(batch.column("_text")), strict=True):
                for i, n, own in index.short:
                    at = np.flatnonzero(grams(words, n) == own)
                    if len(at):
                        out.append((row, id_, index.names[i], 1.0, int(at[0]), n))
                items = shingles_of(words)
                for i in sorted(index.candidates(items)) if len(items) else ():
                    share, first, last = index.contained(items, i)
                    if share >= least:
                        out.append((row, id_, index.names[i], share, first, last - first + SHINGLE))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            types = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["_row", "_id", "license", "containment", "start_word", "n_words"])

    own = numbered(docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")))
    return own.mapInArrow(found, "_row long, _id long, license string, containment double, start_word long, n_words long")
