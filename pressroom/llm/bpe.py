"""Byte-level BPE by a segment tree over byte positions, and decoding of its ids.

The rank file's pattern splits a text into pieces, and each piece is merged on its own. A piece's tree has a leaf per byte position
that holds the rank of the pair which starts there (a token and its live right neighbour) followed by the position, so the root is the leftmost pair of
least rank. A merge writes the new token at that position, links it with the next live one, and updates three leaves: its own, the one of its
left neighbour and the one of the token that went. Each is a walk to the root.

Short pieces are merged together: one array holds the trees of all new pieces of a batch, and a step does one merge in each. Long
pieces have a tree of their own. Pieces of a worker are kept, so a word is merged once; this changes no result and is bounded by
CACHE_PIECES and LONGEST_CACHED.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

RUN_CHARS = 1 << 22
CACHE_PIECES = 600_000
LONGEST_CACHED = 48
TREE_BYTES = 64  # pieces up to this long are merged together
TOGETHER = 1 << 14
NONE = np.iinfo(np.int64).max
_STATE = {}

# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Vocabulary:
    """Tokens by rank, the rank of each pair of tokens whose bytes together are a token, and the splitting pattern."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(t): int(r) for t, r in pairs}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        self.bytes = np.zeros(256, np.int64)
        keys = []
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
            if len(token) == 1:
                self.bytes[token[0]] = rank
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append((left * self.size + right, rank))
        self.pairs = dict(keys)
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        self.pattern = regex.compile(pattern)
        self._split = pattern

    def unlike(self) -> tuple[frozenset[str], regex.Pattern]:
        """Characters that the tiktoken library's Unicode version does not count as letters or numbers, and the pattern without them.

        The library is asked for its classes once per worker.
        """
        if not hasattr(self, "_unlike"):
            import tiktoken

            every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
            single, odd, pattern = {bytes([b]): b for b in range(256)}, {}, self._split
            for name in ("L", "N"):
                known = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}+", mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
                odd[name] = set(regex.findall(rf"\p{{{name}}}", every)) - set(bytes(known).decode())
                listed = "".join(map(regex.escape, sorted(odd[name])))
                if listed:
                    pattern = pattern.replace(rf"[^\s\p{{L}}\p{{N}}]", "\x00").replace(rf"\p{{{name}}}", rf"[\p{{{name}}}--[{listed}]]").replace("\x00", rf"[^\s\p{{L}}\p{{N}}]")
            both = frozenset(odd["L"] | odd["N"])
            if both:
                pattern = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{''.join(map(regex.escape, sorted(both)))}]]")
            self._unlike = both, regex.compile(pattern, regex.V1)
        return self._unlike

    def split(self, text: str) -> list[str]:
        if not text.isascii():
            odd, exact = self.unlike()
            if not odd.isdisjoint(text):
                return exact.findall(text)
        return self.pattern.findall(text)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where its bytes are no token."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)


def vocabulary(path: str) -> Vocabulary:
    if _STATE.get("path") != path:
        _STATE.update(path=path, vocabulary=Vocabulary(path), parts={}, pieces={})
    return _STATE["vocabulary"]


def merge_together(vocab: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Ids of pieces of at least two bytes, as little-endian 32-bit numbers; all trees have the size of the longest piece's."""
    n, width = len(pieces), 1 << (max(map(len, pieces)) - 1).bit_length()
    lengths = np.fromiter(map(len, pieces), np.int64, n)
    inside = np.arange(width) < lengths[:, None]
    token = np.zeros((n, width), np.int64)
    token[inside] = vocab.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.where(inside, np.arange(1, width + 1), width)  # the next live position; a piece's length past its end
    before = np.tile(np.arange(-1, width - 1), (n, 1))
    live = inside.copy()
    tree = np.full((n, 2 * width), NONE)
    paired = np.arange(1, width) < lengths[:, None]
    rank = vocab.rank_of(token[:, :-1], token[:, 1:])
    known = paired & (rank != NONE)
    tree[:, width:-1] = np.where(known, rank * width + np.arange(width - 1), NONE)
    level = width
    while level > 1:
        np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2], out=tree[:, level // 2:level])
        level //= 2

    def update(own: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        node = width + at
        tree[own, node] = value
        while node[0] > 1:  # all leaves are equally deep
            node = node >> 1
            tree[own, node] = np.minimum(tree[own, 2 * node], tree[own, 2 * node + 1])

    def pair(own: np.ndarray, at: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The leaf of the pair that starts at `at`; none where it has no right neighbour."""
        some = right < lengths[own]
        out = np.full(len(own), NONE)
        rank = vocab.rank_of(token[own[some], at[some]], token[own[some], right[some]])
        out[some] = np.where(rank == NONE, NONE, rank * width + at[some])
        return out

    own = np.flatnonzero(tree[:, 1] != NONE)
    while len(own):
        least = tree[own, 1]
        at, rank = least % width, least // width
        gone = after[own, at]
        right = after[own, gone]
        token[own, at] = rank
        after[own, at] = right
        live[own, gone] = False
        linked = right < lengths[own]
        before[own[linked], right[linked]] = at[linked]
        update(own, gone, np.full(len(own), NONE))
        update(own, at, pair(own, at, right))
        left = before[own, at]
        has = left >= 0
        if has.any():
            update(own[has], left[has], pair(own[has], left[has], at[has]))
        own = own[tree[own, 1] != NONE]
    flat, ends = token[live].astype("<u4").tobytes(), np.r_[0, np.cumsum(live.sum(axis=1))] * 4
    return [flat[ends[i]:ends[i + 1]] for i in range(n)]


def merge_alone(vocab: Vocabulary, piece: bytes) -> bytes:
    """Ids of one long piece. A walk to the root ends where a node stays as it was."""
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    first = vocab.bytes[np.frombuffer(piece, np.uint8)]
    rank = vocab.rank_of(first[:-1], first[1:])
    built = np.full(2 * width, NONE)
    built[width:width + n - 1] = np.where(rank == NONE, NONE, rank * width + np.arange(n - 1))
    level = width
    while level > 1:
        np.minimum(built[level:2 * level:2], built[level + 1:2 * level:2], out=built[level // 2:level])
        level //= 2
    tree, token = array("q", built.tobytes()), array("q", first.tobytes())
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    pairs, size, none = vocab.pairs, vocab.size, int(NONE)

    def update(at: int, value: int) -> None:
        node = width + at
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            least = value if value < other else other
            if tree[node] == least:
                return
            tree[node] = value = least

    while (least := tree[1]) != none:
        rank, at = divmod(least, width)
        gone = after[at]
        right = after[gone]
        token[at] = rank
        token[gone] = -1
        after[at] = right
        update(gone, none)
        found = None
        if right < n:
            before[right] = at
            found = pairs.get(rank * size + token[right])
        update(at, none if found is None else found * width + at)
        left = before[at]
        if left >= 0:
            found = pairs.get(token[left] * size + rank)
            update(left, none if found is None else found * width + left)
    ids = np.frombuffer(token, np.int64)
    return ids[ids >= 0].astype("<u4").tobytes()


def merge(vocab: Vocabulary, pieces: Iterable[bytes]) -> dict[bytes, bytes]:
    """Ids of each distinct piece. A piece that is a token as a whole is that token."""
    out, short = {}, {}
    for piece in pieces:
        rank = vocab.ranks.get(piece)
        if rank is not None:
            out[piece] = rank.to_bytes(4, "little")
        elif len(piece) > TREE_BYTES:
            out[piece] = merge_alone(vocab, piece)
        elif piece:
            short.setdefault(max(3, (len(piece) - 1).bit_length()), []).append(piece)
    for same in short.values():
        for i in range(0, len(same), TOGETHER):
            out.update(zip(same[i:i + TOGETHER], merge_together(vocab, same[i:i + TOGETHER]), strict=True))
    return out


def parts_of(vocab: Vocabulary, text: str) -> tuple[list[str], bool]:
    """Runs of whole pieces in order, and whether each is a single piece.

    No piece crosses a single blank that stands before a character that is not white space, so a text is cut before these; with other white space next to
    a blank it is split by the pattern as a whole.
    """
    first, *rest = text.split(" ")
    if all(p and not p[0].isspace() for p in rest):
        return [first, *(" " + p for p in rest)], False
    return vocab.split(text), True


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit numbers, as the tiktoken library's encode_ordinary gives them."""
    vocab = vocabulary(path)
    parts, pieces = _STATE["parts"], _STATE["pieces"]
    if len(parts) + len(pieces) > CACHE_PIECES:
        parts.clear()
        pieces.clear()
    cut = [parts_of(vocab, t) for t in texts]
    new_parts = {p for own, single in cut if not single for p in own if p not in parts}
    split = {p: vocab.split(p) for p in new_parts}
    wanted = {x for own in split.values() for x in own}
    wanted.update(p for own, single in cut if single for p in own)
    made = {x: pieces.get(x) for x in wanted}
    unseen = {x: x.encode() for x, ids in made.items() if ids is None}
    found = merge(vocab, dict.fromkeys(unseen.values()))
    made.update((x, found[raw]) for x, raw in unseen.items())
    whole = {p: b"".join([made[x] for x in own]) for p, own in split.items()}
    out = [b"".join([made[p] for p in own]) if single else b"".join([parts[p] if p in parts else whole[p] for p in own]) for own, single in cut]
    parts.update((p, ids) for p, ids in whole.items() if len(p) <= LONGEST_CACHED)
    pieces.update((x, made[x]) for x in unseen if len(x) <= LONGEST_CACHED)
    return out


def decode_ids(ids: bytes, path: str) -> bytes:
    """The bytes of the tokens of little-endian 32-bit ids."""
    tokens = vocabulary(path).tokens
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _groups(column: pa.Array, size_of) -> Iterable[list]:
    """The values of a column, about RUN_CHARS at a time."""
    held, size = [], 0
    for value in column:
        held.append(value.as_py())
        size += size_of(held[-1])
        if size >= RUN_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: _id, n_tokens, ids (binary, little-endian unsigned 32-bit).

    Null and empty texts have no ids. Repeated rows and ids, null ids included, each give their own row; other columns are not read; an
    empty table gives no rows. Texts of any length are encoded whole. `path` is a rank file that every executor can open; one map, no shuffle.
    """
    def made(batches):
        for batch in batches:
            at = 0
            for texts in _groups(batch.column("_text"), lambda t: len(t or "")):
                ids = encode_texts([t or "" for t in texts], path)
                own = batch.column("_id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([own, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=["_id", "n_tokens", "ids"])

    return docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")).mapInArrow(made, "_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """encoded with one more column, the decoded bytes (null where ids are null)."""
    fields = [f for f in encoded.schema.fields if f.name != name]
    kept = encoded.select(*[F.col(f"`{f.name}`") for f in fields])

    def made(batches):
        for batch in batches:
            at = 0
            for some in _groups(batch.column(ids), lambda x: len(x or b"")):
                out = [None if x is None else decode_ids(x, path) for x in some]
                own = batch.slice(at, len(some))
                at += len(some)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(out, pa.binary())], names=[*own.schema.names, name])

    return kept.mapInArrow(made, StructType([*kept.schema.fields, StructField(name, BinaryType())]))
