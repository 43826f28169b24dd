"""Hard negatives, centroid clustering and byte-level BPE on small and odd inputs, against brute force."""

import base64
import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressroom.llm import bpe, centroids, hard_negatives
from pressroom.llm.queries import QUERIES
from pressroom.session import materialize

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, _a string, _v string, _anchor int, _b int, ids string, cluster int"


def vector_rows(n, dims=6, labels=3, seed=3):
    rnd = random.Random(seed)
    return [(i, [round(rnd.uniform(-1, 1), 3) for _ in range(dims)], rnd.randrange(labels)) for i in range(n)]


ODD = vector_rows(60) + [
    (100, [0.5] * 6, 1), (101, [0.5] * 6, 1), (102, [0.5] * 6, 2), (103, [0.5] * 6, 2), (103, [0.5] * 6, 2), (104, [0.5] * 6, 0), (10, [0.5] * 6, 2),
    (None, [0.5] * 6, 1), (105, None, 1), (106, [0.5] * 6, None), (107, [0.5, None] + [0.1] * 4, 1), (108, [NAN] * 6, 1), (109, [INF] + [0.0] * 5, 2),
    (110, [], 1), (111, [0.9, 0.8], 2), (112, [3e12] * 6, 0), (113, [-4e11] * 6, 1), (114, [1e300] * 6, 2), (120, [0.0] * 6, 1),
]


def frame(spark, rows):
    return materialize(spark.createDataFrame([(*r, "x", "x", 1, 1, "x", 1) for r in rows], SCHEMA).coalesce(3), "vectors")


def floors(v, scale):
    return [max(-2**63, min(2**63 - 1, math.floor(x * scale))) for x in v]


def long_(x):
    return max(-(2**63 - 1), min(2**63 - 1, x))


def negatives_of(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    kept = [(i, floors(v, 256), c) for i, v, c in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, x, label in kept:
        if is_anchor(a):
            scores = sorted(((long_(sum(p * q for p, q in zip(x, y, strict=False))), i, c) for i, y, c in kept), key=lambda s: (-s[0], s[1]))
            for s, p, _ in [t for t in scores if t[2] == label and t[1] != a][:positives]:
                fit = [t for t in scores if t[2] != label and low * s <= 100 * t[0] <= high * s][:negatives]
                out += [(a, p, k + 1, t[1], s, t[0]) for k, t in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 4096, 32), (7, 2, 1)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, blocks):
    for name, n in zip(("ROW_BLOCK", "ANCHOR_BLOCK", "LEAST_BLOCKS"), blocks, strict=True):
        monkeypatch.setattr(hard_negatives, name, n)
    got = hard_negatives.mine(frame(spark, ODD), F.col("vec_id") % 5 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == negatives_of(ODD, lambda a: a % 5 == 0)
    few = hard_negatives.mine(frame(spark, ODD[:40]), F.col("vec_id") % 4 == 0, positives=2, negatives=7, low=-20, high=60)
    assert sorted(map(tuple, few.collect())) == negatives_of(ODD[:40], lambda a: a % 4 == 0, 2, 7, -20, 60)


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(frame(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.mine(frame(spark, ODD), F.lit(False)).count() == 0
    assert hard_negatives.mine(frame(spark, ODD), F.lit(None).cast("boolean")).count() == 0


def clusters_of(rows, k, rounds, dims, scale, seed="1"):
    kept = [(i, floors(v, scale)) for i, v, _ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((p - q) ** 2 for p, q in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for j, own in groups.items():
            centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, d, j in found:
        inertia[j] += long_(d)
    return sorted((str(i), j, long_(d), long_(inertia[j]), long_(sum(inertia.values())), centres[j]) for i, d, j in found)


@pytest.mark.parametrize("rows", [ODD, ODD[:66], ODD[:5], [ODD[60]] * 30, vector_rows(400, seed=9)])
def test_clusters_equal_brute_force(spark, rows):
    got = centroids.cluster(frame(spark, rows), k=8, rounds=3, dims=6, scale=64)
    assert sorted((str(r[0]), *map(lambda x: x, r[1:])) for r in got.collect()) == clusters_of(rows, 8, 3, 6, 64)


def test_clusters_of_nothing(spark):
    assert centroids.cluster(frame(spark, []), dims=6).count() == 0
    assert centroids.cluster(frame(spark, ODD), dims=5).count() == 0


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(8)
    middle = rnd.integers(-60, 60, (16, 64))
    x = np.concatenate([m + rnd.integers(-6, 7, (300, 64)) for m in middle])
    pivots = centroids.choose_pivots(x[:64 * 37:37], centroids.PIVOTS)
    between, own = centroids.to_pivots(pivots, pivots), centroids.to_pivots(x, pivots)
    exact = np.stack([centroids.squared(x, c) for c in middle], axis=1)
    assert (centroids.lower_bounds(own, centroids.to_pivots(middle, pivots), between) <= exact).all()
    cluster, distance, compared = centroids.assign(x, own, middle, pivots, between)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert compared < 0.8 * exact.size
    assert len(centroids.choose_pivots(np.repeat(x[:1], 9, axis=0), 6)) == 1


@pytest.fixture(scope="module")
def ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library(ranks):
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def ids_of(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_pattern_is_the_files_pattern():
    import public_tokenizers

    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_ids_equal_the_library(ranks, library):
    rnd = random.Random(5)
    bits = [
        "a", "b", "the", "ing", " ", "  ", "\n", "\t", "\r\n", "'s", "'re", "'", "''", "!", "1", "23", "é", "漢字", "🎣", " ", " ", "\x1c", "՘", "₏",
        "\U00011de0", "́", "ß", "مرحبا", "\x00", "\x85", "<|endoftext|>", "�", "​", "Ⅷ", "٣", "internationalisation", "zzzzqqqq",
    ]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(10_000)]
    texts += ["".join(rnd.choice("abcdefghij") for _ in range(n)) for n in (2, 63, 64, 65, 127, 128, 129, 5000)] + ["a" * 30_000, "ab" * 3_000 + "é" * 3_000, "=-" * 4_000]
    got = [x for i in range(0, len(texts), 700) for x in bpe.encode_texts(texts[i:i + 700], ranks)]
    assert [t for t, x in zip(texts, got, strict=True) if x != ids_of(library, t)] == []
    assert all(bpe.decode_ids(x, ranks) == t.encode() for t, x in zip(texts, got, strict=True))


def test_every_character_splits_as_in_the_library(ranks, library):
    texts = ["".join(f"a{chr(c)}1{chr(c)}" for c in range(first, first + 64) if not 0xD800 <= c < 0xE000) for first in range(0, 0x32000, 64)]
    got = bpe.encode_texts(texts, ranks)
    assert [t for t, x in zip(texts, got, strict=True) if x != ids_of(library, t)] == []


def test_leftmost_least_pair_first(tmp_path):
    """A made-up rank file: ties go to the left, and a token that no merge reaches is still the whole piece."""
    tokens = [bytes([b]) for b in range(256)] + [b"aa", b"ab", b"aab", b"bc", b"xyz"]
    file = tmp_path / "small.tiktoken"
    file.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    vocab = bpe.Vocabulary(str(file))
    names = {"aaaaa": ["aa", "aa", "a"], "aab": ["aab"], "aaab": ["aa", "ab"], "abc": ["ab", "c"], "xyz": ["xyz"], "xyzx": list("xyzx"), "aaabc": ["aa", "ab", "c"]}
    for made in (bpe.merge(vocab, [x.encode() for x in names]), {x.encode(): bpe.merge_alone(vocab, x.encode()) for x in names if x not in ("xyz", "aab")}):
        for piece, ids in made.items():
            assert [tokens[i].decode() for i in np.frombuffer(ids, "<u4")] == names[piece.decode()]


def test_encode_and_decode_of_odd_rows(spark, ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "RUN_CHARS", 50)
    texts = [None, "", " ", "one two", "one two", "x" * 3000, "two  blanks", "tail \n", "퟿", "漢 字"]
    rows = [(i if i != 4 else 3, t, "ids", 5, b"d") for i, t in enumerate(texts)] + [(None, "one", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, decoded binary").coalesce(2)
    made = bpe.decode(bpe.encode(docs, ranks), ranks)
    assert made.columns == ["_id", "n_tokens", "ids", "decoded"]
    want = sorted((str(r[0]), len(ids_of(library, r[1] or "")) // 4, ids_of(library, r[1] or ""), (r[1] or "").encode()) for r in rows)
    assert sorted((str(r[0]), r[1], bytes(r[2]), bytes(r[3])) for r in made.collect()) == want
    assert bpe.encode(docs.limit(0), ranks).count() == 0
    again = bpe.decode(docs.select("doc_id", F.lit(None).cast("binary").alias("ids"), "decoded"), ranks)
    assert again.filter("decoded is not null").count() == 0 and again.count() == len(rows)


def test_bpe_query_on_all_documents(spark, small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op13_byte_bpe"](spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = ids_of(library, docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
