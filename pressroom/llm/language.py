"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

A text is its subwords (3 to 5 letters, word ends included) hashed into a fixed number of buckets. Training is
stochastic gradient descent in numpy on a bounded, hash-chosen sample of labelled documents (`sample_rows`, split evenly
over the languages); the driver gets bucket counts of that sample, not texts. Because the softmax is linear in the average, a
prediction needs one row of logits per bucket: every whole text is scored in one map without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom.llm.words import mix, numbered
from pressroom.session import materialize

BUCKETS = 1 << 16
SIZES = (3, 4, 5)
DIM = 16
SAMPLE_ROWS = 2400
EPOCHS = 5
RATE = 1.0
MOST_ERROR = 0.01
SPACE = 32
RUN_CHARS = 1 << 19
_STEPS = np.random.default_rng(7).integers(1, 2**63, max(SIZES), dtype=np.uint64) | np.uint64(1)
_FOLD = {}


def fold_table() -> np.ndarray:
    """Code point -> its lower case; all that is no letter becomes a space."""
    if "table" not in _FOLD:
        table = np.full(0x110000, SPACE, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _FOLD["table"] = table
    return _FOLD["table"]


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of all texts in turn, and the text of each."""
    codes = fold_table()[np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)]
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), lengths)
    space = codes == SPACE
    keep = ~space | np.r_[False, ~space[:-1]]  # one space after each word
    codes, owner, space = codes[keep], owner[keep], space[keep]
    codes, owner, space = np.r_[np.uint32(SPACE), codes], np.r_[owner[:1], owner], np.r_[True, space]
    found, owners = [], []
    wide = codes.astype(np.uint64)
    for n in SIZES:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        total, inner = np.zeros(m, np.uint64), np.zeros(m, bool)
        for i in range(n):
            total += wide[i:i + m] * _STEPS[i]
            if 0 < i < n - 1:
                inner |= space[i:i + m]
        whole = np.flatnonzero(~inner)
        found.append((mix(total[whole] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(owner[whole + n - 1 - space[whole + n - 1]] if len(whole) else owner[:0])
    return (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def pieces(text: str, limit: int = RUN_CHARS) -> list[str]:
    """A very long text in parts cut after a white space where there is one."""
    parts, start = [], 0
    while len(text) - start > limit:
        cut = max(text.rfind(" ", start, start + limit), text.rfind("\n", start, start + limit)) + 1
        cut = cut if cut > start else start + limit
        parts.append(text[start:cut])
        start = cut
    return [*parts, text[start:]]


def text_runs(texts: list[str | None]):
    """(places, texts) of about RUN_CHARS characters; a place may come again for a long text."""
    places, own, size = [], [], 0
    for i, text in enumerate(texts):
        for part in pieces(text or ""):
            places.append(i)
            own.append(part)
            size += len(part)
            if size >= RUN_CHARS:
                yield np.array(places), own
                places, own, size = [], [], 0
    if own:
        yield np.array(places), own


def _counts(batches):
    for batch in batches:
        texts = batch.column("_text").to_pylist()
        keys, sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for places, own in text_runs(texts):
            bucket, owner = subwords(own)
            pair, n = np.unique(places[owner] * BUCKETS + bucket, return_counts=True)
            keys, at = np.unique(np.r_[keys, pair], return_inverse=True)  # a long text may go on in the next run
            sizes = np.bincount(at, np.r_[sizes, n], len(keys)).astype(np.int64)
        cuts = np.searchsorted(keys, np.arange(1, len(texts)) * BUCKETS)
        found = [np.split(x.astype("<i4"), cuts) if len(texts) else [] for x in (keys % BUCKETS, sizes)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_lang"), *(pa.array([x.tobytes() for x in own], pa.binary()) for own in found)],
            names=["_row", "_lang", "_buckets", "_n"],
        )


class Model:
    """Languages, logits per bucket, bias, temperature and the least score to accept."""

    def __init__(self, languages, logits, bias, temperature=1.0, least=0.0):
        self.languages, self.logits, self.bias, self.temperature, self.least = languages, logits, bias, temperature, least


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 3) -> Model | None:
    """Train on (language, buckets, counts). One row in five only calibrates temperature and rejection."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    place = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return Model(languages, vectors @ weights, bias)
    label = np.array([place[r[0]] for r in rows])
    aside = np.arange(len(rows)) % 5 == 4 if len(rows) >= 20 else np.zeros(len(rows), bool)
    train = np.flatnonzero(~aside)
    steps = epochs * -(-len(train) // 16)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(train)
        for at in range(0, len(order), 16):
            own = order[at:at + 16]
            index = np.concatenate([rows[i][1] for i in own])
            sizes = np.array([len(rows[i][1]) for i in own])
            share = np.concatenate([rows[i][2] / rows[i][2].sum() for i in own]).astype(np.float32)
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            hidden = np.add.reduceat(vectors[index] * share[:, None], starts)
            error = softmax(hidden @ weights + bias)
            error[np.arange(len(own)), label[own]] -= 1
            now = rate * (1 - step / steps)
            back = (error @ weights.T).astype(np.float32)
            weights -= now * (hidden.T @ error)
            bias -= now * 0.1 * error.mean(axis=0)
            # a bucket's step is scaled by the number of buckets its text averages over
            pull = now * back * sizes[:, None] * 0.05
            for i, at_row, n in zip(range(len(own)), starts.tolist(), sizes.tolist(), strict=True):  # a text has each bucket once
                part = slice(at_row, at_row + n)
                vectors[index[part]] -= share[part, None] * pull[i]
            step += 1
    logits = (vectors @ weights).astype(np.float32)
    model = Model(languages, logits, bias.astype(np.float32))
    if aside.any():
        z = np.array([(logits[rows[i][1]] * (rows[i][2] / rows[i][2].sum())[:, None]).sum(axis=0) + bias for i in np.flatnonzero(aside)])
        truth = label[aside]
        grid = np.exp(np.linspace(-3, 3, 61))
        loss = [-np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / model.temperature)
        score, right = p.max(axis=1), p.argmax(axis=1) == truth
        order = np.argsort(-score)
        error = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(error <= MOST_ERROR)
        model.least = float(score[order[good[-1]]]) if len(good) else 1.0
    return model


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", learn: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on at most `sample_rows` labelled rows (of those that `learn` allows), chosen by a hash of id and row; None without any."""
    own = numbered(docs).select("_row", F.col(id).cast("string").alias("_id"), F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"), (learn if learn is not None else F.lit(True)).alias("_learn"))
    known = own.filter("_learn and _lang is not null").drop("_text")
    sizes = materialize(known.groupBy("_lang").agg(F.count(F.lit(1)).alias("_all")), "languages")
    n = sizes.count()
    if not n:
        return None
    least = max(10, sample_rows // n)
    # four times as many rows as needed are expected below the limit, so the window gets a bounded number of rows per language
    near = known.withColumn("_place", F.xxhash64("_id", "_row")).join(sizes, "_lang").filter(F.col("_place") / 2.0**64 + 0.5 <= 4.0 * least / F.col("_all"))
    order = W.partitionBy("_lang").orderBy("_place", "_row")
    chosen = materialize(near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= least).select("_row"), "sample")
    rows = own.select("_row", "_lang", "_text").join(chosen, "_row", "left_semi").mapInArrow(_counts, "_row long, _lang string, _buckets binary, _n binary")
    found = sorted(rows.collect())  # sample_rows vectors of at most BUCKETS counts
    return fit([(r[1], np.frombuffer(r[2], "<i4").astype(np.int64), np.frombuffer(r[3], "<i4").astype(np.float64)) for r in found])


def predict(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: _row, _id, lang_pred, score, accepted.

    `und` with score 0 where the text is null or has no letter, or nothing was learned. `accepted` is false for those and for
    scores below the calibrated limit. Whole texts count; repeated rows are scored one by one; no other column is read.
    """
    # plain arrays, BUCKETS x languages numbers, whatever the corpus
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else (model.languages, model.logits, model.bias, model.temperature, model.least))

    def scored(batches):
        own = shared.value
        languages, logits, bias, temperature, least = own or ([], None, None, 1.0, 0.0)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            name, score = ["und"] * len(texts), np.zeros(len(texts))
            if own is not None and texts:
                total, n = np.zeros((len(texts), len(languages))), np.zeros(len(texts))
                for places, parts in text_runs(texts):
                    bucket, owner = subwords(parts)
                    if not len(bucket):
                        continue
                    for c in range(len(languages)):
                        sums = np.bincount(owner, logits[:, c][bucket], len(parts))
                        np.add.at(total[:, c], places, sums)
                    np.add.at(n, places, np.bincount(owner, minlength=len(parts)))
                letters = np.flatnonzero(n > 0)
                if len(letters):
                    p = softmax((total[letters] / n[letters, None] + bias) / temperature)
                    score[letters] = p.max(axis=1)
                    for i, best in zip(letters.tolist(), p.argmax(axis=1).tolist(), strict=True):
                        name[i] = languages[best]
            took = [x != "und" and s >= least for x, s in zip(name, score, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_id"), pa.array(name, pa.string()), pa.array(score), pa.array(took, pa.bool_())], names=["_row", "_id", "lang_pred", "score", "accepted"])

    own = numbered(docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")))
    return own.mapInArrow(scored, "_row long, _id long, lang_pred string, score double, accepted boolean")
