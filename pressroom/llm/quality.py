"""Quality rules whose cutoffs come with a bound on false rejections.

The labelled documents are halved by a hash of their words, and equal texts count once, with the worse of their labels, so that no copy of a
text that chose a cutoff tests it, and none counts twice. The first half chooses, for each stratum and rule,
whether the rule separates bad from good and how strict it may get; the second half tests cutoffs from the lenient end on
and stops at the first whose exact binomial test fails. The share `risk` of good documents that a stratum may lose is
divided among its rules, the error probability `delta` among all tests of all strata (Bonferroni; within one rule the
fixed order needs no further correction). So with probability 1 - delta no stratum loses more than `risk` of its good
documents to these rules. A stratum without enough labels gets no cutoff and loses nothing.

Texts are read once, in one map; only five numbers per document are stored. What comes to the driver
is a histogram of labelled documents: strata x rules x at most 1 001 bins.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.words import WHITE, grams, mix, numbered, runs, word_bounds, word_hashes
from pressroom.session import materialize

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MOST_BIN = 1000

# Rule -> (value as bin 0..1000, +1 if high values are bad, -1 if low ones are).
RULES = {
    "symbols": ("least(1000, floor(1000 * n_symbols / word_chars))", 1),
    "long_words": ("least(1000, floor(50 * word_chars / n_words))", 1),
    "short_words": ("least(1000, floor(50 * word_chars / n_words))", -1),
    "dup_lines": ("least(1000, floor(1000 * n_dup_lines / n_words))", 1),
    "repeats": ("least(1000, floor(1000 * n_repeat_words / n_words))", 1),
}
RISK, DELTA = 0.05, 0.1
LEAST_GAIN, MOST_COST, ENOUGH_MISSED = 0.1, 0.02, 0.03


def repeated_words(words: np.ndarray) -> int:
    """Words inside 3-word windows that the text has twice or more."""
    windows = grams(words, 3)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    marked = np.zeros(len(words), bool)
    for i in range(3):
        marked[i:i + len(windows)] |= again
    return int(marked.sum())


def text_key(words: np.ndarray) -> int:
    """A hash of the sequence of words."""
    place = mix(np.arange(1, len(words) + 1, dtype=np.uint64))
    return int((mix(words) * (place | np.uint64(1))).sum(dtype=np.uint64).view(np.int64))


def measured_texts(texts, keys: bool = False) -> dict[str, np.ndarray]:
    """The base numbers of each text of an Arrow string column; with `keys` also _body, the hash of its words."""
    found = {name: np.zeros(len(texts), np.int64) for name in [*FEATURES, *(["_body"] if keys else [])]}
    for first, data, bounds in runs(texts):
        n = len(bounds) - 1
        starts, ends, word = word_bounds(data, bounds)
        hashes = word_hashes(data, starts, ends)
        points = np.r_[0, np.cumsum(~WHITE[data] & ((data & 0xC0) != 0x80))]
        symbols = np.r_[0, np.cumsum(SYMBOLS[data])]
        own = slice(first, first + n)
        found["n_words"][own] = np.diff(word)
        found["word_chars"][own] = np.diff(points[bounds])
        found["n_symbols"][own] = np.diff(symbols[bounds])
        raw = data.tobytes()
        for i in range(n):
            lines = [x for x in raw[bounds[i]:bounds[i + 1]].split(b"\n") if x and not x.isspace()]
            found["n_dup_lines"][first + i] = len(lines) - len(set(lines))
            found["n_repeat_words"][first + i] = repeated_words(hashes[word[i]:word[i + 1]])
            if keys:
                found["_body"][first + i] = text_key(hashes[word[i]:word[i + 1]])
    return found


def _features(batches):
    for batch in batches:
        found = measured_texts(batch.column("_text"), keys=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_id"), batch.column("_stratum"), *(pa.array(x) for x in found.values())],
            names=["_row", "_id", "_stratum", *found],
        )


def _struct_of_features(texts: pa.Array) -> pa.Array:
    found = measured_texts(texts)
    return pa.StructArray.from_arrays([pa.array(found[k]) for k in FEATURES], names=FEATURES)


def features(docs: DataFrame, id: str = "doc_id", text: str = "text", stratum: Column | None = None) -> DataFrame:
    """_row, _id, _stratum, the base numbers of each whole text and _body, the hash of its words; a null text has none of anything."""
    own = numbered(docs.select(
        F.col(id).cast("long").alias("_id"), F.coalesce(stratum.cast("string") if stratum is not None else F.lit(""), F.lit("")).alias("_stratum"),
        F.col(text).cast("string").alias("_text"),
    ))
    return own.mapInArrow(_features, "_row long, _id long, _stratum string, " + ", ".join(f"{n} long" for n in [*FEATURES, "_body"]))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(X <= x) of n draws with chance p, as a regularised incomplete beta function (continued fraction)."""
    if x >= n:
        return 1.0
    if x < 0:
        return 0.0
    a, b, z = n - x, x + 1, 1.0 - p

    def fraction(a, b, z):
        tiny, c = 1e-300, 1.0
        d = 1.0 / max(1 - (a + b) * z / (a + 1), tiny)
        out = d
        for m in range(1, 10_000):
            for top in (m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1.0 / ((1 + top * d) or tiny)
                c = (1 + top / c) or tiny
                out *= c * d
            if abs(c * d - 1) < 1e-14:
                break
        return out

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(z) + b * math.log1p(-z))
    return front * fraction(a, b, z) / a if z < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - z) / b


def tail(counts: np.ndarray, sign: int) -> np.ndarray:
    """Documents that each cutoff rejects, by cutoff: bins at or beyond it."""
    return np.cumsum(counts[::-1])[::-1] if sign > 0 else np.cumsum(counts)


def strictest(good: np.ndarray, bad: np.ndarray, sign: int) -> tuple[float, int] | None:
    """Gain and cutoff that the first half favours; ties end in the middle. None if the rule is of no use."""
    if not good.sum() or not bad.sum():
        return None
    cost, gain = tail(good, sign) / good.sum(), tail(bad, sign) / bad.sum()
    worth = np.where((gain >= LEAST_GAIN) & (cost <= MOST_COST), gain - 5 * cost, -1.0)
    best = np.flatnonzero(worth >= worth.max() - 1e-12) if worth.max() > 0 else []
    return (float(gain[best[0]]), int(best[len(best) // 2])) if len(best) else None


def select_cutoffs(counts: dict[tuple[str, str], dict[str, np.ndarray]], risk: float = RISK, delta: float = DELTA) -> dict[str, dict[str, int]]:
    """counts[stratum, rule][half + label] are histograms over bins; the result is {stratum: {rule: cutoff}}."""
    useful: dict[str, list[tuple[float, str, int]]] = {}
    for (stratum, rule), own in counts.items():
        aim = strictest(own["fit_good"], own["fit_bad"], RULES[rule][1])
        if aim is not None:
            useful.setdefault(stratum, []).append((aim[0], rule, aim[1]))
    aims: dict[str, dict[str, int]] = {}
    for stratum, rules in useful.items():
        missed = 1.0  # share of bad documents left if rules were independent: no more rules than needed share the risk
        for gain, rule, cutoff in sorted(rules, key=lambda r: (-r[0], list(RULES).index(r[1]))):
            if missed > ENOUGH_MISSED:
                aims.setdefault(stratum, {})[rule] = cutoff
                missed *= 1 - gain
    tests = sum(len(rules) for rules in aims.values())
    found: dict[str, dict[str, int]] = {}
    for stratum, rules in aims.items():
        for rule, aim in rules.items():
            sign, good = RULES[rule][1], counts[stratum, rule]["test_good"]
            lost, n = tail(good, sign), int(good.sum())
            steps = range(MOST_BIN, aim - 1, -1) if sign > 0 else range(0, aim + 1)
            last, passed = None, {}
            for cutoff in steps:
                x = int(lost[cutoff])
                if x not in passed:
                    passed[x] = n > 0 and binomial_cdf(x, n, risk / len(rules)) <= delta / tests
                if not passed[x]:
                    break
                last = cutoff
            if last is not None:
                found.setdefault(stratum, {})[rule] = last
    return found


def calibrate(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, id: str = "doc_id", quality: str = "quality") -> dict[str, dict[str, int]]:
    """Cutoffs from labels (id, quality 0/1): null labels are left out, a document or text with two labels counts as the worse.

    The bound is on the share of different texts, drawn independently; near copies with other words are different texts.
    """
    known = labels.select(F.col(id).cast("long").alias("_id"), F.col(quality).cast("int").alias("_good")).filter("_id is not null and _good in (0, 1)")
    known = known.groupBy("_id").agg(F.min("_good").alias("_good"))
    labelled = measured.filter(~base_failed()).join(known, "_id")
    seen = labelled.groupBy("_stratum", "_body", *FEATURES).agg(F.min("_good").alias("_good"))  # equal texts count once
    half = F.when(F.pmod(F.xxhash64("_body"), F.lit(2)) == 0, "fit").otherwise("test")
    seen = seen.withColumn("_kind", F.concat(half, F.when(F.col("_good") == 1, "_good").otherwise("_bad")))
    bins = F.array(*[F.struct(F.lit(name).alias("rule"), F.expr(value).cast("int").alias("bin")) for name, (value, _) in RULES.items()])
    cells = seen.select("_stratum", "_kind", F.explode(bins).alias("_b")).groupBy("_stratum", "_kind", "_b").count()
    counts: dict[tuple[str, str], dict[str, np.ndarray]] = {}
    for stratum, kind, (rule, place), n in cells.collect():
        own = counts.setdefault((stratum, rule), {h + g: np.zeros(MOST_BIN + 1, np.int64) for h in ("fit", "test") for g in ("_good", "_bad")})
        own[kind][place] += n
    return select_cutoffs(dict(sorted(counts.items())), risk, delta)


def rejected_by(cutoffs: dict[str, dict[str, int]]) -> Column:
    """Names of the rules that reject a row, by its stratum's cutoffs."""
    hits = []
    for rule, (value, sign) in RULES.items():
        own = {s: rules[rule] for s, rules in cutoffs.items() if rule in rules}
        if own:
            cut = F.create_map(*[F.lit(x) for pair in own.items() for x in pair])[F.col("_stratum")]
            beyond = F.expr(value) >= cut if sign > 0 else F.expr(value) <= cut
            hits.append(F.when(beyond, F.lit(rule)))
    return F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")


def judge(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str | None = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per row of docs: _row, _id, the five numbers, base_failed, rejected_by (rules) and kept.

    Null and empty texts have no words and fail the base rules. Null and '' are one stratum; strata without enough labels are judged by the
    base rules only. Repeated rows are judged one by one; an empty
    table gives no rows, empty labels no cutoffs. Other columns are not read.
    """
    measured = materialize(features(docs, id, text, F.col(stratum) if stratum else None), "quality")
    rules = F.when(base_failed(), F.array().cast("array<string>")).otherwise(rejected_by(calibrate(measured, labels, risk, delta)))
    return measured.select("_row", "_id", *FEATURES, base_failed().alias("base_failed"), rules.alias("rejected_by")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)
    )


def drop_bad(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str | None = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of docs that judge keeps, with all their columns, whatever their names; an empty table gives no rows.

    Texts are measured a second time in the map that filters them, so that no text is shuffled to meet its verdict.
    """
    own = F.col(stratum) if stratum else None
    cutoffs = calibrate(materialize(features(docs, id, text, own), "quality"), labels, risk, delta)
    # not deterministic by name only: the filter stays above, so each text is measured once
    measure = F.arrow_udf(_struct_of_features, "struct<" + ", ".join(f"{n}: bigint" for n in FEATURES) + ">").asNondeterministic()
    name = own.cast("string") if own is not None else F.lit("")
    seen = docs.select(F.struct("*").alias("_doc"), F.coalesce(name, F.lit("")).alias("_stratum"), measure(F.col(text).cast("string")).alias("_m"))
    return seen.select("_doc", "_stratum", "_m.*").filter(
        ~F.when(base_failed(), F.lit(True)).otherwise(F.size(rejected_by(cutoffs)) > 0)
    ).select("_doc.*")
