"""Near-duplicate titles: candidate pairs from shared keys, exact verification, greedy removal.

Comparing all titles of a branch with each other does not scale, so pairs are only formed where two
titles share a key that every duplicate pair is bound to share. Rows with the same word set and event families
are one title first (a group of copies costs one row). Titles and words are numbers, and a key's rows bring their title's word
numbers, so a pair is judged where it meets: only duplicates leave the join, as two numbers, and no pair is joined with texts again
but the few whose ratio has to be worked out. The keys, with words ordered rarest first
over the whole input (any fixed order works; this one keeps the groups small):

* k shared words needed: two sets with k common words share one of their first n-k+1 words. Where
  that word is frequent, the key is the word plus one rarer-or-equal-ranked later word, which pairs
  with k >= 2 share as well. So a word in a third of all titles makes no group of its own.
* ratio from lengths alone: the common words make up a fixed part of one title's characters, so
  one of that title's rarest words up to the rest of its characters is in the other title.
* ratio from the remainders: both titles share a fixed number of letter pairs (each deleted
  character breaks at most two pairs, each inserted one at most one). At this ratio two texts need no common word
  and no common run of more than a few letters, so no key is selective; blocks of titles of near lengths are compared by matrix
  products of their letter-pair profiles instead (see letter_candidates).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import events as ev, similarity as sim, text as tx
from pressroom.functions.pairwise import subsequence
from pressroom.operators.merge import number_rows
from pressroom.operators.skew import salted_join
from pressroom.session import materialize

HOT = 1000  # a key word in more titles than this is combined with a second word
BLOCKS, LEAST_BLOCK, MOST_BLOCK = 32, 256, 8192  # titles of a block of the letter comparison: a share of all, within bounds
MOST_TASKS = 10_000
FREQUENT, MOST_FREQUENT = 4, 200_000
HOT_ROWS = 2000  # rows of a key that meet in a task; each meets each, so fewer than where a key's rows meet one by one
LENGTH_BITS = 24  # of a word's code that hold its length; the others hold its number


def distinct_titles(rows: DataFrame, group: str, title: str, order: Column, families=None, noise=None,
                    stopwords=None) -> tuple[DataFrame, DataFrame]:
    """(titles, members): one row per distinct word set and event families in a group.

    `order` is an orderable, unique rank (smallest is best). A title carries its best member's rank, and title_id numbers the titles
    of all groups by it. Members name their title by title_key; titles without any word are never duplicates and get no entry in `titles`.
    """
    normal = tx.word_normal(F.col(title))
    base = rows.withColumns({"_normal": normal, "rank": order})
    base = base.withColumns({
        "words": F.array_sort(tx.word_set(F.col("_normal"))),
        "families": ev.families(F.col("_normal"), families),
    })
    base = base.withColumn(
        "title_key", F.sha2(F.concat_ws("\u0001", F.col(group), F.array_join("words", " "), F.array_join("families", " ")), 256)
    )
    base = materialize(base, "members")  # read three times below and by callers; scored and normalised once
    titles = (
        base.filter(F.col("_normal") != "")
        .groupBy("title_key")
        .agg(F.first(group).alias("grp"), F.first("words").alias("words"), F.first("families").alias("families"), F.min("rank").alias("rank"))
    )
    titles = number_rows(titles, [F.col("rank").asc(), F.col("title_key").desc()], "title_id").withColumns({
        "meaningful": tx.meaningful(F.col("words"), stopwords),
        "entities": tx.entity_words(F.col("words"), noise),
    })
    return materialize(titles, "distinct"), base.drop("_normal", "words", "families")


def with_frequencies(titles: DataFrame, tokens: Column, group: list[str], name: str, most: int = MOST_FREQUENT) -> DataFrame:
    """Add `name`: the tokens as structs (df, token), rarest first within the group.

    Any order that all titles agree on gives right keys. Tokens in at least FREQUENT titles have their count, of the `most` most frequent ones, from
    a broadcast table of 64-bit hashes; all others count as 0. So no task sees all places of a frequent token.
    """
    single = titles.select("title_id", *group, F.explode(tokens).alias("token")).withColumn("_token", F.xxhash64(*group, "token"))
    counts = single.groupBy("_token").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= FREQUENT)
    frequent = materialize(counts.orderBy(F.desc("df"), "_token").limit(most), "frequent")  # at most `most` rows of 16 bytes
    ordered = single.join(F.broadcast(frequent), "_token", "left").groupBy("title_id").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias(name)
    )
    return titles.join(ordered, "title_id", "left")


def shared_keys(ordered: Column, keep: Column, need: int, hot: int = HOT) -> Column:
    """Keys so that two titles with `need` common kept words share one. `ordered`: (df, token) structs."""
    kept = F.filter(ordered, lambda t: F.array_contains(keep, t["token"]))
    head = F.slice(kept, 1, F.greatest(F.size(kept) - (need - 1), F.lit(0)))

    def keys_of(t: Column, i: Column) -> Column:
        later = F.slice(kept, i + 2, F.greatest(F.size(kept) - i - 1, F.lit(0)))
        paired = F.transform(later, lambda u: F.concat_ws(" ", t["token"], u["token"]))
        return F.when((t["df"] > hot) & F.lit(need >= 2), paired).otherwise(F.array(t["token"]))

    return F.flatten(F.transform(head, keys_of))


def numbered_words(titles: DataFrame, hot: int = HOT) -> tuple[DataFrame, int]:
    """(titles, last): the titles of groups with their words as numbers, rarest first; words numbered above `last` are in more than `hot` titles.

    Adds `codes`, of all words (number, then length in the last LENGTH_BITS), `m` and `e`, the numbers of the meaningful and the entity
    words, and `length`, of all words joined. A number stands for a word of a group, so equal numbers are equal words of one group.
    """
    token = F.transform("words", lambda w: F.struct(
        w.alias("token"), F.array_contains("meaningful", w).alias("m"), F.array_contains("entities", w).alias("e"),
    ))
    single = titles.select("title_id", "grp", F.inline(token))
    counts = single.groupBy("grp", "token").agg(F.count(F.lit(1)).alias("df"))
    numbered = number_rows(counts, [F.col("df"), F.col("grp"), F.col("token")], "word")
    last = numbered.filter(F.col("df") <= hot).count()
    met = salted_join(single, numbered.select("grp", "token", "word"), ["grp", "token"], F.col("title_id"), F.col("word"))
    each = F.struct("word", F.length("token").alias("length"), "m", "e")
    words = met.groupBy("title_id").agg(F.array_sort(F.collect_list(each)).alias("_w"))
    out = titles.join(words, "title_id").withColumns({
        "codes": F.transform("_w", lambda w: F.shiftleft(w["word"], LENGTH_BITS) + w["length"]),
        "m": F.transform(F.filter("_w", lambda w: w["m"]), lambda w: w["word"]),
        "e": F.transform(F.filter("_w", lambda w: w["e"]), lambda w: w["word"]),
        "length": F.length(F.array_join("words", " ")),
    })
    return materialize(out.drop("_w"), "titles"), last


FAMILY_TWO, THREE, FOUR = range(3)


def word_key(kind: int, family: Column, first: Column, second: Column | None = None) -> Column:
    return F.xxhash64(F.lit(kind), family, first, F.lit(-1).cast("bigint") if second is None else second)


def number_keys(kept: Column, need: int, last: int, kind: int, family: Column) -> Column:
    """Keys so that two titles with `need` >= 2 common kept words share the key of their first ones (first_key). `kept`: word numbers, rarest first."""
    def keys_of(t: Column, i: Column) -> Column:
        later = F.slice(kept, i + 2, F.greatest(F.size(kept) - i - 1, F.lit(0)))
        paired = F.transform(later, lambda u: word_key(kind, family, t, u))
        return F.when(t > last, paired).otherwise(F.array(word_key(kind, family, t)))

    return F.flatten(F.transform(F.slice(kept, 1, F.greatest(F.size(kept) - (need - 1), F.lit(0))), keys_of))


def first_key(common: Column, last: int, kind: int, family: Column) -> Column:
    """The one key among those two titles share for which their pair is made, given their common kept words."""
    first = F.get(common, F.lit(0))
    return F.when(first > last, word_key(kind, family, first, F.get(common, F.lit(1)))).otherwise(word_key(kind, family, first))


def covering_words(codes: Column, share: float) -> Column:
    """The numbers of the rarest words up to the point where the words left out cannot make up `share` of the characters."""
    total = F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, c: a + _letters(c) + 1)
    walk = F.aggregate(
        codes,
        F.struct(F.lit(0).cast("bigint").alias("seen"), F.array().cast("array<bigint>").alias("out")),
        lambda a, c: F.struct(
            (a["seen"] + _letters(c) + 1).alias("seen"),
            # rounding down by two characters keeps the bound safe for the joining blanks
            F.when(total - a["seen"] >= share * total - 2, F.concat(a["out"], F.array(_number(c)))).otherwise(a["out"]).alias("out"),
        ),
    )
    return walk["out"]


def _letters(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << LENGTH_BITS) - 1))


def _number(code: Column) -> Column:
    return F.shiftright(code, LENGTH_BITS)


def pair_terms(limit: float) -> tuple[float, float]:
    """(f, r) so that texts of L1 and L2 letters with a remainders' ratio of `limit` have at least f (L1 + L2) + r letter pairs in common.

    The distance is at most (1 - limit) (L1 + L2), and the mean of the two pair counts,
    (L1 + L2 + 2) / 2, shrinks by at most 1.5 per unit of distance.
    """
    return 0.5 - 1.5 * (1 - limit / 100), 1.0


def _met(left: DataFrame, right: DataFrame, facts: list[str]) -> DataFrame:
    """Titles that meet in `key`, as a and b, with the facts of either as a_* and b_*."""
    a, b = (rows.select("key", F.col("title_id").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in facts]) for rows, p in ((left, "a"), (right, "b")))
    return salted_join(a, b, ["key"], F.col("a"), F.col("b"), hot=HOT_ROWS)


def word_candidates(titles: DataFrame, last: int) -> DataFrame:
    """Pairs (better, worse, settled) by common words, each once: settled are those that satisfy a word rule, the others have four common
    meaningful words, too few for containment, so that their ratio decides."""
    some = F.size("families") > 0
    family_two = F.flatten(F.transform("families", lambda f: number_keys(F.col("e"), 2, last, FAMILY_TWO, f)))
    three = F.when(some, number_keys(F.col("e"), 3, last, THREE, F.lit(""))).otherwise(F.array().cast("array<bigint>"))
    keys = F.array_distinct(F.concat(family_two, three, number_keys(F.col("m"), 4, last, FOUR, F.lit(""))))
    keyed = titles.select("title_id", "m", "e", "families", F.explode(keys).alias("key"))
    shared = F.struct(
        F.array_intersect("a_m", "b_m").alias("m"), F.array_intersect("a_e", "b_e").alias("e"), F.array_intersect("a_families", "b_families").alias("f"),
        F.least(F.size("a_m"), F.size("b_m")).alias("smaller"), ((F.size("a_families") > 0) & (F.size("b_families") > 0)).alias("told"),
    )
    # a generator: filters on what it makes stay above it, so the sets are met once, not for every use
    met = _met(keyed, keyed, ["m", "e", "families"]).filter("a < b").select("key", "a", "b", F.explode_outer(F.array(shared)).alias("s"))
    both, m, e, f = F.col("s.smaller") > 0, F.col("s.m"), F.col("s.e"), F.col("s.f")
    by_family = both & (F.size(f) > 0) & (F.size(e) >= 2)
    by_three = both & (F.size(e) >= 3) & F.col("s.told")
    topical = both & (F.size(m) >= 4)
    own = (
        F.when(by_family, first_key(e, last, FAMILY_TWO, F.get(f, F.lit(0)))).when(by_three, first_key(e, last, THREE, F.lit("")))
        .when(topical, first_key(m, last, FOUR, F.lit("")))
    )
    settled = by_family | by_three | (F.size(m) / F.col("s.smaller") >= 0.55)
    return met.filter(F.col("key") == own).select(F.col("a").alias("better"), F.col("b").alias("worse"), settled.alias("settled"))


def length_candidates(titles: DataFrame, fuzzy: float = fv.FUZZY_DUPLICATE) -> DataFrame:
    """Pairs (a, b) whose ratio is reached by the lengths of common words alone; repeats possible, in either order."""
    share = fuzzy / (200 - fuzzy)  # common part of the covered title, from 2s / (s + L) >= fuzzy
    # the covering side shows its rarest words, the other side all of its words
    facts = ["codes", "length"]
    rare = titles.select("title_id", *facts, F.explode(covering_words(F.col("codes"), share)).alias("key"))
    every = titles.select("title_id", *facts, F.explode(F.transform("codes", _number)).alias("key"))
    shared = tx.once(F.array_intersect("a_codes", "b_codes"), lambda c: F.struct(
        F.size(c).alias("n"), (F.aggregate(c, F.lit(0).cast("bigint"), lambda s, x: s + _letters(x)) + F.size(c) - 1).alias("s"),
    ))
    met = _met(rare, every, facts).filter("a <> b").select(
        "a", "b", "a_length", "b_length", F.least(F.size("a_codes"), F.size("b_codes")).alias("smaller"), F.explode_outer(F.array(shared)).alias("c"),
    )
    s = F.col("c.s")

    def near(whole: Column) -> Column:
        return 100.0 - 100.0 * (whole - s) / (s + whole)

    return met.filter(
        (F.col("c.n") == F.col("smaller")) | (F.greatest(near(F.col("a_length")), near(F.col("b_length"))) >= float(fuzzy))
    ).select("a", "b")


def length_blocks(titles: DataFrame, rows: int) -> DataFrame:
    """titles (grp, length, title_id) with `block`: about `rows` titles of a group each, numbered in the order of their lengths.

    A length's titles are dealt over its places by hash, so one length with a third of all titles fills many blocks.
    """
    cells = titles.groupBy("grp", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("grp").orderBy("length")) - F.col("_n")  # a row per length
    placed = titles.join(cells.withColumn("_start", before), ["grp", "length"])
    return placed.withColumn("block", F.floor((F.col("_start") + F.pmod(F.xxhash64("title_id"), F.col("_n"))) / rows)).drop("_n", "_start")


def pair_profiles(texts: list[str], dims: int) -> np.ndarray:
    """A 0/1 row per text: its letter pairs, repeats numbered, hashed to `dims` places."""
    padded = [f" {t} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(t) for t in padded])
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in padded])[:-1]
    pair = (codes[:-1] << np.uint64(32)) | codes[1:]
    inside = np.ones(len(pair), bool)
    inside[ends[:-1] - 1] = False
    owner, pair = owner[inside], pair[inside]
    order = np.lexsort((pair, owner))
    owner, pair = owner[order], pair[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])])
    times = np.arange(len(pair)) - np.repeat(first, np.diff(np.r_[first, len(pair)]))
    key = (pair ^ (times.astype(np.uint64) << np.uint64(24))) * np.uint64(0x9E3779B97F4A7C15)
    out = np.zeros((len(texts), dims), np.float32)
    out[owner, (key >> np.uint64(40)) % np.uint64(dims)] = 1
    return out


def pair_bits(texts: list[str], dims: int) -> np.ndarray:
    """pair_profiles as bits of machine words: no more bits of two texts differ than numbered letter pairs."""
    return np.packbits(pair_profiles(texts, dims).astype(bool), axis=1).view(np.uint64)


LETTERS = 61


def letter_bags(texts: list[str]) -> np.ndarray:
    """How often each letter is in each text, letters hashed to LETTERS places, blanks left out."""
    out = np.zeros((len(texts), LETTERS), np.int32)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    inside = codes != 32
    np.add.at(out, (owner[inside], codes[inside] % LETTERS), 1)
    return out


def rest_alike(a: frozenset, b: frozenset, total: int, fuzzy: float) -> bool:
    """Whether the words that only one title has, joined, are alike enough letter by letter; total: the length of both titles."""
    x, y = " ".join(sorted(a - b)), " ".join(sorted(b - a))
    return 100.0 - 100.0 * (len(x) + len(y) - 2 * subsequence(x, y)) / total >= fuzzy


WORD = 64  # bits of a machine word
LONGEST = 4 * WORD  # titles of fewer letters are compared in so many machine words together, longer ones one pair at a time
PAIRS = 8192  # pairs worked out together


def letter_counts(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 0/1 row per text, so that the product of two rows is how many letters, blanks included, the texts have in common, whatever their order."""
    codes, owner = np.frombuffer("".join(left + right).encode("utf-32-le"), "<u4"), np.repeat(np.arange(len(left) + len(right)), [len(t) for t in left + right])
    _, letter = np.unique(codes, return_inverse=True)
    order = np.lexsort((letter, owner))
    owner, letter = owner[order], letter[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (letter[1:] != letter[:-1])][:len(owner)])
    times = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
    _, place = np.unique(letter * LONGEST + times, return_inverse=True)  # the n-th occurrence of a letter has a place of its own
    out = np.zeros((len(left) + len(right), int(place.max(initial=-1)) + 1), np.float32)
    out[owner, place] = 1
    return out[:len(left)], out[len(left):]


class ShortTitles:
    """Titles of fewer than LONGEST letters, each as a column of letters with a blank after every word, and the places of its words."""

    def __init__(self, texts: list[str], letters: dict[str, int], words: dict[str, int], none: int):
        slots = max((t.count(" ") + 1 for t in texts), default=1)
        self.longest = max((len(t) for t in texts), default=0) + 1
        self.size = -(-self.longest // WORD)
        codes = np.full((len(texts), self.longest), len(letters), np.int64)
        kind = np.int16 if len(words) < 1 << 15 else np.int32
        self.words = np.full((slots, len(texts)), none, kind)
        bits = np.zeros((slots, self.size, len(texts)), np.uint64)
        for i, text in enumerate(texts):
            codes[i, :len(text) + 1] = [letters[c] for c in text + " "]
            at = 0
            for k, word in enumerate(text.split(" ")):
                self.words[k, i] = words.get(word, none)
                place = ((1 << len(word) + 1) - 1) << at
                for w in range(at // WORD, (at + len(word)) // WORD + 1):
                    bits[k, w, i] = place >> w * WORD & (1 << WORD) - 1
                at += len(word) + 1
        self.places = bits  # slot, machine word, title
        self.codes = np.ascontiguousarray(codes.T)

    def masks(self, letters: int, rows: slice) -> np.ndarray:
        """Per machine word, title of `rows` and letter, the places that hold it."""
        codes = self.codes[:, rows]
        out, every = np.zeros((self.size, codes.shape[1], letters + 1), np.uint64), np.arange(codes.shape[1])
        for k in range(self.longest):
            out[k // WORD, every, codes[k]] |= np.uint64(1 << k % WORD)
        out[:, :, letters] = 0
        return out


STEP = 12  # letters after which pairs that are too far apart already are left, again and again


def rest_distances(a: ShortTitles, b: ShortTitles, masks: np.ndarray, row: np.ndarray, at: np.ndarray, to: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, distances) of the pairs (at, to) with at most `most` insertions and deletions between the words that only one title has, joined.

    `masks`: of some of a's titles, a pair's at its `row`. The longest common subsequence of all pairs at once, a letter of b a step, a
    few machine words of bits a pair; letters of common words are masked out. A pair goes as soon as the letters left cannot bring it
    within `most`. Both texts end in a blank, which changes no distance unless one of them is empty.
    """
    zero, one, size = np.uint64(0), np.uint64(1), range(a.size)
    words_b = b.words[:, to]
    own_a, common_b = np.zeros((a.size, len(at)), np.uint64), np.zeros(words_b.shape, bool)
    for words, places in zip(a.words, a.places):
        same = words_b == words[at]
        own_a |= np.where(same.any(axis=0), zero, places[:, at])
        common_b |= same
    own_b = np.zeros((b.size, len(at)), np.uint64)
    for gone, places in zip(common_b, b.places):
        own_b |= np.where(gone, zero, places[:, to])
    size_a, size_b = (np.bitwise_count(x).sum(axis=0, dtype=np.int64) for x in (own_a, own_b))
    flat, base, each = [m.ravel() for m in masks], row * masks.shape[2], np.arange(len(at))
    bits, rest = np.full((a.size, len(at)), ~zero, np.uint64), size_b  # a bit of own_a goes to 0 for each common letter; rest: letters of b left
    for k in range(b.longest):
        if k and k % STEP == 0:
            common = np.bitwise_count(~bits).sum(axis=0, dtype=np.int64)
            rest = sum(np.bitwise_count(own_b[w] >> np.uint64(max(0, k - w * WORD))).astype(np.int64) for w in range(k // WORD, b.size))
            near = np.flatnonzero(size_a + size_b - 2 * (common + rest) <= most + 1)  # the ending blanks count one at most
            to, size_a, size_b, base, each, most = (x[near] for x in (to, size_a, size_b, base, each, most))
            own_a, own_b, bits = (x[:, near] for x in (own_a, own_b, bits))
        letter, own = base + b.codes[k].take(to), own_b[k // WORD] >> np.uint64(k % WORD) & one
        carry = zero
        for w in size:
            row_w = bits[w]
            hit = own * own_a[w]
            hit &= flat[w].take(letter)
            hit &= row_w
            total = row_w + hit
            row_w ^= hit
            if a.size > 1:
                over = total < hit
                total += carry
                carry = (over | (total < carry)).astype(np.uint64)
            row_w |= total
    common = np.bitwise_count(~bits).sum(axis=0, dtype=np.int64)
    return each, size_a + size_b - 2 * common - ((size_a == 0) != (size_b == 0))


def _alike_short(a: list[str], b: list[str], fuzzy: float, tile: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of the pairs of two blocks of short titles that reach the ratio; in a block met with itself, each pair once.

    A matrix product of letter counts gives the least distance; of the pairs that it leaves open, some in a hundred, those that
    have letter pairs enough in common are worked out together.
    """
    letters = {c: i for i, c in enumerate(sorted(set("".join(a + b)) | {" "}))}
    words = {w: i for i, w in enumerate(set(" ".join(a).split(" ")) & set(" ".join(b).split(" ")))}  # others are in one block only
    left, right = ShortTitles(a, letters, words, -1), ShortTitles(b, letters, words, -2)
    bits_a, bits_b = (pair_bits(x, 1024 * max(left.size, right.size)) for x in (a, b))
    (bag_a, bag_b), len_a, len_b = letter_counts(a, b), *(np.array([len(t) for t in x], np.float32) for x in (a, b))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i in range(0, len(a), tile):
        masks = left.masks(len(letters), slice(i, i + tile))
        for k in range(i if same else 0, len(b), tile):
            common = bag_a[i:i + tile] @ bag_b[k:k + tile].T
            common -= (fuzzy / 200 * len_a[i:i + tile] - 5e-4)[:, None]
            at, to = np.nonzero(common >= fuzzy / 200 * len_b[k:k + tile])
            if same and i == k:
                at, to = (z[at < to] for z in (at, to))
            for n in range(0, len(at), PAIRS):
                p, q = at[n:n + PAIRS], to[n:n + PAIRS]
                total = (len_a[p + i] + len_b[q + k]).astype(np.float64)
                # an insertion or a deletion changes three letter pairs at most
                open_ = np.bitwise_count(bits_a[p + i] ^ bits_b[q + k]).sum(axis=1) <= 3 * (1 - fuzzy / 100) * total + 1e-3
                p, q, total = p[open_], q[open_], total[open_]
                near, apart = rest_distances(left, right, masks, p, p + i, q + k, np.floor((1 - fuzzy / 100) * total + 1e-3))
                good = near[100.0 - 100.0 * apart / total[near] >= fuzzy]
                found.append((p[good] + i, q[good] + k))
    return tuple(np.concatenate(x) for x in zip(*found))


def _alike(fuzzy: float, tile: int = 1024):
    spread = fuzzy / (200 - fuzzy)
    per_letter, rest = pair_terms(fuzzy)

    def made(left: pa.Table, right: pa.Table) -> pa.Table:
        """Pairs of titles of two blocks whose remainders reach the ratio: those whose letter pairs and letters leave it open are worked out."""
        found = [[], []]
        if left.num_rows and right.num_rows:
            same = left.column("i")[0].as_py() == right.column("j")[0].as_py()
            sides = []
            longest = max(pc.max(t.column("length")).as_py() for t in (left, right))
            dims = min(2048, max(256, 1 << (4 * longest).bit_length()))
            for t in (left, right):
                t = t.sort_by([("length", "ascending"), ("title_id", "ascending")])  # one order for a block on either side
                length = t.column("length").to_numpy().astype(np.float32)
                texts = t.column("text").to_pylist()
                long = texts if longest >= LONGEST else []  # short ones need no profiles
                profile = pair_profiles(long, dims) if long else np.zeros((0, dims), np.float32)
                # bits that only one side has are pairs the other lacks; `loose` is what hashing hides of a side's pairs
                loose = (length if long else length[:0]) + 1 - profile.sum(axis=1)
                sides.append((t.column("title_id").to_numpy(zero_copy_only=False), length, texts, profile, loose, letter_bags(long), [frozenset(x.split(" ")) for x in long]))
            (ids_a, len_a, texts_a, bits_a, loose_a, bags_a, words_a), (ids_b, len_b, texts_b, bits_b, loose_b, bags_b, words_b) = sides
            letters_a, letters_b = bags_a.sum(axis=1), bags_b.sum(axis=1)
            if longest < LONGEST:
                at, to = _alike_short(texts_a, texts_b, fuzzy, tile, same)
                found[0].append(ids_a[at])
                found[1].append(ids_b[to])
            for i in range(0, len(ids_a) if longest >= LONGEST else 0, tile):
                a = slice(i, i + tile)
                lo, hi = np.searchsorted(len_b, [spread * len_a[a][0] - 1.01, (len_a[a][-1] + 1.01) / spread])
                for k in range(lo, hi, tile):
                    b = slice(k, min(k + tile, hi))
                    common = bits_a[a] @ bits_b[b].T
                    x, y = len_a[a][:, None], len_b[b]
                    ok = common + np.minimum(loose_a[a][:, None], loose_b[b]) >= (x + y) * per_letter + rest - 1e-3
                    ok &= (x >= spread * y - 1.001) & (y >= spread * x - 1.001)
                    at, to = np.nonzero(ok)
                    at, to = at + i, to + k
                    if same:
                        at, to = (z[at < to] for z in (at, to))
                    # letters that only one text has, and the words that one has more of, are that much distance at least
                    apart = letters_a[at] + letters_b[to] - 2 * np.minimum(bags_a[at], bags_b[to]).sum(axis=1) + np.abs((len_a[at] - letters_a[at]) - (len_b[to] - letters_b[to]))
                    total = len_a[at] + len_b[to]
                    near = apart <= (1 - fuzzy / 100) * total + 1e-3
                    good = [(p, q) for p, q, n in zip(at[near].tolist(), to[near].tolist(), total[near].tolist()) if rest_alike(words_a[p], words_b[q], n, fuzzy)]
                    found[0].append(ids_a[[p for p, _ in good]])
                    found[1].append(ids_b[[q for _, q in good]])
        kind = left.schema.field("title_id").type
        return pa.table([pa.array(np.concatenate(f) if f else [], kind) for f in found], names=["a", "b"])

    return made


def letter_candidates(titles: DataFrame, fuzzy: float = fv.FUZZY_DUPLICATE, block: int | None = None) -> DataFrame:
    """Pairs (a, b) whose remainders are alike enough letter by letter, with no common word needed.

    Titles of a group are dealt to blocks in the order of their lengths, and only blocks with lengths near enough meet. Inside a task
    a matrix product counts the common letters (of longer titles: letter pairs) of two blocks; pairs that reach the bound are
    worked out, and only alike ones leave the task: no row is made for another pair, and no key is needed that every text shares.
    """
    text = F.array_join("words", " ")
    base = materialize(titles.select("title_id", "grp", text.alias("text"), F.length(text).alias("length")), "letters")
    kind = base.schema["title_id"].dataType.simpleString()
    rows = block or min(MOST_BLOCK, max(LEAST_BLOCK, base.count() // BLOCKS))
    placed = materialize(length_blocks(base, rows), "blocks")
    spread = fuzzy / (200 - fuzzy)  # the shorter text is at least this part of the longer
    extent = placed.groupBy("grp", "block").agg(F.min("length").alias("lo"), F.max("length").alias("hi"))
    i, j = extent.select("grp", F.col("block").alias("i"), "hi"), extent.select("grp", F.col("block").alias("j"), "lo")
    meet = materialize(i.join(j, "grp").filter((F.col("i") <= F.col("j")) & (F.col("hi") >= spread * F.col("lo") - 1)).select("grp", "i", "j"), "block-pairs")
    tasks = max(1, min(meet.count(), MOST_TASKS))

    def side(own: str) -> DataFrame:
        # columns under new ids: both sides of the cogroup come from the same tables
        rows = placed.select(F.col("block").alias(own), *[F.col(c).alias(c) for c in ("grp", "title_id", "text", "length")])
        return rows.join(meet.select(*[F.col(c).alias(c) for c in ("grp", "i", "j")]), ["grp", own]).repartition(tasks, "grp", "i", "j")

    keys = ("grp", "i", "j")
    return side("i").groupBy(*keys).cogroup(side("j").groupBy(*keys)).applyInArrow(_alike(fuzzy), f"a {kind}, b {kind}")


def with_duplicate_rule(pairs: DataFrame, fuzzy: float = fv.FUZZY_DUPLICATE, topic: float = fv.TOPIC_DUPLICATE) -> DataFrame:
    """Keep the pairs (columns a_*, b_*) that satisfy the symmetric duplicate rule.

    Fuzzy ratio; or four common words with enough containment or ratio; or a shared event family
    and two common entity words; or three common entity words and an event family on both sides.
    """
    def side(p):
        return [F.col(f"{p}_{c}") for c in ("words", "meaningful", "entities", "families")]

    (wa, ma, ea, fa), (wb, mb, eb, fb) = side("a"), side("b")
    both = (F.size(ma) > 0) & (F.size(mb) > 0)
    entities = F.col("_entities")
    by_words = (
        (F.col("_topical") & (sim.containment(ma, mb) >= 0.55))
        | (both & F.arrays_overlap(fa, fb) & (entities >= 2))
        | (both & (entities >= 3) & (F.size(fa) > 0) & (F.size(fb) > 0))
    )
    staged = pairs.withColumns({
        "parts": sim.set_parts(wa, wb),
        "_topical": both & (F.size(F.array_intersect(ma, mb)) >= 4),
        "_entities": F.size(F.array_intersect(ea, eb)),
    }).withColumns({"_limit": F.when(F.col("_topical"), float(topic)).otherwise(float(fuzzy)), "_by_words": by_words})
    return sim.with_ratio_test(staged, "parts", "_limit", "_by_words", "_hit").filter("_hit").drop(
        "parts", "_topical", "_entities", "_limit", "_by_words", "_hit"
    )


def duplicate_titles(titles: DataFrame, fuzzy: float = fv.FUZZY_DUPLICATE, topic: float = fv.TOPIC_DUPLICATE,
                     hot: int = HOT, repeats: bool = False) -> DataFrame:
    """All pairs (better, worse) of distinct titles that are duplicates of each other; title_id numbers them by rank.

    With `repeats`, a pair that two rules find may come twice, which saves a shuffle of all pairs.
    """
    stored, last = numbered_words(titles, hot)
    ids = ("better", "worse")

    def judged(pairs: DataFrame) -> DataFrame:
        facts = ("words", "meaningful", "entities", "families")
        a, b = (stored.select(F.col("title_id").alias(own), *[F.col(c).alias(f"{p}_{c}") for c in facts]) for own, p in zip(ids, "ab"))
        return with_duplicate_rule(pairs.join(a, "better").join(b, "worse"), fuzzy, topic).select(*ids)

    by_word = materialize(word_candidates(stored, last), "by-word")
    alike = length_candidates(stored, fuzzy).unionByName(letter_candidates(stored, fuzzy))
    alike = materialize(alike.select(F.least("a", "b").alias("better"), F.greatest("a", "b").alias("worse")).distinct(), "alike")
    # the ratio that makes two titles alike settles them, unless four common words ask for more
    found = by_word.filter("settled").select(*ids).unionByName(alike if topic <= fuzzy else judged(alike))
    asked = by_word.filter(~F.col("settled")).select(*ids)
    if not asked.isEmpty():
        found = found.unionByName(materialize(judged(asked), "asked"))
    return found if repeats else found.repartition("better").distinct()


CELL = 64  # titles whose states are the bits of a number


def _cells(ids: DataFrame, name: str) -> DataFrame:
    """(cell, name): the titles named by `ids`, a column of numbers, as bits; one row per CELL titles at most."""
    one = F.lit(1).cast("bigint")
    return ids.groupBy(F.floor(F.col("id") / CELL).alias("cell")).agg(F.bit_or(F.call_function("shiftleft", one, F.pmod("id", F.lit(CELL)).cast("int"))).alias(name))


def _with_bit(pairs: DataFrame, cells: DataFrame, name: str, end: str) -> DataFrame:
    """Add `end`_`name`: whether the title in column `end` is among `cells`. These are broadcast: 16 bytes for CELL titles."""
    own = cells.select(F.col("cell").alias("_cell"), F.col(name).alias("_bits"))
    met = pairs.withColumn("_cell", F.floor(F.col(end) / CELL)).join(F.broadcast(own), "_cell", "left")
    bit = F.call_function("shiftright", F.coalesce("_bits", F.lit(0).cast("bigint")), F.pmod(F.col(end), F.lit(CELL)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return met.withColumn(f"{end}_{name}", bit).drop("_cell", "_bits")


def rejected_titles(edges: DataFrame) -> DataFrame:
    """Titles that greedy removal drops, given duplicate pairs (better, worse) of numbers by rank; pairs may repeat.

    Walking by rank and accepting what duplicates nothing accepted yet equals this in rounds:
    a title with no better duplicate left is accepted, its worse duplicates are dropped, and pairs
    of decided titles go away. Each round is stored in the shared scratch folder, so the plan does
    not grow and a lost executor costs one round. Which titles a round accepts and drops is broadcast as bits, so pairs are read
    where they are and never shuffled.
    """
    left, dropped = edges, None
    while not left.isEmpty():
        better, worse = (_cells(left.select(F.col(c).alias("id")), c) for c in ("better", "worse"))
        free = F.col("better").bitwiseAND(F.bitwise_not(F.coalesce("worse", F.lit(0).cast("bigint"))))
        accepted = better.join(worse, "cell", "left").select("cell", free.alias("accepted")).filter("accepted <> 0")
        hit = _with_bit(left, accepted, "accepted", "better").filter("better_accepted").select(F.col("worse").alias("id"))
        new = materialize(_cells(hit, "dropped"), "dropped")
        dropped = new if dropped is None else dropped.unionByName(new)
        # pairs of an accepted title end in a dropped one, so dropping those removes them as well
        rest = _with_bit(_with_bit(left, new, "dropped", "worse"), new, "dropped", "better")
        left = materialize(rest.filter(~F.col("worse_dropped") & ~F.col("better_dropped")).select("better", "worse"), "edges")
    if dropped is None:
        return edges.select(F.col("worse").alias("id")).limit(0)
    place = F.explode(F.sequence(F.lit(0), F.lit(CELL - 1))).alias("place")
    return dropped.select("cell", "dropped", place).filter(F.expr("shiftright(dropped, place) & 1") == 1).select((F.col("cell") * CELL + F.col("place")).alias("id"))


def greedy_dedupe(rows: DataFrame, group: str, title: str, order: Column, **rules) -> DataFrame:
    """All rows with `accepted`: true for the rows kept when each group is walked by rank.

    A row is kept unless it duplicates a better row that is kept. Copies of a title share its fate,
    except that the best copy of a kept title stays.
    """
    lists = {k: rules[k] for k in ("families", "noise", "stopwords") if k in rules}
    limits = {k: rules[k] for k in ("fuzzy", "topic", "hot") if k in rules}
    titles, members = distinct_titles(rows, group, title, order, **lists)
    dropped = rejected_titles(duplicate_titles(titles, **limits, repeats=True))
    gone = dropped.select(F.col("id").alias("title_id"), F.lit(True).alias("gone"))
    decided = titles.join(gone, "title_id", "left").select("title_key", F.col("rank").alias("best_rank"), "gone")
    marked = members.join(decided, "title_key", "left")
    wordless = F.col("best_rank").isNull()
    kept = F.col("gone").isNull() & (F.col("rank") == F.col("best_rank"))
    return marked.withColumn("accepted", F.coalesce(wordless | kept, F.lit(False))).drop("title_key", "rank", "best_rank", "gone")
