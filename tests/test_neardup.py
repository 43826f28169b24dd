"""Blocked pair search against brute force: no pair may be lost, whatever the keys."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

import reference_rules as rules
from pressroom.operators import neardup
from pressroom.plans import standins as sd

TITLES = [
    "Sony delays new console launch in Japan", "Sony console launch delayed in Japan", "gamepad", "game pad",
    "Google launches Pixel phones today", "Google launch Pixel phone today", "Update", "Big update for Google Pixel",
    "Studio confirms layoffs after merger talks end", "Layoffs confirmed by studio as merger talks collapse",
    "!!!", "", "Alpha beta gamma delta epsilon", "Delta gamma beta alpha zeta", "Alpha beta gamma delta epsilon",
    "court hears class action about console prices", "console prices lead to lawsuit in court",
]


def noisy_titles(n):
    """Copies and near copies of one title make up a third of the rows."""
    rng = random.Random(7)
    words = "orion nebula quantum river garden market signal cobalt harbor lantern update patch court delay".split()
    hot = "orion nebula quantum update signal harbor"
    out = []
    for i in range(n):
        if i % 3 == 0:
            t = list(hot)
            if i % 2:
                t[rng.randrange(len(t))] = rng.choice("abcxyz")
            out.append("".join(t))
        else:
            out.append(" ".join(rng.choice(words) + rng.choice(["", "s", "er"]) for _ in range(rng.randint(1, 6))))
    return out


def brute_accepted(rows, table):
    """Ids kept when each group is walked in order."""
    kept, accepted = defaultdict(list), set()
    for ident, group, title in sorted(rows):
        if not any(rules.duplicates(title, other, table) for other in kept[group]):
            kept[group].append(title)
            accepted.add(ident)
    return accepted


def run(spark, rows, table, hot):
    df = spark.createDataFrame(rows, "id int, grp string, title string")
    out = neardup.greedy_dedupe(df, "grp", "title", F.struct("id"), families=table, hot=hot)
    return {r.id for r in out.collect() if r.accepted}


def test_greedy_equals_walking_by_rank(spark):
    from pressroom import fixed_values as fv

    titles = TITLES + noisy_titles(150)
    rows = [(i, "ab"[i % 7 == 0], t) for i, t in enumerate(titles)]
    want = brute_accepted(rows, fv.EVENT_FAMILIES)
    assert run(spark, rows, fv.EVENT_FAMILIES, 1000) == want
    # with nearly every word treated as frequent, keys are word pairs; the result is the same
    assert run(spark, rows, fv.EVENT_FAMILIES, 2) == want


def test_articles_equal_brute_force(spark, small):
    rows = [(r.doc_id, r.branch, r.title) for r in sd.articles(spark, small).collect()]
    assert run(spark, rows, sd.EVENT_FAMILIES, 1000) == brute_accepted(rows, sd.EVENT_FAMILIES)


def test_pairs_equal_brute_force(spark):
    titles = sorted(set(TITLES[:10] + noisy_titles(60)))
    df = spark.createDataFrame([(i, "g", t) for i, t in enumerate(titles)], "id int, grp string, title string")
    distinct, _ = neardup.distinct_titles(df, "grp", "title", F.struct("id"))
    ids = {r.title_id: r["rank"].id for r in distinct.collect()}
    got = {(ids[r.better], ids[r.worse]) for r in neardup.duplicate_titles(distinct, hot=5).collect()}
    keep = sorted(ids.values())
    from pressroom import fixed_values as fv

    want = {(a, b) for i, a in enumerate(keep) for b in keep[i + 1:] if rules.duplicates(titles[a], titles[b], fv.EVENT_FAMILIES)}
    assert got == want


def test_letter_comparison_equals_pair_by_pair(monkeypatch):
    """Titles below and above a machine word of letters, over several tiles; short ones are never worked out one pair at a time."""
    import pyarrow as pa

    rng, made, single = random.Random(11), neardup._alike(84.0, tile=16), neardup.rest_alike

    def block(extra):
        texts = set()
        while len(texts) < 60:
            text = list("alpha beta delta gämma harbor " + "omega "[: extra % 7] + "zeta" * (extra // 3) + rng.choice(["", " kappa", " ñu"]))
            for _ in range(rng.randint(0, 9)):
                text[rng.randrange(len(text))] = rng.choice(["", "a", "é", " ", "xy", "\U0001F600"])
            texts.add(" ".join(sorted(set("".join(text).split()))))
        return sorted(texts - {""})

    def table(texts, own, number):
        return pa.table({own: [number] * len(texts), "title_id": texts, "text": texts, "length": pa.array(map(len, texts), pa.int32())})

    def brute(a, b):
        return {tuple(sorted((x, y))) for x in a for y in b if x != y and single(frozenset(x.split(" ")), frozenset(y.split(" ")), len(x) + len(y), 84.0)}

    for extra in (0, 6, 90):
        a, b = block(extra), block(extra + 3)
        want, alone = brute(a, b), brute(a, a)
        if max(map(len, a + b)) < neardup.WORD:
            monkeypatch.setattr(neardup, "rest_alike", None)
        else:
            monkeypatch.undo()
        got = made(table(a, "i", 1), table(b, "j", 2))
        assert want and {tuple(sorted(p)) for p in zip(*got.to_pydict().values()) if p[0] != p[1]} == want
        got = made(table(a, "i", 1), table(a, "j", 1))
        assert alone and got.num_rows == len(alone) and {tuple(sorted(p)) for p in zip(*got.to_pydict().values())} == alone


def near_titles(n):
    """Titles of common words and a family each: many pairs meet in a key, and every duplicate is one by common words."""
    rng = random.Random(3)
    words = ["quasar", "velvet", "copper", "meadow", "thunder", "violin", "glacier", "saffron", "orchid", "walnut", "pebble", "lantern"]
    return sorted({" ".join(["court", *rng.sample(words, 3), f"only{i}", f"own{i * 7}"]) for i in range(n)})


def test_pairs_are_judged_where_they_meet(spark, monkeypatch):
    """Duplicates by common words are found without a join of pairs with texts, each once, and named by numbers."""
    judged, rule = [], neardup.with_duplicate_rule

    def counted(pairs, *limits):
        judged.append(pairs.count())
        return rule(pairs, *limits)

    monkeypatch.setattr(neardup, "with_duplicate_rule", counted)
    table, titles = {"lawsuit": ["court"]}, near_titles(80)
    df = spark.createDataFrame([(i, "g", t) for i, t in enumerate(titles)], "id int, grp string, title string")
    distinct, _ = neardup.distinct_titles(df, "grp", "title", F.struct("id"), families=table)
    ids = {r.title_id: r["rank"].id for r in distinct.collect()}
    want = {(a, b) for a in range(len(titles)) for b in range(a + 1, len(titles)) if rules.duplicates(titles[a], titles[b], table)}
    for hot in (1000, 3):
        judged.clear()
        got = neardup.duplicate_titles(distinct, hot=hot).collect()
        assert len(want) > 300 and len(got) == len(want) and {(ids[r.better], ids[r.worse]) for r in got} == want
        assert sum(judged) == 0
    assert sorted(ids) == list(range(1, len(titles) + 1)) and all(ids[a] < ids[a + 1] for a in range(1, len(titles)))


def test_removal_in_rounds_does_not_shuffle_pairs(spark, monkeypatch):
    rng, plans, store = random.Random(5), [], neardup.materialize
    edges = sorted({(a, b) for a, b in (sorted(rng.sample(range(1, 400), 2)) for _ in range(900))})
    gone = set()
    for b in range(1, 400):
        if any(w == b and a not in gone for a, w in edges):
            gone.add(b)

    def stored(df, name="stage"):
        plans.extend([df._jdf.queryExecution().executedPlan().toString()] if name == "edges" else [])
        return store(df, name)

    monkeypatch.setattr(neardup, "materialize", stored)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = spark.createDataFrame(edges + edges[:50], "better bigint, worse bigint")
        assert sorted(r.id for r in neardup.rejected_titles(pairs).collect()) == sorted(gone)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(plans) > 1 and not any("SortMergeJoin" in p or "Exchange hashpartitioning(better" in p or "Exchange hashpartitioning(worse" in p for p in plans)


def test_letters_of_long_titles_are_compared_together(monkeypatch):
    """Titles over one machine word of letters, up to four, are never worked out one pair at a time."""
    import pyarrow as pa

    rng, single = random.Random(12), neardup.rest_alike

    def block(length):
        texts, base = set(), " ".join("".join(rng.choice("abcdeéñ\U0001F600") for _ in range(rng.randint(2, 9))) for _ in range(40))[:length]
        while len(texts) < 40:
            text = list(base)
            for _ in range(rng.randint(0, length // 6)):
                text[rng.randrange(len(text))] = rng.choice(["", "a", "é", " ", "xy", "zzz "])
            texts.add(" ".join(sorted(set("".join(text).split()))))
        return sorted(t for t in texts if t and len(t) < 256), base

    def table(texts, own, number):
        return pa.table({own: [number] * len(texts), "title_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "length": pa.array(map(len, texts), pa.int32())})

    for length in (64, 66, 120, 128, 190, 250):
        texts, _ = block(length)
        texts += block(length * 9 // 10)[0]
        want = {(x, y) for x in range(len(texts)) for y in range(x + 1, len(texts))
                if single(frozenset(texts[x].split(" ")), frozenset(texts[y].split(" ")), len(texts[x]) + len(texts[y]), 84.0)}
        with monkeypatch.context() as m:
            m.setattr(neardup, "rest_alike", None)
            got = neardup._alike(84.0, tile=16)(table(texts, "i", 1), table(texts, "j", 1))
        assert want and got.num_rows == len(want) and {tuple(sorted(p)) for p in zip(*got.to_pydict().values())} == want
