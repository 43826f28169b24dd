"""History blocking against a plain loop over the recent history, and the registry."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

import reference_rules as rules
from pressroom import fixed_values as fv
from pressroom.operators import history as hist
from pressroom.plans import standins as sd

AS_OF = "2024-01-31 09:30:00"

CANDIDATES = [
    ("Acme Rocket Falcon delayed until spring", "https://a.example/x?u=1"),
    ("Acme Rocket Falcon announces beta program", ""),
    ("Zephyr Engine studio announces Falcon expansion", ""),
    ("Completely different story about gardens", "https://B.example/story/"),
    ("Falcon announced", ""), ("", "https://a.example/x"), ("Quantum Harbor Lantern Signal details", ""),
]
HISTORY = [
    (1, "2024-01-30", "Acme Rocket Falcon announced for spring", ""),
    (2, "2024-01-24", "Zephyr Engine studio announces Falcon expansion pack", ""),
    (3, "2024-01-21", "Falcon announced", ""), (4, "2024-01-20", "Falcon announced", ""),
    (5, "2024-01-29", "Something else", "https://b.example/story"),
    (6, "bad date", "Quantum Harbor Lantern Signal", ""), (7, "2024-01-28", "Quantum Harbor Lantern Signal", ""),
    (8, "2024-01-31", "Acme Rocket Falcon delayed again until spring", ""),
]


def canonical(url):
    from urllib.parse import urlsplit, urlunsplit

    p = urlsplit(url)
    return urlunsplit((p.scheme.lower(), p.netloc.lower(), p.path.rstrip("/"), "", ""))


def loop(candidates, history, as_of, classes, material):
    """(status, matched seq) per candidate: the first block wins, else the last development."""
    now = datetime.fromisoformat(as_of)
    recent = []
    for seq, date, title, url in history:
        try:
            day = datetime.fromisoformat(date[:10])
        except ValueError:
            continue
        if day >= now - timedelta(days=10):
            recent.append((seq, max(0, (now - day).days), title, url))
    out = []
    for title, url in candidates:
        status, match = "kept", None
        for seq, age, old, old_url in sorted(recent):
            if not title.strip() or not old.strip():
                continue
            if url and old_url and canonical(url) == canonical(old_url):
                status, match = "blocked", seq
                break
            same, new = rules.compare(title, old, age, classes, material)
            if same:
                status, match = "blocked", seq
                break
            if new:
                status, match = "development", seq
        out.append((status, match))
    return out


def judge(spark, candidates, history, as_of, classes, material, hot):
    c = spark.createDataFrame([(i, t, u) for i, (t, u) in enumerate(candidates)], "id int, title string, link string")
    h = spark.createDataFrame(history, "hist_seq bigint, date string, title string, url string")
    rows = hist.block_repeats(c, h, as_of, classes=classes, material=material, hot=hot).orderBy("id").collect()
    return [(r.status, r.hist_seq) for r in rows], rows


def test_handmade_cases(spark):
    want = loop(CANDIDATES, HISTORY, AS_OF, fv.EVENT_CLASSES, fv.MATERIAL_EVENTS)
    got, rows = judge(spark, CANDIDATES, HISTORY, AS_OF, None, None, 1000)
    assert got == want
    assert {s for s, _ in want} == {"blocked", "development", "kept"}
    assert judge(spark, CANDIDATES, HISTORY, AS_OF, None, None, 1)[0] == want
    assert rows[3].reason == "misma URL"
    assert rows[1].reason == "nuevo desarrollo fuerte: beta"


def test_articles_equal_loop(spark, small):
    material = ["delay", "cancel", "sales", "beta"]
    c = [(r.title, r.link) for r in sd.open_candidates(spark, small).orderBy("doc_id").collect()]
    h = [(r.hist_seq, r.date, r.title, r.url) for r in sd.published_history(spark, small).collect()]
    # the open articles, and every published title once more, so that there is something to block
    c += [(t, "") for _, _, t, _ in sorted(h)]
    want = loop(c, h, "2024-01-31 00:00:00", sd.EVENT_CLASSES, material)
    got, _ = judge(spark, c, h, sd.AS_OF, sd.EVENT_CLASSES, material, 5)
    assert got == want
    assert sum(s == "blocked" for s, _ in want) > 5


def test_register_is_idempotent(spark):
    old = spark.createDataFrame(
        [("2024-01-31", "gaming", "A", "s", "u1", "a"), ("2023-12-01", "gaming", "Old", "s", "", "old")],
        "date string, branch string, title string, source string, url string, story_key string",
    )
    news = spark.createDataFrame(
        [(1, "gaming", "A again", "s", "u1"), (2, "gaming", "¡Bé!", "s", ""), (3, "gaming", "Be", "s", ""),
         (4, "gaming", "", "s", "u9"), (5, "gaming", "C", "s", "u2"), (6, "gaming", "c", "s", "")],
        "seq int, branch string, title string, source string, url string",
    )
    once = hist.register(news, old, AS_OF, "2024-01-31")
    rows = {(r.title, r.url) for r in once.collect()}
    assert rows == {("A", "u1"), ("¡Bé!", ""), ("C", "u2")}
    again = hist.register(news, once, AS_OF, "2024-01-31")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_split(spark):
    h = spark.createDataFrame(HISTORY, "hist_seq bigint, date string, title string, url string")
    c = spark.createDataFrame([(i, t, u) for i, (t, u) in enumerate(CANDIDATES)], "id int, title string, link string")
    judged = hist.block_repeats(c, h, AS_OF)
    kept, blocked = hist.split_blocked(judged, h)
    assert kept.count() + blocked.count() == len(CANDIDATES)
    assert all(r.history_match.title for r in blocked.collect())


def test_titles_that_differ_late_are_both_registered(spark):
    start = "word " * 40
    old = spark.createDataFrame(
        [("2024-01-31", "gaming", start + "one", "s", "", ("word-" * 28))], "date string, branch string, title string, source string, url string, story_key string",
    )
    news = spark.createDataFrame(
        [(1, "gaming", start + "one", "s", ""), (2, "gaming", start + "two", "s", ""), (3, "gaming", start + "three", "s", "u"), (4, "gaming", start + "three", "s", "")],
        "seq int, branch string, title string, source string, url string",
    )
    rows = hist.register(news, old, AS_OF, "2024-01-31").collect()
    assert sorted((r.title.split()[-1], r.url) for r in rows) == [("one", ""), ("three", "u"), ("two", "")]
    assert {len(r.story_key) for r in rows} == {140}
