"""Anti-repetition against a publication history, and the history table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import dates, events as ev, similarity as sim, text as tx, urls
from pressroom.operators.neardup import HOT, shared_keys, with_frequencies
from pressroom.operators.skew import salted_join
from pressroom.session import materialize


def recent_history(history: DataFrame, as_of, days: int = fv.BLOCK_DAYS) -> DataFrame:
    """History rows of the last `days`; rows without a readable date are left out."""
    return history.filter(dates.since_day(dates.day_of(F.col("date")), as_of, days))


def title_id(title: Column) -> Column:
    """What the comparison sees of a title: its set of plain words."""
    return F.array_join(F.array_sort(tx.word_set(tx.ascii_words(title))), " ")


def title_facts(ids: DataFrame, classes=None, stopwords=None, generic=None) -> DataFrame:
    """Subject, distinctive and event words per title_id."""
    words = ids.withColumn("words", tx.words(F.col("title_id")))
    return words.withColumns({
        "subject": ev.subject_words(F.col("words"), classes, stopwords, generic),
        "events": ev.event_set(F.col("words"), classes),
        "named": F.array_distinct(ev.with_events_named(F.col("words"), classes)),
    }).withColumn("strong", ev.distinctive_words(F.col("subject")))


def same_story(pairs: DataFrame, material=None) -> DataFrame:
    """Judge pairs of a newer (n_*) and an older (o_*) title.

    Adds `fresh` (older is at most 3 days old, undated or of the same batch), `aged` (4 to 10
    days), `ratio`, `shared_words`, and `new_events`: material events only the newer title has.
    """
    material = fv.MATERIAL_EVENTS if material is None else material
    shared = F.array_intersect("n_subject", "o_subject")
    staged = pairs.withColumns({
        "shared_words": F.array_sort(shared),
        "_both": F.arrays_overlap("n_events", "o_events"),
        "_cover": sim.containment(F.col("n_subject"), F.col("o_subject")),
        "_strong": F.size(F.array_intersect("n_strong", "o_strong")),
        "_parts": sim.set_parts(F.col("n_named"), F.col("o_named")),
        "new_events": F.array_sort(F.array_intersect(F.array_except("n_events", "o_events"), tx.lit_array(material))),
    })
    rated = sim.with_ratio(staged, "_parts", "ratio")
    strong, both, cover, ratio = F.col("_strong"), F.col("_both"), F.col("_cover"), F.col("ratio")
    return rated.withColumns({
        "fresh": (both & (strong >= 1) & (ratio >= 84)) | (both & (strong >= 2)) | ((strong >= 3) & (cover >= 0.60)),
        "aged": (both & (strong >= 1) & (ratio >= 92)) | (both & (strong >= 2) & (cover >= 0.55) & (ratio >= 78)),
    }).drop("_both", "_cover", "_strong", "_parts")


def reason_text(ratio: Column, shared: Column) -> Column:
    anchors = F.array_join(F.slice(shared, 1, 8), ", ")
    base = F.concat(
        F.lit("misma historia | sim="), F.bround(ratio, 0).cast("int").cast("string"),
        F.lit(" | shared="), F.size(shared).cast("string"),
    )
    return F.concat(base, F.when(anchors != "", F.concat(F.lit(" | anchors="), anchors)).otherwise(""))


def _keys(titles: DataFrame, hot: int) -> DataFrame:
    """Keys a pair must share: event and distinctive word, or one of the words three in common imply."""
    pair = F.flatten(F.transform("events", lambda e: F.transform("strong", lambda w: F.concat_ws("\u0001", e, w))))
    three = shared_keys(F.col("by_word"), F.col("strong"), 3, hot)
    keys = F.array_distinct(F.concat(pair, F.coalesce(three, F.array().cast("array<string>"))))
    return titles.select("title_id", F.explode_outer(keys).alias("key")).filter("key is not null")


def story_pairs(newer: DataFrame, older: DataFrame, classes=None, material=None, stopwords=None, generic=None,
                hot: int = HOT) -> DataFrame:
    """All pairs of distinct titles (n, o) that tell the same story, judged by same_story()."""
    lists = (classes, stopwords, generic)
    both = newer.select("title_id").union(older.select("title_id")).filter("title_id <> ''").distinct()
    facts = title_facts(both, *lists)
    facts = materialize(with_frequencies(facts, F.col("strong"), [], "by_word"), "facts")
    keyed = _keys(facts, hot)
    n = keyed.join(newer.select("title_id").distinct(), "title_id", "left_semi").withColumnRenamed("title_id", "n")
    o = keyed.join(older.select("title_id").distinct(), "title_id", "left_semi").withColumnRenamed("title_id", "o")
    met = salted_join(n, o, ["key"], F.col("n"), F.col("o")).select("n", "o").distinct()
    columns = ("subject", "events", "named", "strong")
    a = facts.select(F.col("title_id").alias("n"), *[F.col(c).alias(f"n_{c}") for c in columns])
    b = facts.select(F.col("title_id").alias("o"), *[F.col(c).alias(f"o_{c}") for c in columns])
    judged = same_story(met.join(a, "n").join(b, "o"), material)
    return judged.filter("fresh or aged").select("n", "o", "fresh", "aged", "ratio", "shared_words", "new_events")


def batch_story_pairs(rows: DataFrame, batch: str, classes=None, material=None, hot: int = HOT) -> DataFrame:
    """(batch, n, o): title n tells the story of title o of the same batch, by the rule of fresh stories; rows: batch, title_id.

    Distinct titles are compared, so copies cost nothing; a title that repeats itself is a pair with itself.
    """
    titles = materialize(rows.select(batch, "title_id").filter("title_id <> ''").distinct(), "batch-titles")
    facts = title_facts(titles.select("title_id").distinct(), classes)
    facts = materialize(with_frequencies(facts, F.col("strong"), [], "by_word"), "facts")
    keyed = materialize(titles.join(_keys(facts, hot), "title_id"), "batch-keys")
    n, o = (keyed.select(batch, "key", F.col("title_id").alias(name)) for name in "no")
    met = salted_join(n, o, [batch, "key"], F.col("n"), F.col("o")).select(batch, "n", "o").distinct()
    columns = ("subject", "events", "named", "strong")
    a, b = (facts.select(F.col("title_id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns]) for name in "no")
    judged = same_story(met.join(a, "n").join(b, "o"), material)
    return judged.filter((F.size("new_events") == 0) & F.col("fresh")).select(batch, "n", "o")


def block_repeats(candidates: DataFrame, history: DataFrame, as_of, seq: str = "hist_seq", title: str = "title",
                  url: str = "link", **lists) -> DataFrame:
    """Classify candidates against the recent history.

    Adds status ('blocked', 'development' or 'kept'), reason and the matched history row's `seq`:
    the first history row that tells the same story or has the same URL; else the last one whose
    story the candidate carries on with a material event.

    Distinct titles are compared, not rows: for a title, age band and the rules, only the first
    and the last history row matter, so a group of copies costs one comparison.
    """
    day = dates.day_of(F.col("date"))
    # both tables are read several times below; their text is normalised and stored once
    old = recent_history(history, as_of).withColumns({
        "title_id": title_id(F.col("title")),
        "band": F.when(dates.age_days(day, as_of) <= 3, "fresh").otherwise("aged"),
        "old_url": urls.canonical_url(F.col("url")),
        "_told": tx.blank_if_null(F.col("title")) != "",
    })
    old = materialize(old.select(seq, "title_id", "band", "old_url", "_told"), "history").filter("_told")
    titles = old.groupBy("title_id", "band").agg(F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))
    # rows without a URL get a key of their own that meets nothing, so they do not gather in one task
    link = urls.canonical_url(F.col(url))
    rows = candidates.withColumns({
        "title_id": title_id(F.col(title)),
        "_url": F.when(link != "", link).otherwise(F.concat(F.lit("\u0001"), F.monotonically_increasing_id().cast("string"))),
        "_told": tx.blank_if_null(F.col(title)) != "",
    })
    rows = materialize(rows, "candidates")
    pairs = story_pairs(rows, old, **lists)
    hits = pairs.join(titles.withColumnRenamed("title_id", "o"), "o").filter(
        (F.col("fresh") & (F.col("band") == "fresh")) | (F.col("aged") & (F.col("band") == "aged"))
    )
    blocks = F.size("new_events") == 0
    found = F.struct("ratio", "shared_words")
    # stored, because the joins below read it three times, and each time every pair of titles would be judged anew
    per_title = materialize(hits.groupBy(F.col("n").alias("title_id")).agg(
        F.min(F.when(blocks, F.col("first_seq"))).alias("_seq"),
        F.min_by(found, F.when(blocks, F.col("first_seq"))).alias("_found"),
        F.max(F.when(~blocks, F.col("last_seq"))).alias("_dev_seq"),
        F.max_by("new_events", F.when(~blocks, F.col("last_seq"))).alias("_dev"),
    ), "per-title")
    by_url = old.filter("old_url <> ''").groupBy(F.col("old_url").alias("_url")).agg(F.min(seq).alias("_url_seq"))
    row = F.monotonically_increasing_id()
    out = salted_join(rows.withColumn("_place", row), per_title, ["title_id"], F.col("_place"), F.col("title_id"), how="left")
    out = salted_join(out, by_url, ["_url"], F.col("_place"), F.col("_url"), how="left")
    url_seq = F.when(F.col("_told"), F.col("_url_seq"))
    blocked = F.least(F.col("_seq"), url_seq)
    status = F.when(blocked.isNotNull(), "blocked").when(F.col("_dev_seq").isNotNull(), "development").otherwise("kept")
    reason = (
        F.when(blocked.isNotNull() & (url_seq == blocked), "misma URL")
        .when(blocked.isNotNull(), reason_text(F.col("_found.ratio"), F.col("_found.shared_words")))
        .when(F.col("_dev_seq").isNotNull(), F.concat(F.lit("nuevo desarrollo fuerte: "), F.array_join("_dev", ", ")))
    )
    kept = [c for c in candidates.columns]
    return out.select(
        *kept, status.alias("status"), reason.alias("reason"), F.coalesce(blocked, F.col("_dev_seq")).alias(seq)
    )


def split_blocked(classified: DataFrame, history: DataFrame, seq: str = "hist_seq") -> tuple[DataFrame, DataFrame]:
    """(kept rows, blocked rows as nested candidate / reason / history_match)."""
    own = [c for c in classified.columns if c not in ("status", "reason", seq)]
    kept = classified.filter("status <> 'blocked'").select(*own)
    match = history.select(seq, F.struct(*[c for c in history.columns if c != seq]).alias("history_match"))
    blocked = (
        classified.filter("status = 'blocked'")
        .select(F.struct(*own).alias("candidate"), "reason", seq)
        .join(match, seq, "left")
        .select("candidate", "reason", "history_match")
    )
    return kept, blocked


def prune_history(history: DataFrame, as_of, days: int = fv.KEEP_DAYS) -> DataFrame:
    return history.filter(dates.since_day(dates.day_of(F.col("date")), as_of, days))


COLUMNS = ["date", "branch", "title", "source", "url", "story_key"]


def new_entries(news: DataFrame, today_rows: DataFrame, today: str, seq: str = "seq") -> DataFrame:
    """The rows of `news` that today's history does not have, as history rows. Only today's rows are asked.

    A story is known when today's history has its URL, or, for a story without one, its whole title as words; the
    stored story key is the title's beginning and for display only. A stored key that is not its title's counts itself.
    Within the batch the first row by `seq` counts.
    `news` needs title, branch, source, url; rows without a title are skipped.
    """
    new = news.filter(tx.blank_if_null(F.col("title")) != "").select(
        F.lit(today).alias("date"), "branch", tx.strip(F.col("title")).alias("title"), "source",
        tx.blank_if_null(F.col("url")).alias("url"), tx.slug(F.col("title")).alias("story_key"), F.col(seq).alias("_seq"),
        tx.slug(F.col("title"), None).alias("_key"),
    )
    # a row with a URL is known by URL; a row without one by key, whatever URL the known row has. Rows of one URL or key become one before they are joined
    first = lambda rows, key: rows.groupBy(key).agg(F.min_by(F.struct(*new.columns), "_seq").alias("r")).select("r.*")
    first_of_url = first(new.filter("url <> ''"), "url").join(today_rows.filter("url <> ''").select("url").distinct(), "url", "left_anti")
    own_key = tx.slug(F.col("title")) == F.col("story_key")
    known_keys = today_rows.select(F.when(own_key, tx.slug(F.col("title"), None)).otherwise(F.col("story_key")).alias("_key")).distinct()
    first_of_key = first(new.filter("url = ''"), "_key").join(known_keys, "_key", "left_anti")
    # a URL row that comes earlier in the batch makes the key known as well
    earlier = first_of_url.groupBy("_key").agg(F.min("_seq").alias("_before"))
    first_of_key = first_of_key.join(earlier, "_key", "left").filter(F.col("_before").isNull() | (F.col("_before") > F.col("_seq")))
    return first_of_url.select(*COLUMNS).unionByName(first_of_key.select(*COLUMNS))


def register(news: DataFrame, history: DataFrame, as_of, today: str, seq: str = "seq") -> DataFrame:
    """The pruned history plus today's stories it does not have yet (new_entries). Running it twice changes nothing."""
    kept = prune_history(history, as_of)
    return kept.select(*COLUMNS).unionByName(new_entries(news, kept.filter(F.col("date") == today), today, seq))
