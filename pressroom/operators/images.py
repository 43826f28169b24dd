"""Relevance of images for a story, and which one is accepted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import text as tx, urls
from pressroom.operators.ranking import top_in_group

DASHES = (" - ", " — ", " – ")


def topic_words(title: Column, source: Column, url: Column) -> Column:
    """Words of 3+ characters of the bare title and the URL path that are no stop words."""
    bare = tx.strip_source(title, source, DASHES)
    both = F.concat(tx.alnum_tokens(bare), urls.path_words(url))
    return tx.meaningful(F.array_distinct(both), fv.IMAGE_STOPWORDS)


def distinctive_title_words(title: Column, source: Column) -> Column:
    bare = tx.strip_source(title, source, DASHES)
    return tx.meaningful(tx.alnum_tokens(bare), fv.IMAGE_STOPWORDS + fv.IMAGE_GENERIC)


def search_queries(title: Column, source: Column, url: Column, most: int = 5) -> Column:
    """Search texts for other coverage: the bare title, the URL slug, the first distinctive words."""
    bare = tx.strip_source(title, source, DASHES)
    words = distinctive_title_words(bare, source)
    # unlike the title words, the words of the slug may repeat
    drop = tx.lit_array(fv.IMAGE_STOPWORDS + fv.IMAGE_GENERIC)
    slug = F.filter(urls.path_words(url), lambda w: (F.length(w) >= 3) & ~F.array_contains(drop, w))
    parts = [bare, F.array_join(F.slice(slug, 1, 8), " ")]
    parts += [F.when(F.size(words) >= n, F.array_join(F.slice(words, 1, n), " ")) for n in (2, 3, 5)]
    texts = F.filter(F.transform(F.array_compact(F.array(*parts)), tx.strip), lambda q: q != "")
    return F.slice(F.array_distinct(texts), 1, most)


def source_quality(source: Column, url: Column, official=None, premium=None, good=None, low=None) -> Column:
    """45 for an official domain, 30 premium, 15 good, -30 low trust, else 0; the first hit wins."""
    name, host = tx.fold_lower(source), urls.host(url)

    def hit(col, terms):
        return reduce(lambda a, b: a | b, [col.contains(t) for t in terms], F.lit(False))

    return (
        F.when(hit(host, fv.OFFICIAL_DOMAINS if official is None else official), 45)
        .when(hit(name, fv.PREMIUM_SOURCES if premium is None else premium), 30)
        .when(hit(name, fv.GOOD_SOURCES if good is None else good), 15)
        .when(hit(name, fv.LOW_TRUST_SOURCES if low is None else low), -30)
        .otherwise(0)
    )


def with_relevance(assets: DataFrame, topic: str = "topic") -> DataFrame:
    """Add score, and the matched word sets, from the words of an image's URL and text."""
    generic, bad = tx.lit_array(fv.IMAGE_GENERIC), tx.lit_array(fv.IMAGE_BAD_WORDS)
    preferred = tx.lit_array(fv.IMAGE_PREFERRED_WORDS)
    plain_files = tx.lit_array(["jpg", "jpeg", "png", "webp", "image", "img"])
    rows = assets.withColumns({
        "_in_url": F.array_distinct(urls.path_words(F.col("url"))),
        "_in_text": F.array_distinct(tx.alnum_tokens(F.col("text"))),
        "_topic": F.array_except(topic, generic),
    })
    rows = rows.withColumns({
        "matched_url_specific": F.array_sort(F.array_intersect("_topic", "_in_url")),
        "matched_text_specific": F.array_sort(F.array_intersect("_topic", "_in_text")),
        "matched_url_generic": F.array_sort(F.array_intersect(generic, "_in_url")),
        "bad_url_terms": F.array_sort(F.array_intersect(bad, "_in_url")),
    })
    in_url, in_text = F.size("matched_url_specific"), F.size("matched_text_specific")
    weak = (in_url == 0) & (in_text < 2)
    left = F.array_except("_in_url", F.concat(generic, bad, plain_files))
    kind = F.col("kind")

    def points(cond: Column, value: int) -> Column:
        return F.when(cond, value).otherwise(0)

    score = (
        F.when(kind == "article", 45).when(kind == "jsonld", 32).when(kind == "og", 28).when(kind == "twitter", 22).otherwise(0)
        + F.least(in_url, F.lit(5)) * 38
        + F.least(in_text, F.lit(5)) * 14
        + points((kind == "article") & (in_url > 0), 20)
        + F.when(F.arrays_overlap("_in_url", preferred), 20).when(F.arrays_overlap("_in_text", preferred), 8).otherwise(0)
        + F.when(F.size("bad_url_terms") > 0, -240).when(F.arrays_overlap("_in_text", bad) & (in_url == 0), -110).otherwise(0)
        + points((F.size("matched_url_generic") > 0) & weak, -140)
        + points((F.size(left) <= 1) & weak, -45)
    )
    return rows.withColumn("score", score).drop("_in_url", "_in_text", "_topic")


def size_allowed(width: Column, height: Column) -> Column:
    ratio = width / F.greatest(height, F.lit(1))
    return (width >= 600) & (height >= 338) & (ratio >= 0.75) & (ratio <= 2.6)


def size_bonus(width: Column, height: Column) -> Column:
    return (
        F.when((width >= 1920) & (height >= 1080), 30)
        .when((width >= 1200) & (height >= 630), 20)
        .when((width >= 800) & (height >= 450), 10)
        .otherwise(0)
    )


def validated(scored: DataFrame, story: str, seq: str = "seq", checked: int = 20) -> DataFrame:
    """The best `checked` images of a story that are large enough, ranked again with a size bonus.

    Expects width and height; cheap scoring comes first, sizes are only read for the best.
    """
    top = top_in_group(scored, [story], [F.col("score").desc(), F.col(seq).asc()], checked, "_first_rank")
    w, h = F.col("width"), F.col("height")
    sized = top.filter(size_allowed(w, h)).withColumn("score", F.col("score") + size_bonus(w, h))
    return top_in_group(sized, [story], [F.col("score").desc(), F.col("_first_rank").asc()], checked, "place").drop("_first_rank")


def acceptable(bonus: Column, original: Column) -> Column:
    """May the image stand for the story? Needs score, the matched sets, width and height."""
    total = F.col("score") + bonus
    in_url, in_text = F.size("matched_url_specific"), F.size("matched_text_specific")
    w, h = F.col("width"), F.col("height")
    told = in_text >= 2
    return (F.size("bad_url_terms") == 0) & (
        ((total >= 105) & (in_url > 0))
        | (original & (total >= 90) & told & (w >= 1000) & (h >= 560))
        | ((bonus >= 30) & (total >= 95) & told & (w >= 1000))
        | ((bonus >= 15) & (total >= 110) & told)
    )


def winners(ranked: DataFrame, story: str, bonus: str = "source_quality_bonus", original: str = "original", looked_at: int = 6) -> DataFrame:
    """Per story (or page of coverage) the first acceptable of its first `looked_at` images."""
    ok = ranked.withColumn("_ok", acceptable(F.col(bonus), F.col(original))).withColumn("score_with_source", F.col("score") + F.col(bonus))
    first = ok.filter(F.col("_ok") & (F.col("place") <= looked_at)).drop("_ok")
    return first.groupBy(story).agg(F.min_by(F.struct(*[c for c in first.columns if c != story]), "place").alias("w")).select(story, "w.*")


def choose_image(found: DataFrame, story: str, tier: str = "tier", seq: str = "seq", shown: int = 5) -> DataFrame:
    """The image of a story from its own article (tier 0), other coverage (1), or the second pool (2).

    A later tier counts only when the earlier ones have nothing. Within a tier the highest score
    wins, the first of equals; the best `shown` of the tier are reported as alternatives.
    """
    order = [F.col(tier).asc(), F.col("score_with_source").desc(), F.col(seq).asc()]
    top = top_in_group(found, [story], order, shown, "_place")
    best = F.min_by(F.struct("url", "kind", "score_with_source", tier), "_place")
    item = F.struct("_place", "url", "score_with_source", tier)
    out = top.groupBy(story).agg(best.alias("b"), F.array_sort(F.collect_list(item)).alias("all"))
    same = F.filter("all", lambda a: a[tier] == F.col(f"b.{tier}"))
    own = F.col(f"b.{tier}") == 0
    return out.select(
        story, F.col("b.url").alias("image_candidate_url"),
        F.when(own, F.col("b.kind")).otherwise(F.concat(F.lit("alternative_"), F.col("b.kind"))).alias("source_type"),
        F.col("b.score_with_source").alias("relevance_score"),
        F.when(own, "ORIGINAL_ARTICLE").otherwise("ALTERNATIVE_COVERAGE").alias("selection_origin"),
        F.transform(same, lambda a: a["url"]).alias("alternatives"), F.lit("IMAGE_CANDIDATE_FOUND").alias("status"),
    )


def coverage(entries: DataFrame, story: str, query: str, place: str = "pos", per_query: int = 7, most: int = 18,
             quality: str = "quality_bonus", own_host: str | None = None, queries: int | None = None) -> DataFrame:
    """Other coverage of a story: first entries per query, distinct URLs, the best sources.

    `queries` limits the search texts that are asked. An entry without a URL takes its place among a query's first, but is no coverage.

    Entries on the host of the original article are left out at the end, as they were counted
    before.
    """
    order = [F.col("query_no").asc(), F.col(place).asc()]
    asked = entries if queries is None else entries.filter(F.col("query_no") <= queries)
    cut = top_in_group(asked, [story, query], [F.col(place).asc()], per_query, "_place").drop("_place").filter("url <> ''")
    rest = [c for c in cut.columns if c not in (story, "url")]
    once = cut.groupBy(story, "url").agg(F.min_by(F.struct(*rest), F.struct("query_no", place)).alias("r")).select(story, "url", "r.*")
    best = top_in_group(once, [story], [F.col(quality).desc(), *order], most, "place")
    return best if own_host is None else best.filter(urls.host(F.col("url")) != F.col(own_host))


def second_pool(entries: DataFrame, story: str, query: str, **options) -> DataFrame:
    """The pool asked when the first coverage has no image: fewer search texts, fewer entries, fewer sources."""
    return coverage(entries, story, query, **{"per_query": 5, "most": 12, "queries": 3, **options})
