"""The registered queries: each reads whole driver tables and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import dates, events as ev, text as tx, urls
from pressroom.operators import merge, ranking, scoring
from pressroom.plans import standins as sd

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _stamp(col):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def _long(*names):
    return [F.col(n).cast("bigint").alias(n) for n in names]


# --- text, tokens, URLs ------------------------------------------------------------------------

@query
def title_normalize(spark, sf) -> DataFrame:
    """Both normal forms and the story key of every headline."""
    return sd.headlines(spark, sf).select(
        "seq", tx.word_normal(F.col("title")).alias("rank_form"), tx.ascii_words(F.col("title")).alias("history_form"),
        tx.slug(F.col("title")).alias("story_key"), tx.file_slug(F.col("title")).alias("file_name"),
    )


@query
def token_sets(spark, sf) -> DataFrame:
    """Word sets of every document's whole text: meaningful, entity, subject, distinctive, events."""
    docs = sd.table(spark, sf, "documents").select(
        "doc_id", tx.word_set(tx.word_normal(F.col("text"))).alias("words"),
        tx.word_set(tx.ascii_words(F.col("text"))).alias("plain"),
    )
    docs = docs.withColumn("subject", ev.subject_words(F.col("plain"), sd.EVENT_CLASSES))

    def show(col):
        return F.array_join(F.array_sort(col), " ")

    return docs.select(
        "doc_id", show(tx.meaningful(F.col("words"))).alias("meaningful"),
        show(tx.entity_words(F.col("words"))).alias("entities"), show(F.col("subject")).alias("subject"),
        show(ev.distinctive_words(F.col("subject"))).alias("distinctive"),
        show(ev.event_set(F.col("plain"), sd.EVENT_CLASSES)).alias("events"),
    )


@query
def event_sets(spark, sf) -> DataFrame:
    """Events and event families of every headline, with the fixed editorial classes and the fixture's."""
    rows = sd.headlines(spark, sf).select("seq", tx.ascii_words(F.col("title")).alias("plain"), tx.word_normal(F.col("title")).alias("normal"))
    rows = rows.withColumn("words", tx.words(F.col("plain")))
    return rows.select(
        "seq", F.array_join(ev.event_set(F.col("words")), " ").alias("editorial_events"),
        F.array_join(ev.event_set(F.col("words"), sd.EVENT_CLASSES), " ").alias("events"),
        F.array_join(ev.with_events_named(F.col("words"), sd.EVENT_CLASSES), " ").alias("named"),
        F.array_join(ev.families(F.col("normal"), sd.EVENT_FAMILIES), " ").alias("families"),
    )


@query
def url_canonical(spark, sf) -> DataFrame:
    """Canonical form, host and path words of every page URL."""
    url = F.col("url")
    return sd.table(spark, sf, "pages").select(
        "page_id", urls.canonical_url(url).alias("canonical"), urls.host(url).alias("host"),
        F.array_join(urls.path_words(url), " ").alias("path_words"),
        F.array_join(urls.last_segment_words(url), " ").alias("file_words"),
        urls.usable_image_url(url).alias("usable"), urls.is_aggregator(url).alias("aggregator"),
    )


@query
def source_strip(spark, sf) -> DataFrame:
    """Source, bare title and merge key of headlines that carry ' - source' at the end."""
    rows = sd.headlines(spark, sf).select("seq", F.concat_ws(" - ", "title", F.upper("source")).alias("raw"), "source")
    found = rows.withColumn("found_source", tx.source_of(F.lit(""), F.col("raw")))
    bare = found.withColumn("bare_title", tx.strip_source(F.col("raw"), F.col("source")))
    return bare.select("seq", "found_source", "bare_title", tx.merge_key(F.lit(""), F.col("bare_title"), F.col("source")).alias("key"))


# --- discovery ---------------------------------------------------------------------------------

@query
def recent_feed(spark, sf) -> DataFrame:
    """Feed rows inside the look-back window of their search; undated rows stay."""
    rows = sd.headlines(spark, sf).filter(dates.in_window(F.col("published"), sd.AS_OF, fv.FALLBACK_WINDOW_DAYS))
    return rows.select("seq", "branch", _stamp(F.col("published")).alias("published"))


@query
def candidate_merge(spark, sf) -> DataFrame:
    """One row per story key: first row wins, categories united, first known date."""
    fresh = dates.in_window(F.col("published"), sd.AS_OF, fv.PRIMARY_WINDOW_DAYS)
    rows = sd.headlines(spark, sf).withColumn("discovery_window_days", F.when(fresh, 3).otherwise(7))
    return merge.merge_rows(rows).select(
        "key", "seq", "merged_rows", "title", "source", F.array_join("categories_seen", ",").alias("categories"),
        *_long("discovery_window_days"), _stamp(F.col("published")).alias("published"),
    )


@query
def page_merge(spark, sf) -> DataFrame:
    """Pages merged by canonical link, and by whole title and source where the link is left out."""
    rows = sd.page_articles(spark, sf)
    link = F.when(F.col("doc_id") % 5 == 0, "").otherwise(urls.canonical_url(F.col("link")))
    rows = rows.withColumns({"key": tx.merge_key(link, F.col("title"), F.col("source")), "discovery_window_days": F.lit(3)})
    return merge.merge_rows(rows).select("key", "seq", "merged_rows", "title", F.array_join("categories_seen", ",").alias("categories"), _stamp(F.col("published")).alias("published"))


def _merged(spark, sf, rows=None):
    rows = sd.headlines(spark, sf) if rows is None else rows
    return merge.merge_rows(rows.withColumn("discovery_window_days", F.lit(fv.PRIMARY_WINDOW_DAYS)))


@query
def branch_discovery_counts(spark, sf) -> DataFrame:
    return merge.discovery_counts(_merged(spark, sf))


@query
def adaptive_window(spark, sf) -> DataFrame:
    """Rows kept per branch and window when poor branches look further back."""
    kept = merge.adaptive_window(sd.headlines(spark, sf), sd.AS_OF, minimum=2500)
    return kept.groupBy("branch", F.col("window_days").cast("bigint").alias("window_days"), "fresh_keys").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seq_sum")
    )


@query
def candidate_ids(spark, sf) -> DataFrame:
    """Merged stories numbered newest first, undated last."""
    return merge.candidate_ids(_merged(spark, sf)).select("candidate_id", "key", "seq")


# --- scoring and shortlist -----------------------------------------------------------------------

def _scored(rows, table=None):
    rows = rows.withColumn("allowed", scoring.allowed_branches(F.col("categories_seen"), F.col("branch"), fv.BRANCHES))
    return scoring.assign_branch(rows, sd.AS_OF, table)


@query
def lexicon_score(spark, sf) -> DataFrame:
    """All three branch scores of every headline under the fixed editorial rules."""
    rows = scoring.with_scores(sd.headlines(spark, sf), sd.AS_OF)
    # inline_outer: explode would infer a filter on the scores and evaluate every rule again
    one = rows.select("seq", F.inline_outer("scores"))
    return one.select("seq", "branch", *_long("score"), F.array_join("reasons", " | ").alias("reasons"))


@query
def branch_assign(spark, sf) -> DataFrame:
    """Best branch of every story when all branches compete, under the fixture's rules."""
    every = F.array(*[F.lit(b) for b in ("tecnologia", "gaming", "cultura_pop")])
    rows = _scored(_merged(spark, sf).withColumn("categories_seen", every), sd.fixture_rules())
    return rows.select("seq", "editorial_branch", *_long("editorial_score"), F.array_join("score_reasons", " | ").alias("reasons"))


@query
def shortlist_topk(spark, sf) -> DataFrame:
    """Merge, score, cap per source, top 8 per branch, numbered."""
    top = ranking.shortlist(_scored(_merged(spark, sf), sd.fixture_rules()))
    return top.select(*_long("shortlist_id", "branch_rank", "editorial_score"), "seq", "editorial_branch", "title", "source")


@query
def shortlist_by_branch(spark, sf) -> DataFrame:
    """The same shortlist nested by branch."""
    top = ranking.shortlist(_scored(_merged(spark, sf), sd.fixture_rules()))
    nested = ranking.by_branch(top, ["branch_rank", "shortlist_id", "title"])
    return nested.select(
        "editorial_branch", F.size("stories").cast("bigint").alias("stories"),
        F.array_join(F.transform("stories", lambda s: F.concat_ws(":", s["branch_rank"], s["shortlist_id"], s["title"])), " | ").alias("listing"),
    )


# --- history -----------------------------------------------------------------------------------

from pressroom.operators import history as hist, neardup  # noqa: E402


def _history_run(spark, sf):
    return hist.block_repeats(
        sd.open_candidates(spark, sf), sd.published_history(spark, sf), sd.AS_OF, classes=sd.EVENT_CLASSES,
        material=["delay", "cancel", "sales", "beta", "announce", "release"],
    )


@query
def history_block(spark, sf) -> DataFrame:
    """Every open article judged against the published history: status, reason, matched row."""
    return _history_run(spark, sf).select("doc_id", "status", "reason", "hist_seq")


@query
def history_split(spark, sf) -> DataFrame:
    """Blocked candidates with the published story they repeat."""
    _, blocked = hist.split_blocked(_history_run(spark, sf), sd.published_history(spark, sf))
    return blocked.select("candidate.doc_id", "reason", "history_match.date", F.col("history_match.title").alias("published_title"))


@query
def history_developments(spark, sf) -> DataFrame:
    """Candidates let through because they carry a published story on."""
    return _history_run(spark, sf).filter("status = 'development'").select("doc_id", "reason", "hist_seq")


@query
def history_prune(spark, sf) -> DataFrame:
    return hist.prune_history(sd.published_history(spark, sf), sd.AS_OF).select("hist_seq", "date", "story_key")


@query
def history_register(spark, sf) -> DataFrame:
    """Today's articles entered into the pruned history."""
    news = sd.open_candidates(spark, sf).withColumn("url", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.regexp_extract("link", "^([^?#]*)", 1)))
    old = sd.published_history(spark, sf).withColumn("date", F.when(F.col("hist_seq") % 40 == 0, "2024-01-31").otherwise(F.col("date")))
    return hist.register(news, old, sd.AS_OF, "2024-01-31")


# --- near duplicates ---------------------------------------------------------------------------

def _article_order():
    return F.struct("doc_id")


@query
def near_dup_pairs(spark, sf) -> DataFrame:
    """Pairs of distinct article titles of a branch that are duplicates, each with its best article."""
    titles, _ = neardup.distinct_titles(sd.page_articles(spark, sf), "branch", "title", _article_order(), sd.EVENT_FAMILIES)
    pairs = neardup.duplicate_titles(titles)
    best = titles.select("title_id", F.col("rank.doc_id").alias("doc"))
    return (
        pairs.join(best.select(F.col("title_id").alias("better"), F.col("doc").alias("better_doc")), "better")
        .join(best.select(F.col("title_id").alias("worse"), F.col("doc").alias("worse_doc")), "worse")
        .select("better_doc", "worse_doc")
    )


@query
def greedy_dedupe(spark, sf) -> DataFrame:
    """Scored articles of each branch walked by rank; a repeat of a kept one is dropped."""
    rows = _scored(sd.page_articles(spark, sf), sd.fixture_rules())
    order = F.struct((-F.col("editorial_score")).alias("neg"), F.col("seq"))
    kept = neardup.greedy_dedupe(rows, "editorial_branch", "title", order, families=sd.EVENT_FAMILIES)
    return kept.select("doc_id", "editorial_branch", *_long("editorial_score"), "accepted")


@query
def shortlist_deduped(spark, sf) -> DataFrame:
    """The full path: history block, score, greedy removal, source cap, top 8 per branch."""
    clean = _history_run(spark, sf).filter("status <> 'blocked'").drop("status", "reason", "hist_seq")
    rows = _scored(clean, sd.fixture_rules())
    order = F.struct((-F.col("editorial_score")).alias("neg"), F.col("seq"))
    kept = neardup.greedy_dedupe(rows, "editorial_branch", "title", order, families=sd.EVENT_FAMILIES).filter("accepted")
    return ranking.shortlist(kept).select(*_long("shortlist_id", "branch_rank", "editorial_score"), "doc_id", "editorial_branch", "title")


# --- selection and quality ---------------------------------------------------------------------

from pressroom.operators import delivery, ledger as lg, quality, selection  # noqa: E402

def _score_order():
    return [F.col("editorial_score").desc(), F.col("seq").asc()]


@query
def two_per_branch(spark, sf) -> DataFrame:
    """The first two stories of every branch per batch, numbered in branch order."""
    rows = selection.first_per_branch(sd.scored_articles(spark, sf), "batch", _score_order())
    return selection.combined_order(rows, "batch").select("batch", "numero", "editorial_branch", "candidate_id", "complete")


@query
def quota_select(spark, sf) -> DataFrame:
    rows = selection.quota_select(sd.scored_articles(spark, sf), "batch")
    return rows.select("batch", "candidate_id", "editorial_branch", *_long("branch_place"), "complete")


@query
def last_history(spark, sf) -> DataFrame:
    return selection.latest_rows(sd.published_history(spark, sf)).select("hist_seq", "date", "title")


@query
def reserve_judgement(spark, sf) -> DataFrame:
    """Every proposed reserve: kept, or why not."""
    cands, chosen, proposed = sd.chosen_and_proposed(spark, sf)
    return selection.judge_reserves(proposed, chosen, cands, "batch").select("batch", "ordinal", "candidate_id", "kept", "reason")


@query
def reserve_repair(spark, sf) -> DataFrame:
    """Kept reserves filled up to two per branch from unused candidates."""
    cands, chosen, proposed = sd.chosen_and_proposed(spark, sf)
    judged = selection.judge_reserves(proposed, chosen, cands, "batch")
    return selection.fill_reserves(judged, chosen, cands, "batch", _score_order())


@query
def selection_violations(spark, sf) -> DataFrame:
    cands, chosen, _ = sd.chosen_and_proposed(spark, sf)
    return quality.choice_violations(chosen, cands, "batch")


@query
def reserve_violations(spark, sf) -> DataFrame:
    cands, chosen, proposed = sd.chosen_and_proposed(spark, sf)
    return quality.choice_violations(proposed, cands, "batch", least=2, most=2, taken=chosen)


@query
def batch_violations(spark, sf) -> DataFrame:
    return quality.batch_violations(sd.stories(spark, sf), "batch")


def _batches(spark, sf):
    """Open stories in batches, judged against the published history."""
    judged = hist.block_repeats(sd.page_batches(sd.open_candidates(spark, sf)), sd.published_history(spark, sf), sd.AS_OF, classes=sd.EVENT_CLASSES)
    return judged.withColumns({"blocked": F.col("status") == "blocked", "healthy": F.lit(True)})


@query
def batch_substitute(spark, sf) -> DataFrame:
    """Stories that repeat the history or their batch give their slot to a reserve."""
    return selection.substitute(_batches(spark, sf), "batch", sd.EVENT_CLASSES)


@query
def asset_recover(spark, sf) -> DataFrame:
    """Stories whose image fails the audit are replaced; healthy ones are protected."""
    images = sd.assets(spark, sf).select(
        F.col("asset_id").alias("doc_id"),
        (delivery.image_verdict(F.col("n_bytes"), F.col("width"), F.col("height")) == "ok").alias("image_ok"),
    )
    rows = _batches(spark, sf).join(images, "doc_id", "left").withColumn("healthy", F.coalesce("image_ok", F.lit(False)))
    return selection.substitute(rows, "batch", sd.EVENT_CLASSES)


@query
def batch_pair_check(spark, sf) -> DataFrame:
    """Pairs of stories of one batch, all pages, that tell the same story."""
    return selection.batch_repeats(sd.page_batches(sd.page_articles(spark, sf)), "batch", sd.EVENT_CLASSES)


# --- ledger ------------------------------------------------------------------------------------

QUEUE_STOP_USD = 20.0


def _costed(spark, sf):
    rows = sd.ledger(spark, sf)
    return rows.withColumn("cost_usd", lg.call_cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens"), F.col("cached_tokens")))


@query
def token_cost(spark, sf) -> DataFrame:
    """Estimated tokens and cost of every conversation, over its whole text."""
    turns = sd.table(spark, sf, "conversations").withColumn("tokens", tx.token_estimate(F.col("text")))
    sums = turns.groupBy("conv_id").agg(
        F.sum(F.when(F.col("role") != "assistant", F.col("tokens")).otherwise(0)).alias("input_tokens"),
        F.sum(F.when(F.col("role") == "assistant", F.col("tokens")).otherwise(0)).alias("output_tokens"),
    )
    cost = lg.call_cost(F.lit("gpt-5.6-terra"), F.col("input_tokens"), F.col("output_tokens"))
    return sums.select("conv_id", "input_tokens", "output_tokens", F.round(cost, 9).alias("cost_usd"))


@query
def ledger_month(spark, sf) -> DataFrame:
    totals = lg.monthly_totals(_costed(spark, sf), ["model"])
    return totals.select("month", "model", "calls", F.round("spent_usd", 6).alias("spent_usd"))


@query
def budget_status(spark, sf) -> DataFrame:
    scaled = {"monthly_budget_usd": 500.0, "warning_usd": 30.0, "critical_usd": 120.0, "internal_stop_usd": 450.0}
    out = lg.with_budget(lg.monthly_totals(_costed(spark, sf)), scaled)
    return out.select("month", "calls", F.round("spent_usd", 6).alias("spent_usd"), "level", F.round("remaining_usd", 6).alias("remaining_usd"))


@query
def call_admission(spark, sf) -> DataFrame:
    """Each conversation as a request against what its month has spent."""
    scaled = {"monthly_budget_usd": 500.0, "warning_usd": 30.0, "critical_usd": 120.0, "internal_stop_usd": 98.0}
    turns = sd.table(spark, sf, "conversations").groupBy("conv_id").agg(F.sum(tx.token_estimate(F.col("text"))).alias("input_tokens"))
    requests = turns.select(
        "conv_id", F.lit("2024-01").alias("month"), F.lit("gpt-5.6-terra").alias("model"), "input_tokens",
        (F.col("input_tokens") * 2).alias("max_output_tokens"),
    )
    out = lg.admit(requests, lg.monthly_totals(_costed(spark, sf)), scaled)
    return out.select("conv_id", F.round("reserve_usd", 6).alias("reserve_usd"), F.round("projected_usd", 6).alias("projected_usd"), "admitted")


@query
def call_queue(spark, sf) -> DataFrame:
    """Every event as a request in a queue: an admitted call spends, a blocked one does not."""
    calls = _costed(spark, sf).select(
        F.col("event_id").alias("id"), "ts", dates.month_key(F.col("ts")).alias("month"), "model", "input_tokens",
        (F.col("output_tokens") * 2).alias("max_output_tokens"), "cost_usd",
    )
    out = lg.admit_queue(calls, budget={**fv.BUDGET, "internal_stop_usd": QUEUE_STOP_USD})
    nano = lambda c: F.round(F.col(c) * 1e9).cast("bigint")
    return out.select(F.col("id").alias("event_id"), "month", nano("reserve_usd").alias("reserve"), nano("spent_usd").alias("spent"), "admitted")


# --- delivery ----------------------------------------------------------------------------------

EXPECTED = delivery.expected_keys([f"{i:02d}" for i in range(1, 7)])


@query
def delivery_reconcile(spark, sf) -> DataFrame:
    return delivery.reconcile(sd.pieces(spark, sf), "run", EXPECTED)


@query
def piece_counts(spark, sf) -> DataFrame:
    """Expected pieces that do not exist exactly once per run."""
    return delivery.not_exactly_one(sd.pieces(spark, sf), "run", EXPECTED)


@query
def run_guard(spark, sf) -> DataFrame:
    """Hours without a completed run (a purchase completes the hour)."""
    rows = sd.pieces(spark, sf)
    log = rows.filter("event_type = 'purchase'").select("run", F.lit("completed").alias("status"))
    return delivery.runs_to_do(rows.select("run").distinct(), log, "run")


@query
def run_log(spark, sf) -> DataFrame:
    """The log of completed hours after those whose pieces are all delivered are entered."""
    rows = sd.pieces(spark, sf)
    log = rows.filter("event_type = 'purchase'").select("run").distinct().select(
        "run", F.lit("completed").alias("status"), F.lit("2024-01-30 00:00:00").cast("timestamp").alias("completed_at")
    )
    done = delivery.reconcile(rows, "run", EXPECTED).filter("complete")
    return delivery.mark_completed(done, log, sd.AS_OF, "run").withColumn("completed_at", _stamp(F.col("completed_at")))


@query
def asset_audit(spark, sf) -> DataFrame:
    a = sd.assets(spark, sf)
    fmt = F.when(F.col("asset_id") % 7 == 0, "JPEG").otherwise("PNG")
    return a.select(
        "asset_id", delivery.image_verdict(F.col("n_bytes"), F.col("width"), F.col("height")).alias("image"),
        delivery.piece_verdict(F.col("n_bytes"), fmt, F.col("width"), F.col("height"), target=(1060, 588)).alias("piece"),
    )


# --- pages and images --------------------------------------------------------------------------

from pressroom.functions import html as hx  # noqa: E402
from pressroom.operators import images, modules, pages  # noqa: E402


@query
def page_metadata(spark, sf) -> DataFrame:
    rows = pages.page_metadata(sd.table(spark, sf, "pages"))
    return rows.select("page_id", "page_title", "description", "extract")


@query
def page_article(spark, sf) -> DataFrame:
    rows = pages.article_text(sd.table(spark, sf, "pages"))
    return rows.select("page_id", "titulo_original", "descripcion", "extracto", F.array_join("parrafos", " || ").alias("parrafos"), "useful")


@query
def page_context(spark, sf) -> DataFrame:
    """Context per page's story: its own page when it has paragraphs, a neighbour's, or the headline."""
    src = sd.table(spark, sf, "pages")
    texts = pages.article_text(src)
    stories = src.select(F.col("page_id").alias("numero"), F.concat(F.lit("story "), F.col("page_id").cast("string")).alias("titulo"), F.lit("feed").alias("fuente"), "url")
    other = src.select((F.col("page_id") - 1).alias("numero"), F.lit("").alias("resolved_article_url"), F.col("url").alias("image_source_url"), F.lit("other").alias("image_source"), F.col("page_id").alias("seq"))
    rows = pages.article_context(stories, texts, other)
    return rows.select("numero", "titulo_original", "context_source", "context_origin", "estado")


@query
def context_counts(spark, sf) -> DataFrame:
    """Stories with a whole and with a partial context, per origin."""
    return delivery.status_counts(page_context(spark, sf), "estado", {"OK": "ok", "PARCIAL": "partial"}, ["context_origin"])


@query
def duplicate_counts(spark, sf) -> DataFrame:
    """Articles of each branch that the greedy walk keeps and removes."""
    rows = greedy_dedupe(spark, sf).withColumn("state", F.when(F.col("accepted"), "kept").otherwise("removed"))
    return delivery.status_counts(rows, "state", {"kept": "kept", "removed": "removed"}, ["editorial_branch"])


@query
def image_references(spark, sf) -> DataFrame:
    """Images named by pages written from the manifest, merged by URL."""
    return pages.image_references(sd.asset_pages(spark, sf)).select("page_id", "url", "kind", "text")


def _relevant(spark, sf):
    return images.with_relevance(sd.assets_with_topic(spark, sf))


@query
def asset_score(spark, sf) -> DataFrame:
    rows = _relevant(spark, sf)
    return rows.select(
        "asset_id", *_long("score"), F.array_join("matched_url_specific", " ").alias("in_url"),
        F.array_join("matched_text_specific", " ").alias("in_text"),
    )


def _ranked(spark, sf):
    rows = images.validated(_relevant(spark, sf), "story")
    return rows.withColumn("source_quality_bonus", images.source_quality(F.col("source"), F.col("url"), **sd.TIERS))


@query
def asset_accept(spark, sf) -> DataFrame:
    """The image accepted per story among its best six large enough ones."""
    w = images.winners(_ranked(spark, sf), "story")
    return w.select("story", "asset_id", *_long("score_with_source", "place"))


@query
def asset_choice(spark, sf) -> DataFrame:
    """Cascade over groups of three stories: own article, other coverage, second pool."""
    w = images.winners(_ranked(spark, sf), "story").withColumns({"tier": (F.col("story") % 3).cast("int"), "group": F.floor(F.col("story") / 3)})
    return images.choose_image(w, "group").select(
        F.col("group").cast("bigint").alias("group"), "image_candidate_url", "source_type", *_long("relevance_score"), "selection_origin",
        F.array_join("alternatives", " ").alias("alternatives"),
    )


@query
def source_quality(spark, sf) -> DataFrame:
    """Quality bonus of every document's source, under the fixture's and the fixed tiers."""
    docs = sd.table(spark, sf, "documents")
    url = F.concat(F.lit("https://"), F.col("source"), F.lit("x.example.org/"), F.col("doc_id").cast("string"))
    tiers = {**sd.TIERS, "official": ["src19x.example.org"]}
    return docs.select("doc_id", images.source_quality(F.col("source"), url, **tiers).cast("bigint").alias("fixture"),
                       images.source_quality(F.concat(F.col("source"), F.lit(" Wired")), url).cast("bigint").alias("fixed"))


@query
def coverage_topk(spark, sf) -> DataFrame:
    entries = sd.coverage_entries(spark, sf).withColumn("quality_bonus", images.source_quality(F.col("source"), F.col("url"), **sd.TIERS))
    top = images.coverage(entries, "story", "query").withColumn("own", F.concat(F.lit("h"), (F.col("story") % 13).cast("string"), F.lit(".example.org")))
    return top.filter(urls.host(F.col("url")) != F.col("own")).select("story", "url", *_long("place", "quality_bonus"), "pos")


@query
def coverage_second(spark, sf) -> DataFrame:
    """The second pool: three search texts, five entries each, twelve sources."""
    entries = sd.coverage_entries(spark, sf).withColumn("quality_bonus", images.source_quality(F.col("source"), F.col("url"), **sd.TIERS))
    return images.second_pool(entries, "story", "query").select("story", "url", *_long("place", "quality_bonus"), "pos")


@query
def query_derive(spark, sf) -> DataFrame:
    """Search texts derived from every page's heading and URL."""
    heading = hx.plain_text(F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))
    rows = sd.table(spark, sf, "pages").withColumn("title", heading)
    return rows.select("page_id", F.array_join(images.search_queries(F.col("title"), F.lit(""), F.col("url")), " | ").alias("queries"))


# --- facts, modules, cards ---------------------------------------------------------------------

def _phrase():
    return F.element_at(F.array(*[F.lit(x) for x in sd.PHRASES]), (F.col("doc_id") % len(sd.PHRASES) + 1).cast("int"))


def _text_stories(spark, sf):
    """Stories whose fields are a whole text's sentences: one each, and all others with a phrase of the module rules."""
    s = F.filter(F.transform(F.split("text", "[.\n]+"), lambda x: F.trim(x)), lambda x: x != "")
    docs = sd.table(spark, sf, "documents").withColumn("s", s)

    def part(i):
        return F.coalesce(F.get("s", F.lit(i)), F.lit(""))

    return docs.select(
        "doc_id", part(0).alias("titulo"), part(1).alias("por_que_importa"), part(2).alias("anguloShort"),
        F.concat_ws(". ", F.array_join(F.slice("s", 4, 2147483647), ". "), _phrase()).alias("resumen"), F.upper("source").alias("categoria"), sd._branch().alias("rama"),
        F.lpad((F.col("doc_id") % 6 + 1).cast("string"), 2, "0").alias("numero"), F.col("source").alias("fuente"),
        F.lit("").alias("imagenFuente"), F.lit("").alias("fecha_original"),
    )


@query
def fact_extract(spark, sf) -> DataFrame:
    """Dates, amounts and platforms in every document's whole text."""
    text = F.col("text")
    return sd.table(spark, sf, "documents").select(
        "doc_id", modules.date_in(text).alias("date"), modules.amount_in(text).alias("amount"),
        F.array_join(modules.platforms_in(text), " / ").alias("platforms"),
    )


@query
def module_build(spark, sf) -> DataFrame:
    rows = modules.with_modules(_text_stories(spark, sf)).select("doc_id", F.posexplode_outer("modules").alias("place", "m"))
    return rows.select("doc_id", *_long("place"), "m.titulo", "m.texto")


@query
def module_pick(spark, sf) -> DataFrame:
    rows = modules.pick_two(modules.with_modules(_text_stories(spark, sf)))
    return rows.select("doc_id", F.array_join(F.transform("picked", lambda m: F.concat_ws(": ", m["titulo"], m["texto"])), " || ").alias("picked"))


@query
def card_payload(spark, sf) -> DataFrame:
    rows = modules.payload(modules.pick_two(modules.with_modules(_text_stories(spark, sf))))
    return rows.select("doc_id", "numero", "categoria", "rama", "subheadline", "imagenFuente", "moduleCount", "module1Title", "module1Text",
                       "module2Title", "module2Text", "module3Title", "titleSize", "module1Size", "compact")


@query
def length_buckets(spark, sf) -> DataFrame:
    """Size classes and cut texts of every headline."""
    length = F.length("title")
    return sd.headlines(spark, sf).select(
        "seq", tx.size_bucket(length, modules.TITLE_STEPS, "title-xlong").alias("title_size"),
        tx.size_bucket(length, modules.MODULE_STEPS, "module-sm").alias("module_size"),
        tx.cut_at_word(F.col("title"), 40).alias("cut"), tx.shorten(F.col("title"), 40).alias("short"),
        tx.first_words(F.col("title"), 3).alias("lead"),
        tx.highlight(F.col("title"), tx.first_words(F.col("title"), 1), "<b>", "</b>").alias("marked"),
    )


@query
def final_records(spark, sf) -> DataFrame:
    """Chosen copy joined with its candidate's facts and numbered."""
    cands, chosen, _ = sd.chosen_and_proposed(spark, sf)
    facts = sd.scored_articles(spark, sf).withColumn("url", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")))
    rows = modules.final_records(chosen.withColumn("ordinal", F.col("candidate_id")), facts, "batch", dates.card_date(dates.clock(sd.AS_OF)))
    return rows.select("batch", "numero", "candidate_id", "categoria", "rama", "fecha", "fuente", "url", _stamp(F.col("fecha_original")).alias("fecha_original"))


# --- streams -----------------------------------------------------------------------------------

from pressroom.session import scratch_path  # noqa: E402
from pressroom.streaming import streams  # noqa: E402


def _stream(spark, sf, name):
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    # a pattern that only the table's own path fits: a stream reads a plain path as a folder, and the table may be one file or a folder of files
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


@query
def stream_dedupe(spark, sf) -> DataFrame:
    """Story keys of the page stream, each once: by link, and by whole title and source for pages whose link is left out."""
    fed = sd.page_feed(_stream(spark, sf, "pages"))
    link = F.when(F.col("doc_id") % 3 == 0, "").otherwise(urls.canonical_url(F.col("link")))
    rows = fed.select(tx.merge_key(link, F.col("title"), F.col("source")).alias("key"), "published", F.lit(sd.AS_OF).cast("timestamp").alias("arrived"))
    out = streams.drain(streams.dedupe_stream(rows), scratch_path(spark, "dedupe"), scratch_path(spark, "dedupe-state"))
    return out.select("key")


@query
def stream_spend(spark, sf) -> DataFrame:
    """Daily spend per model from the event stream, with an alert level."""
    calls = _stream(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("user_id") % 2 == 0, "gpt-5.6-terra").otherwise("gpt-5.6-luna").alias("model"),
        F.floor(F.col("value") * 40).cast("bigint").alias("i"), F.floor(F.col("value") * 8).cast("bigint").alias("o"),
    )
    costed = calls.withColumn("cost_usd", lg.call_cost(F.col("model"), F.col("i"), F.col("o")))
    out = streams.drain_updates(
        streams.spend_windows(costed), scratch_path(spark, "spend"), scratch_path(spark, "spend-state"), ["start", "model"]
    )
    level = streams.with_alert(out, {"monthly_budget_usd": 10.0, "warning_usd": 0.5, "critical_usd": 2.5, "internal_stop_usd": 3.5})
    return level.select(_stamp(F.col("start")).alias("start"), "model", "calls", F.round("spent_usd", 6).alias("spent_usd"), "level")


@query
def stream_register(spark, sf) -> DataFrame:
    """The page stream entered into the published history."""
    fed = sd.page_feed(_stream(spark, sf, "pages"))
    news = fed.select("title", "branch", "source", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.regexp_extract("link", "^([^?#]*)", 1)).alias("url"), "seq")
    return streams.register_stream(
        news, sd.published_history(spark, sf), scratch_path(spark, "registry"), scratch_path(spark, "registry-state"), sd.AS_OF, "2024-01-31"
    )


# --- landed files and outputs --------------------------------------------------------------------

from pressroom.sources import landed, outputs  # noqa: E402


@query
def landed_list(spark, sf) -> DataFrame:
    """Every record of landed JSON lists: read, or rejected, or both where only a field is mistyped."""
    path = scratch_path(spark, "lists")
    sd.landed_lists(spark, sf, path)
    rows, rejected = landed.json_records(spark, path, "doc_id bigint, n_chars bigint, more struct<source:string>, text string")
    number = F.regexp_extract("record", r'doc_id"?: (\d+)', 1).cast("bigint")
    bad = rejected.select(number.alias("doc_id"), F.lit(None).cast("bigint").alias("n_chars"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("text_md5"), F.lit("rejected").alias("state"))
    return rows.select("doc_id", "n_chars", F.col("more.source").alias("source"), F.md5("text").alias("text_md5"), F.lit("read").alias("state")).unionByName(bad)


@query
def landed_rss(spark, sf) -> DataFrame:
    """Entries of landed RSS files that are undated or recent."""
    path = scratch_path(spark, "feed")
    sd.landed_feed(spark, sf, path)
    return landed.rss_items(spark, path, sd.AS_OF, "gaming", "q", 3).select("link", "title", "source", _stamp(F.col("published")).alias("published"))


@query
def image_headers(spark, sf) -> DataFrame:
    """Format, size and verdict of every landed image, from its headers."""
    path = scratch_path(spark, "images")
    sd.image_files(spark, sf, path)
    rows = landed.image_manifest(spark, path).withColumn("key", F.regexp_extract("path", r"([0-9]+)$", 1).cast("bigint"))
    verdict = delivery.image_verdict(F.col("n_bytes"), F.col("width"), F.col("height"))
    return rows.select("key", "n_bytes", "format", *_long("width", "height"), verdict.alias("verdict"))


@query
def stage_versions(spark, sf) -> DataFrame:
    """A stage table replaced by a later run that reads it: the newest version, and the earlier run's snapshot."""
    path, schema = scratch_path(spark, "stage"), "doc_id bigint, source string, n_chars bigint"
    outputs.overwrite(sd.table(spark, sf, "documents").select("doc_id", "source", "n_chars"), path, "monday")
    outputs.overwrite(outputs.stage_table(spark, path, schema).filter("n_chars > 500"), path, "tuesday")
    newest = outputs.stage_table(spark, path, schema).withColumn("version", F.lit("newest"))
    return newest.unionByName(outputs.stage_table(spark, path, schema, "monday").withColumn("version", F.lit("monday")))


@query
def canonical_records(spark, sf) -> DataFrame:
    """Records under alias names: the first name that holds something counts."""
    docs = sd.table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" Re: "), "text")).alias("title"), F.when(F.col("doc_id") % 3 == 0, F.lit("  ")).otherwise(F.col("text")).alias("titulo"),
        F.lit("").alias("source"), F.col("source").alias("fuente"),
    )
    out = merge.canonical_rows(docs, headline=["title", "titulo"], origin=["source", "fuente"], address=["url", "link"])
    return out.select("doc_id", F.md5("headline").alias("headline"), "origin", "address")


@query
def cover_dates(spark, sf) -> DataFrame:
    """The date on each batch's cover: its first story's, or the card date of the run."""
    docs = sd.table(spark, sf, "documents")
    shown = F.when(F.col("doc_id") % 4 == 0, " ").otherwise(F.concat(F.lit(" "), (F.col("doc_id") % 28 + 1).cast("string"), F.lit(" ene 2024")))
    first = docs.groupBy(F.floor(F.col("doc_id") / 6).cast("bigint").alias("batch")).agg(F.min_by(shown, "doc_id").alias("shown"))
    return first.select("batch", dates.cover_date(F.col("shown"), dates.clock(sd.AS_OF)).alias("cover"))
