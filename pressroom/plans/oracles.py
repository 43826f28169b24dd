"""Independent SQL (DuckDB dialect) for the registered queries, over the same tables."""

from __future__ import annotations

from pressroom import fixed_values as fv
from pressroom.plans import standins as sd

ORACLES = {}

BRANCH = "case lang when 'en' then 'gaming' when 'es' then 'tecnologia' else 'cultura_pop' end"
PUBLISHED = "case when doc_id % 17 = 0 then null else timestamp '2024-01-31' - (doc_id % 240) * interval 1 hour end"
FEED = f"""
parts as (select doc_id, lang, source, string_split_regex(text, '[.\n]+') as parts from documents),
pieces as (select doc_id, lang, source, unnest(parts) as piece, generate_subscripts(parts, 1) - 1 as pos from parts),
feed as (
  select doc_id, doc_id * 1000000 + pos as seq, trim(piece) as title, source, {BRANCH} as branch,
    {PUBLISHED} as published, 'title:' || lower(trim(piece)) || '|source:' || lower(source) as key
  from pieces where trim(piece) <> ''
)"""
ARTICLES = f"""
articles as (
  select doc_id, doc_id as seq, trim(text) as title, source, {BRANCH} as branch, {PUBLISHED} as published from documents
)"""
PAGE_ARTICLES = f"""
page_rows as (select page_id as doc_id, trim(regexp_extract(html, '{sd.HEADING}', 1)) as title, regexp_extract(url, '{sd.PAGE_HOST}', 1) as source,
  regexp_extract(url, '{sd.PAGE_LANGUAGE}', 1) as lang, url as link from pages),
articles as (select doc_id, doc_id as seq, title, source, {BRANCH} as branch, {PUBLISHED} as published, link,
  rtrim(regexp_extract(link, '^([^?#]*)', 1), '/') as canonical from page_rows
)"""


def words(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def normal(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def plain(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(strip_accents(lower({x})), 'https?://\\S+', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def split(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def event_case(word: str, classes) -> str:
    out = "case"
    for event, prefixes, whole in classes:
        tests = [f"starts_with({word}, '{p}')" for p in prefixes] + [f"{word} = '{w}'" for w in whole]
        out += f" when {' or '.join(tests)} then '{event}'"
    return out + " end"


def families(padded: str, table) -> str:
    return "list_filter([" + ", ".join(
        "case when " + " or ".join(f"contains({padded}, ' {p} ')" for p in phrases) + f" then '{name}' end"
        for name, phrases in table.items()) + "], lambda f: f is not null)"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


ORACLES["title_normalize"] = f"""with {FEED}
select seq, {normal('title')} as rank_form, {plain('title')} as history_form,
  substring(trim(regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '-', 'g'), '-'), 1, 140) as story_key,
  coalesce(nullif(trim(regexp_replace(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g'), '[\\s_-]+', '_', 'g'), '_'), ''), 'noticia') as file_name
from feed"""

STOP = fv.HISTORY_STOPWORDS + fv.HISTORY_GENERIC
SUBJECT = (
    f"list_filter(list_distinct(p), lambda w: length(w) >= 3 and not list_contains({words(STOP)}, w) "
    f"and not regexp_matches(w, '^0*20[0-9]{{2}}$') and ({event_case('w', sd.EVENT_CLASSES)}) is null)"
)
ORACLES["token_sets"] = f"""with t as (
  select doc_id, list_distinct({split(normal('text'))}) as w, {split(plain('text'))} as p from documents),
s as (select doc_id, w, p, {SUBJECT} as subject from t)
select doc_id,
  array_to_string(list_sort(list_filter(w, lambda x: length(x) >= 3 and not list_contains({words(fv.RANK_STOPWORDS)}, x))), ' ') as meaningful,
  array_to_string(list_sort(list_filter(w, lambda x: length(x) >= 3 and not list_contains({words(fv.RANK_STOPWORDS + fv.RANK_EVENT_NOISE)}, x))), ' ') as entities,
  array_to_string(list_sort(subject), ' ') as subject,
  array_to_string(list_sort(list_filter(subject, lambda x: length(x) >= 5)), ' ') as distinctive,
  array_to_string(list_sort(list_distinct(list_filter(list_transform(p, lambda x: {event_case('x', sd.EVENT_CLASSES)}), lambda e: e is not null))), ' ') as events
from s"""

ORACLES["event_sets"] = f"""with {FEED},
t as (select seq, {split(plain('title'))} as w, ' ' || {normal('title')} || ' ' as padded from feed)
select seq,
  array_to_string(list_sort(list_distinct(list_filter(list_transform(w, lambda x: {event_case('x', fv.EVENT_CLASSES)}), lambda e: e is not null))), ' ') as editorial_events,
  array_to_string(list_sort(list_distinct(list_filter(list_transform(w, lambda x: {event_case('x', sd.EVENT_CLASSES)}), lambda e: e is not null))), ' ') as events,
  array_to_string(list_transform(w, lambda x: coalesce({event_case('x', sd.EVENT_CLASSES)}, x)), ' ') as named,
  array_to_string({families('padded', sd.EVENT_FAMILIES)}, ' ') as families
from t"""

ORACLES["url_canonical"] = """
select page_id,
  lower(regexp_extract(url, '^(https?)://', 1)) || '://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1))
    || rtrim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/') as canonical,
  lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) as host,
  array_to_string(regexp_extract_all(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '[a-z0-9]+'), ' ') as path_words,
  array_to_string(regexp_extract_all(lower(regexp_extract(url, '^https?://[^/?#]*[^?#]*?([^/?#]*)/?(?:[?#].*)?$', 1)), '[a-z0-9]+'), ' ') as file_words,
  not (regexp_matches(lower(split_part(split_part(url, '?', 1), '#', 1)), '[.](svg|gif|ico)$')
    or regexp_matches(lower(split_part(split_part(url, '?', 1), '#', 1)), '/favicon|/icons/|/icon/|/avatars/|/sprite/|/sprites/|/badges/|/_next/static/media/')) as usable,
  (lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) = 'news.google.com' or contains(url, '/rss/articles/') or contains(url, '/read/')) as aggregator
from pages"""

ORACLES["source_strip"] = f"""with {FEED}
select seq, trim(list_extract(string_split(title || ' - ' || upper(source), ' - '), -1)) as found_source, title as bare_title, key from feed"""

ORACLES["recent_feed"] = f"""with {FEED}
select seq, branch, {stamp('published')} as published from feed
where published is null or published >= timestamp '2024-01-31' - interval 170 hour"""

MERGED = f"""{FEED},
merged as (
  select key, min(seq) as seq, count(*) as merged_rows, arg_min(title, seq) as title, arg_min(source, seq) as source,
    list_sort(list(distinct branch)) as cats, arg_min(branch, seq) as branch,
    min(case when published is null or published >= timestamp '2024-01-31' - interval 74 hour then 3 else 7 end) as win,
    arg_min(published, seq) filter (where published is not null) as published
  from feed group by key
)"""
ORACLES["candidate_merge"] = f"""with {MERGED}
select key, seq, merged_rows, title, source, array_to_string(cats, ',') as categories,
  win::bigint as discovery_window_days, {stamp('published')} as published from merged"""

ORACLES["page_merge"] = f"""with {PAGE_ARTICLES},
k as (select *, case when doc_id % 5 = 0 or canonical = '' then 'title:' || lower(title) || '|source:' || lower(source) else 'url:' || canonical end as key from articles)
select key, min(seq) as seq, count(*) as merged_rows, arg_min(title, seq) as title, array_to_string(list_sort(list(distinct branch)), ',') as categories,
  {stamp('arg_min(published, seq) filter (where published is not null)')} as published from k group by key"""

ORACLES["branch_discovery_counts"] = f"""with {MERGED}
select branch, count(*) as stories from (select unnest(cats) as branch from merged) group by branch"""

ORACLES["adaptive_window"] = f"""with {FEED},
stats as (select branch, count(distinct key) filter (where published is null or published >= timestamp '2024-01-31' - interval 74 hour) as fresh_keys
  from feed group by branch),
chosen as (select branch, fresh_keys, case when fresh_keys < 2500 then 7 else 3 end as window_days from stats)
select branch, window_days::bigint as window_days, fresh_keys, count(*) as rows, sum(seq)::bigint as seq_sum
from feed join chosen using (branch)
where published is null or published >= timestamp '2024-01-31' - (window_days * 24 + 2) * interval 1 hour
group by all"""

ORACLES["candidate_ids"] = f"""with {MERGED}
select row_number() over (order by published desc nulls last, seq) as candidate_id, key, seq from merged"""


# --- scoring -------------------------------------------------------------------------------------

AGE = """case when published is null then 0
  when published >= timestamp '2024-01-31' - interval 12 hour then 16
  when published >= timestamp '2024-01-31' - interval 24 hour then 12
  when published >= timestamp '2024-01-31' - interval 48 hour then 7
  when published >= timestamp '2024-01-31' - interval 72 hour then 3 else -20 end"""


def _term(t: str) -> str:
    import re

    return " ".join(re.sub(r"[^\w\s]", " ", t.lower()).split()).replace("'", "''")


def _any(terms) -> str:
    return "(" + " or ".join(f"contains(padded, ' {_term(t)} ')" for t in terms) + ")"


def _points(rule) -> str:
    if rule.kind == "count":
        total = " + ".join(f"contains(padded, ' {_term(t)} ')::int" for t in rule.terms)
        return f"(least(({total}) * {abs(rule.points)}, {rule.cap}) * {1 if rule.points > 0 else -1})"
    test = (
        "(" + " or ".join(f"regexp_matches(norm, '{p}')" for p in rule.terms) + ")" if rule.kind == "regex" else _any(rule.terms)
    )
    if rule.also:
        test += " and " + _any(rule.also)
    if rule.unless:
        test += " and not " + _any(rule.unless)
    return f"(case when {test} then {rule.points} else 0 end)"


def _source(rules) -> str:
    def hit(terms):
        return " or ".join(f"contains(src, '{_term(t)}')" for t in terms)

    return f"(case when {hit(rules.premium)} then 30 when {hit(rules.good)} then 20 when {hit(rules.low)} then -12 else 5 end)"


def score_cte(table, source_table: str, extra: str) -> str:
    """CTE `scored`: one row per (row, branch) with score and reasons."""
    arms = []
    for branch, rules in table.items():
        labels = words(["fuente", "actualidad"] + [r.label for r in rules.rules])
        points = ", ".join([_source(rules), AGE] + [_points(r) for r in rules.rules])
        arms.append(f"select {extra}, '{branch}' as branch, {labels} as labels, [{points}] as pts from prepared")
    return f"""prepared as (select *, {normal('title')} as norm, ' ' || {normal('title')} || ' ' as padded, {normal('source')} as src from {source_table}),
arms as ({' union all '.join(arms)}),
scored as (select * exclude (labels, pts), list_sum(pts)::bigint as score,
  array_to_string(list_transform(list_filter(list_zip(labels, pts), lambda z: z[2] <> 0 or z[1] in ('fuente', 'actualidad')),
    lambda z: z[1] || ' ' || case when z[2] >= 0 then '+' else '' end || z[2]), ' | ') as reasons from arms)"""


def _editorial():
    from pressroom.operators.scoring import EDITORIAL_RULES

    return EDITORIAL_RULES


ORACLES["lexicon_score"] = f"""with {FEED}, base as (select seq, title, source, published from feed),
{score_cte(_editorial(), 'base', 'seq')}
select seq, branch, score, reasons from scored"""

ORACLES["branch_assign"] = f"""with {MERGED}, base as (select seq, title, source, published from merged),
{score_cte(sd.fixture_rules(), 'base', 'seq')}
select seq, branch as editorial_branch, score as editorial_score, reasons from scored
qualify row_number() over (partition by seq order by score desc, case branch when 'tecnologia' then 1 when 'gaming' then 2 else 3 end) = 1"""

RANKED = f"""{MERGED}, base as (select seq, title, source, published, cats from merged),
{score_cte(sd.fixture_rules(), 'base', 'seq, title, source, cats')},
assigned as (select * from scored where list_contains(cats, branch)
  qualify row_number() over (partition by seq order by score desc, list_position(cats, branch)) = 1)"""
TOPK = """capped as (select * from {src} qualify row_number() over (partition by branch, {norm} order by score desc, seq) <= 3),
top8 as (select *, row_number() over (partition by branch order by score desc, seq) as branch_rank from capped qualify branch_rank <= 8),
short as (select *, row_number() over (order by case branch when 'gaming' then 1 when 'tecnologia' then 2 else 3 end, branch_rank) as shortlist_id from top8)"""
ORACLES["shortlist_topk"] = f"""with {RANKED}, {TOPK.format(src='assigned', norm=normal('source'))}
select shortlist_id, branch_rank, score as editorial_score, seq, branch as editorial_branch, title, source from short"""
ORACLES["shortlist_by_branch"] = f"""with {RANKED}, {TOPK.format(src='assigned', norm=normal('source'))}
select branch as editorial_branch, count(*) as stories,
  string_agg(branch_rank || ':' || shortlist_id || ':' || title, ' | ' order by branch_rank) as listing from short group by branch"""


# --- history -------------------------------------------------------------------------------------

def whole(row: str) -> str:
    """The whole title of a row as words: what tells stories apart."""
    return f"trim(regexp_replace(strip_accents(lower({row}.title)), '[^a-z0-9]+', '-', 'g'), '-')"


HISTORY = f"""{PAGE_ARTICLES},
hist as (select doc_id as hist_seq, strftime(date '2024-01-31' - (doc_id % 40)::int, '%Y-%m-%d') as date, branch, title, source, link as url, canonical,
  substring(trim(regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '-', 'g'), '-'), 1, 140) as story_key
  from articles where not regexp_matches(link, '[?#]')),
open as (select * replace (case when doc_id % 3 = 1 then title || ' {sd.NEWS_WORD}' else title end as title) from articles where regexp_matches(link, '[?#]'))"""
ORACLES["history_prune"] = f"""with {HISTORY} select hist_seq, date, story_key from hist where date::timestamp >= timestamp '2024-01-31' - interval 30 day"""
ORACLES["history_register"] = f"""with {HISTORY},
old as (select * replace (case when hist_seq % 40 = 0 then '2024-01-31' else date end as date) from hist),
kept as (select date, branch, title, source, url, story_key from old where date::timestamp >= timestamp '2024-01-31' - interval 30 day),
news as (select doc_id, branch, title, source, case when doc_id % 3 = 0 then '' else regexp_extract(link, '^([^?#]*)', 1) end as url,
  substring(trim(regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '-', 'g'), '-'), 1, 140) as story_key from open where title <> ''),
urlrows as (select * from news n where url <> '' and not exists (select 1 from kept k where k.date = '2024-01-31' and k.url = n.url)
  qualify row_number() over (partition by url order by doc_id) = 1),
keyrows as (select * from news n where url = '' and not exists (select 1 from kept k where k.date = '2024-01-31' and {whole('k')} = {whole('n')})
  and not exists (select 1 from urlrows u where {whole('u')} = {whole('n')} and u.doc_id < n.doc_id)
  qualify row_number() over (partition by {whole('n')} order by doc_id) = 1)
select * from kept
union all select '2024-01-31', branch, title, source, url, story_key from urlrows
union all select '2024-01-31', branch, title, source, url, story_key from keyrows"""
ORACLES["last_history"] = f"""with {HISTORY} select hist_seq, date, title from hist order by hist_seq desc limit 30"""


# --- selection and quality -----------------------------------------------------------------------

SCORED = f"""{ARTICLES}, sc as (select doc_id as candidate_id, doc_id as seq, title, branch as editorial_branch, doc_id // 24 as batch,
  (doc_id * 37) % 101 as editorial_score from articles)"""
BRANCH_ORD = "case editorial_branch when 'gaming' then 1 when 'tecnologia' then 2 else 3 end"
ORACLES["two_per_branch"] = f"""with {SCORED},
t as (select *, row_number() over (partition by batch, editorial_branch order by editorial_score desc, seq) as place from sc qualify place <= 2)
select batch, lpad((row_number() over (partition by batch order by {BRANCH_ORD}, place))::varchar, 2, '0') as numero, editorial_branch, candidate_id,
  count(*) over (partition by batch) = 6 as complete from t"""
ORACLES["quota_select"] = f"""with {SCORED},
t as (select *, row_number() over (partition by batch, editorial_branch order by editorial_score desc, seq) as branch_place from sc qualify branch_place <= 3),
b as (select batch, count(*) as base from t where branch_place <= 2 group by batch),
extra as (select batch, candidate_id from t where branch_place = 3 qualify row_number() over (partition by batch order by editorial_score desc, seq) = 1),
picked as (select t.* from t join b using (batch) left join extra e on t.candidate_id = e.candidate_id
  where branch_place <= 2 or (base = 5 and e.candidate_id is not null)),
stats as (select batch, count(*) = 6 and count(distinct editorial_branch) = 3 as complete from picked group by batch)
select batch, candidate_id, editorial_branch, branch_place, complete from picked join stats using (batch)"""
CHOSEN = f"""{SCORED},
lab as (select sc.*, quality, toxic from sc join labels on candidate_id = doc_id),
chosen as (select batch, candidate_id, editorial_branch from lab where quality = 1 and toxic = 0),
proposed as (select batch, case when toxic = 1 then candidate_id + 1 else candidate_id end as candidate_id, editorial_branch, candidate_id as ordinal
  from lab where quality = 0 or toxic = 1)"""
JUDGED = f"""{CHOSEN},
p as (select p.*, case when exists (select 1 from chosen c where c.batch = p.batch and c.candidate_id = p.candidate_id) then 'solapada o duplicada'
    when sc.candidate_id is null then 'candidate_id inexistente' when sc.editorial_branch <> p.editorial_branch then 'rama alterada' end as own
  from proposed p left join sc on sc.candidate_id = p.candidate_id),
firsts as (select batch, candidate_id, min(ordinal) as o, arg_min(editorial_branch, ordinal) as editorial_branch from p where own is null group by all),
keep as (select * from firsts qualify row_number() over (partition by batch, editorial_branch order by o) <= 2),
judged as (select p.batch, p.ordinal, p.candidate_id, p.editorial_branch, coalesce(k.o = p.ordinal, false) as kept,
  case when k.o = p.ordinal then null when k.o < p.ordinal then 'solapada o duplicada' else coalesce(own, 'cupo de rama excedido') end as reason
  from p left join keep k on k.batch = p.batch and k.candidate_id = p.candidate_id)"""
ORACLES["reserve_judgement"] = f"with {JUDGED} select batch, ordinal, candidate_id, kept, reason from judged"
ORACLES["reserve_repair"] = f"""with {JUDGED},
kk as (select batch, candidate_id, editorial_branch from judged where kept),
used as (select batch, candidate_id from kk union select batch, candidate_id from chosen),
free as (select *, row_number() over (partition by batch, editorial_branch order by editorial_score desc, seq) as place
  from sc where not exists (select 1 from used u where u.batch = sc.batch and u.candidate_id = sc.candidate_id)),
have as (select batch, editorial_branch, count(*) as n from kk group by all)
select *, 'kept' as origin from kk union all
select f.batch, f.candidate_id, f.editorial_branch, 'filled' from free f left join have h using (batch, editorial_branch) where place <= 2 - coalesce(n, 0)"""


def _choice(rows: str, least: int, most: int, taken: str) -> str:
    quota = " or ".join(f"count(*) filter (editorial_branch = '{b}') not between {least} and {most}" for b in fv.BRANCHES)
    shown = " || ', ' || ".join(f"'{b}=' || count(*) filter (editorial_branch = '{b}')" for b in fv.BRANCHES)
    return f"""with {CHOSEN},
r as (select r.*, sc.editorial_branch as known from {rows} r left join sc on sc.candidate_id = r.candidate_id)
select batch, 'overlap' as rule, candidate_id::varchar as detail, 'error' as severity from r where {taken}
union all select batch, 'unknown_id', candidate_id::varchar, 'error' from r where known is null
union all select batch, 'branch_changed', candidate_id || ': ' || known || ' -> ' || editorial_branch, 'error' from r where known <> editorial_branch
union all select batch, 'duplicate_id', candidate_id::varchar, 'error' from r group by batch, candidate_id having count(*) > 1
union all select batch, 'count', count(*)::varchar, 'error' from r group by batch having count(*) <> 6
union all select batch, 'branch_quota', {shown}, 'error' from r group by batch having {quota}"""


ORACLES["selection_violations"] = _choice("chosen", 1, 3, "false")
ORACLES["reserve_violations"] = _choice(
    "proposed", 2, 2, "exists (select 1 from chosen c where c.batch = r.batch and c.candidate_id = r.candidate_id)")

STORIES = f"""sent as (select doc_id, lang, source, {BRANCH} as b,
  list_filter(list_transform(string_split_regex(text, '[.\n]+'), lambda s: trim(s)), lambda s: s <> '') as s from documents),
base as (select *, s[1] as titulo, array_to_string(s[2:], '. ') as resumen, array_to_string(string_split(s[1], ' ')[1:3], ' ') as lead from sent),
st as (select doc_id, doc_id // 6 as batch, doc_id % 6 + 1 as place,
  case when doc_id % 29 = 0 then '09' else lpad((doc_id % 6 + 1)::varchar, 2, '0') end as numero,
  case when doc_id % 31 = 0 then 'deportes' else b end as rama, titulo, resumen,
  case when lang = 'de' then '¡' || lead else lead end as mark, array_to_string(string_split(resumen, ' ')[1:2], ' ') as mark2,
  case when doc_id % 37 = 0 then '' else 'doc:' || doc_id end as url from base)"""
_quota = " or ".join(f"count(*) filter (rama = '{b}') not between 1 and 3" for b in fv.BRANCHES)
_shown = " || ', ' || ".join(f"'{b}=' || count(*) filter (rama = '{b}')" for b in fv.BRANCHES)
ORACLES["batch_violations"] = f"""with {STORIES}
select batch, numero, 'numero' as rule, numero as detail, 'error' as severity from st where numero <> lpad(place::varchar, 2, '0')
union all select batch, numero, 'branch', rama, 'error' from st where rama = 'deportes'
union all select batch, numero, 'empty_field', 'titulo', 'error' from st where trim(titulo) = ''
union all select batch, numero, 'empty_field', 'resumen', 'error' from st where trim(resumen) = ''
union all select batch, numero, 'empty_field', 'url', 'error' from st where url = ''
union all select batch, numero, 'highlight_empty', 'tituloDestacado', 'error' from st where trim(mark) = ''
union all select batch, numero, 'highlight_empty', 'resumenDestacado', 'error' from st where trim(mark2) = ''
union all select batch, numero, 'highlight_not_literal', 'tituloDestacado: ' || trim(mark), 'warning' from st where trim(mark) <> '' and not contains(titulo, trim(mark))
union all select batch, numero, 'highlight_not_literal', 'resumenDestacado: ' || case when trim(mark2) <> '' and not contains(trim(resumen), trim(mark2)) then trim(mark2) || ' | ' else '' end || 'zzz', 'warning'
  from st where not contains(resumen, 'zzz')
union all select batch, numero, 'duplicate_numero', numero, 'error' from st group by batch, numero having count(*) > 1
union all select batch, '', 'count', count(*)::varchar, 'error' from st group by batch having count(*) <> 6
union all select batch, '', 'branch_quota', {_shown}, 'error' from st group by batch having {_quota}"""


# --- ledger and delivery -------------------------------------------------------------------------

COSTED = """calls as (select event_id, ts, case when user_id % 2 = 0 then 'gpt-5.6-terra' else 'gpt-5.6-luna' end as model,
  floor(value * 40)::bigint as i, floor(value * 8)::bigint as o, floor(value * 10)::bigint as c from events),
costed as (select *, strftime(ts - interval 5 hour, '%Y-%m') as month,
  (greatest(i - c, 0) * 2.0 + c * 0.2 + o * 12.0) / 1e6 * case when model = 'gpt-5.6-luna' then 0.1 else 1 end as cost from calls)"""
ORACLES["token_cost"] = """with t as (select conv_id, role, floor(length(text) / 3.2)::bigint + 400 as tokens from conversations),
s as (select conv_id, (sum(case when role <> 'assistant' then tokens else 0 end))::bigint as input_tokens,
  (sum(case when role = 'assistant' then tokens else 0 end))::bigint as output_tokens from t group by conv_id)
select *, round(input_tokens * 2.0::double / 1e6 + output_tokens * 12.0::double / 1e6, 9)::double as cost_usd from s"""
ORACLES["ledger_month"] = f"with {COSTED} select month, model, count(*) as calls, round(sum(cost::double), 6) as spent_usd from costed group by all"
ORACLES["budget_status"] = f"""with {COSTED}, t as (select month, count(*) as calls, sum(cost::double) as spent from costed group by month)
select month, calls, round(spent, 6) as spent_usd, case when spent >= 450 then 'STOP' when spent >= 120 then 'CRITICO' when spent >= 30 then 'ADVERTENCIA' else 'NORMAL' end as level,
  round(greatest(450 - spent, 0), 6) as remaining_usd from t"""
ORACLES["call_admission"] = f"""with {COSTED}, t as (select sum(cost::double) as spent from costed where month = '2024-01'),
r as (select conv_id, sum(floor(length(text) / 3.2)::bigint + 400)::bigint as i from conversations group by conv_id),
w as (select conv_id, i * 2.0::double / 1e6 + 2 * i * 12.0::double / 1e6 + 0.01 as reserve, spent from r, t)
select conv_id, round(reserve, 6)::double as reserve_usd, round(spent + reserve, 6)::double as projected_usd, spent < 98.0 and spent + reserve <= 98.0 as admitted from w"""

ORACLES["call_queue"] = f"""with recursive {COSTED},
calls2 as (select *, round(((greatest(i, 0) * 2.0::double + 2 * o * 12.0::double) / 1e6 * case when model = 'gpt-5.6-luna' then 0.1::double else 1 end + 0.01) * 1e9)::bigint as reserve,
  round(cost::double * 1e9)::bigint as nano from costed),
q as (select *, row_number() over (partition by month order by ts, event_id) as n from calls2),
lists as (select month, list(reserve order by n) as r, list(nano order by n) as c, count(*) as rows from q group by month),
walk as (select month, 1::bigint as n, 0::bigint as spent from lists union all
  select w.month, w.n + 1, case when w.spent + l.r[w.n] <= 20000000000 and w.spent < 20000000000 then w.spent + l.c[w.n] else w.spent end
  from walk w join lists l on l.month = w.month where w.n < l.rows)
select event_id, month, reserve, spent, spent < 20000000000 and spent + reserve <= 20000000000 as admitted from q join walk using (month, n)"""

PIECES = """pieces as (select strftime(ts, '%Y-%m-%d %H') as run, lpad((event_id % 9)::varchar, 2, '0') as key, event_type <> 'error' as delivered, event_type from events)"""
ORACLES["delivery_reconcile"] = f"""with {PIECES},
s as (select run, list(distinct key) as found, coalesce(list(distinct key) filter (delivered), []) as sent from pieces where key <= '07' group by run),
k as (select ['00', '01', '02', '03', '04', '05', '06', '07'] as keys)
select run, 8::bigint as expected, len(found)::bigint as found, len(sent)::bigint as delivered,
  array_to_string(list_filter(keys, lambda x: not list_contains(found, x)), ',') as missing,
  array_to_string(list_filter(keys, lambda x: not list_contains(sent, x)), ',') as undelivered, len(sent) = 8 and len(found) = 8 as complete from s, k"""
ORACLES["piece_counts"] = f"""with {PIECES}, runs as (select distinct run from pieces),
keys as (select unnest(['00', '01', '02', '03', '04', '05', '06', '07']) as key),
n as (select run, key, count(*) as n from pieces group by all)
select run, key, coalesce(n, 0)::bigint as pieces from runs cross join keys left join n using (run, key) where coalesce(n, 0) <> 1"""
ORACLES["run_guard"] = f"with {PIECES} select run from pieces group by run having count(*) filter (event_type = 'purchase') = 0"
ORACLES["run_log"] = f"""with {PIECES}, log as (select distinct run from pieces where event_type = 'purchase'),
done as (select run from pieces where key <= '07' group by run having count(distinct key) = 8 and count(distinct key) filter (delivered) = 8)
select run, 'completed' as status, '2024-01-30 00:00:00' as completed_at from log
union all select run, 'completed', strftime(timestamp '{sd.AS_OF}', '%Y-%m-%d %H:%M:%S') from done where run not in (select run from log)"""
ORACLES["asset_audit"] = """with a as (select p_partkey as asset_id, floor(p_retailprice * 21)::bigint as n, 300 + 40 * p_size as w, 170 + 22 * p_size as h from part)
select asset_id, case when n < 20000 then 'archivo demasiado pequeño: ' || n || ' bytes' when w < 600 or h < 338 then 'dimensiones insuficientes: ' || w || 'x' || h else 'ok' end as image,
  case when n < 10000 then 'archivo demasiado pequeno' when asset_id % 7 = 0 then 'formato JPEG' when w <> 1060 or h <> 588 then w || 'x' || h || '; se esperaba 1060x588' else 'ok' end as piece from a"""


# --- pages and images ----------------------------------------------------------------------------

def plain_html(x: str) -> str:
    out = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def cut(x: str, n: int, ending: str = "…") -> str:
    return f"case when length({x}) <= {n} then {x} else trim(regexp_replace(substring({x}, 1, {n}), ' [^ ]*$', '')) || '{ending}' end"


PAGES = f"""vis as (select page_id, url, html, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g') as v from pages),
sec as (select *, coalesce(nullif(regexp_extract(v, '(?is)<article\\b[^>]*>(.*?)</article>', 1), ''), nullif(regexp_extract(v, '(?is)<main\\b[^>]*>(.*?)</main>', 1), ''), v) as body,
  {plain_html("regexp_extract(v, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} as h1, {plain_html("regexp_extract(v, '(?is)<title[^>]*>(.*?)</title>', 1)")} as tt from vis),
par as (select *, list_transform(regexp_extract_all(body, '(?is)<p\\b[^>]*>(.*?)</p>', 1), lambda p: {plain_html('p')}) as ps from sec)"""
ORACLES["page_metadata"] = f"""with {PAGES},
k as (select page_id, h1, list_filter(ps, lambda p: length(p) >= 70) as good from par),
d as (select page_id, h1, array_to_string(list_filter(good, lambda p, i: list_position(good, p) = i)[1:2], ' ') as ex from k)
select page_id, h1 as page_title, '' as description, ex as extract from d"""
ORACLES["page_article"] = f"""with {PAGES},
k as (select page_id, case when h1 <> '' then h1 else tt end as t, list_filter(ps, lambda p: length(p) >= 50) as good from par),
d as (select page_id, t, list_filter(good, lambda p, i: list_position(list_transform(good, lambda q: lower(q)), lower(p)) = i) as kept from k)
select page_id, t as titulo_original, '' as descripcion, array_to_string(kept[1:3], ' ') as extracto,
  array_to_string(kept, ' || ') as parrafos, (t <> '' or len(kept) > 0) as useful from d"""
_canon = "rtrim(regexp_extract(lower(regexp_extract(url, '^https?://[^/?#]*', 0)) || regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '.*'), '/')"
ORACLES["page_context"] = f"""with {PAGES},
t as (select page_id, {_canon} as key, case when h1 <> '' then h1 else tt end as title from par
  qualify row_number() over (partition by key order by page_id) = 1),
s as (select page_id as numero, {_canon} as key, 'story ' || page_id as titulo from pages),
o as (select s.*, a.title as own, b.title as other from s left join t a on a.key = s.key
  left join s n on n.numero = s.numero + 1 left join t b on b.key = n.key)
select numero, coalesce(own, other, titulo) as titulo_original, case when own is null and other is not null then 'other' else 'feed' end as context_source,
  case when own is not null then 'ORIGINAL_ARTICLE' when other is not null then 'ALTERNATIVE_COVERAGE' else 'RSS_FALLBACK' end as context_origin,
  case when own is null and other is null then 'PARCIAL' else 'OK' end as estado from o"""

ORACLES["context_counts"] = f"""select context_origin, count(*) filter (where estado = 'OK') as ok, count(*) filter (where estado = 'PARCIAL') as partial, count(*) as total
from ({ORACLES["page_context"]}) group by context_origin"""

PARTS = """a as (select p_partkey as asset_id, p_partkey // 40 as story, 'https://cdn.example.com/' || replace(p_name, ' ', '-') || '-' || p_partkey || '.jpg' as url,
  lower(p_type || ' ' || p_name || ' ' || p_brand) as text, ['article', 'jsonld', 'og', 'twitter'][p_partkey % 4 + 1] as kind,
  300 + 40 * p_size as width, 170 + 22 * p_size as height from part)"""
ORACLES["image_references"] = f"""with {PARTS}, m as (select *, url || '?w=1' as u, asset_id % 6 as way from a)
select story as page_id, u as url, 'article' as kind, kind || '  ' || text || ' now' as text from m where way = 0
union all select story, u, 'og', 'A & B' from m where way = 1
union all select story, 'https://cdn.example.com/tw-' || asset_id || '.jpg', 'twitter', '' from m where way = 2
union all select story, unnest([u, u || '&amp;t=1', 'https://cdn.example.com/deep-' || asset_id || '.jpg']), 'jsonld', '' from m where way = 3
union all select story, 'https://example.org/s-' || asset_id || '-900.jpg', 'article', ' wide ' from m where way = 4
union all select story, 'https://example.org/img/' || asset_id || '.png', 'article', 'lazy  ' from m where way = 5"""
_TOPIC = f"""lead as (select story, text as headline from a where asset_id = story * 40),
topic as (select story, list_filter(list_distinct(regexp_extract_all(headline, '[a-z0-9]+') || ['gear', 'official', 'hot']),
  lambda w: length(w) >= 3 and not list_contains({words(fv.IMAGE_STOPWORDS)}, w) and not list_contains({words(fv.IMAGE_GENERIC)}, w)) as topic from lead),
f as (select a.*, topic, list_distinct(regexp_extract_all(lower(regexp_extract(url, '^https://[^/]*([^?#]*)', 1)), '[a-z0-9]+')) as u,
  list_distinct(regexp_extract_all(text, '[a-z0-9]+')) as t from a join topic using (story)),
m as (select *, list_sort(list_intersect(topic, u)) as mu, list_sort(list_intersect(topic, t)) as mt,
  list_intersect({words(fv.IMAGE_GENERIC)}, u) as gu, list_intersect({words(fv.IMAGE_BAD_WORDS)}, u) as bu, list_intersect({words(fv.IMAGE_BAD_WORDS)}, t) as bt,
  list_filter(u, lambda w: not list_contains({words(fv.IMAGE_GENERIC + fv.IMAGE_BAD_WORDS + ['jpg', 'jpeg', 'png', 'webp', 'image', 'img'])}, w)) as rest from f),
scored as (select *, (case kind when 'article' then 45 when 'jsonld' then 32 when 'og' then 28 else 22 end + least(len(mu), 5) * 38 + least(len(mt), 5) * 14
  + case when kind = 'article' and len(mu) > 0 then 20 else 0 end
  + case when list_has_any(u, {words(fv.IMAGE_PREFERRED_WORDS)}) then 20 when list_has_any(t, {words(fv.IMAGE_PREFERRED_WORDS)}) then 8 else 0 end
  - case when len(bu) > 0 then 240 when len(bt) > 0 and len(mu) = 0 then 110 else 0 end
  - case when len(gu) > 0 and len(mu) = 0 and len(mt) < 2 then 140 else 0 end
  - case when len(rest) <= 1 and len(mu) = 0 and len(mt) < 2 then 45 else 0 end)::bigint as score from m)"""
ORACLES["asset_score"] = f"""with {PARTS}, {_TOPIC}
select asset_id, score, array_to_string(mu, ' ') as in_url, array_to_string(mt, ' ') as in_text from scored"""
_WIN = f"""{PARTS}, {_TOPIC},
top20 as (select *, row_number() over (partition by story order by score desc, asset_id) as r from scored qualify r <= 20),
big as (select *, score + case when width >= 1920 and height >= 1080 then 30 when width >= 1200 and height >= 630 then 20 when width >= 800 and height >= 450 then 10 else 0 end as s2
  from top20 where width >= 600 and height >= 338 and width / height between 0.75 and 2.6),
rk as (select *, row_number() over (partition by story order by s2 desc, r) as place,
  case story % 7 when 1 then 30 when 2 then 15 when 3 then 15 when 4 then -30 when 5 then -30 else 0 end as bonus from big),
ok as (select *, s2 + bonus as total from rk where place <= 6 and len(bu) = 0 and (
  (s2 + bonus >= 105 and len(mu) > 0) or (asset_id % 3 = 0 and s2 + bonus >= 90 and len(mt) >= 2 and width >= 1000 and height >= 560)
  or (bonus >= 30 and s2 + bonus >= 95 and len(mt) >= 2 and width >= 1000) or (bonus >= 15 and s2 + bonus >= 110 and len(mt) >= 2))),
win as (select * from ok qualify row_number() over (partition by story order by place) = 1)"""
ORACLES["asset_accept"] = f"with {_WIN} select story, asset_id, total::bigint as score_with_source, place from win"
ORACLES["asset_choice"] = f"""with {_WIN}
select story // 3 as "group", url as image_candidate_url, case when story % 3 = 0 then kind else 'alternative_' || kind end as source_type,
  total::bigint as relevance_score, case when story % 3 = 0 then 'ORIGINAL_ARTICLE' else 'ALTERNATIVE_COVERAGE' end as selection_origin,
  (select string_agg(o.url, ' ' order by o.total desc, o.asset_id) from win o where o.story // 3 = win.story // 3 and o.story % 3 = win.story % 3) as alternatives
from win qualify row_number() over (partition by story // 3 order by story % 3, total desc, asset_id) = 1"""


def _tiers(name: str, official: str, tiers) -> str:
    def hit(terms):
        return " or ".join(f"contains({name}, '{t}')" for t in terms)

    return (f"(case when {official} then 45 when {hit(tiers['premium'])} then 30 when {hit(tiers['good'])} then 15 "
            f"when {hit(tiers['low'])} then -30 else 0 end)::bigint")


ORACLES["source_quality"] = f"""select doc_id, {_tiers('source', "source = 'src19'", sd.TIERS)} as fixture,
  {_tiers("lower(source || ' Wired')", 'false', {'premium': fv.PREMIUM_SOURCES, 'good': fv.GOOD_SOURCES, 'low': fv.LOW_TRUST_SOURCES})} as fixed from documents"""
ORACLES["coverage_topk"] = f"""with e as (select doc_id // 200 as story, lang, case lang when 'de' then 1 when 'en' then 2 when 'es' then 3 else 4 end as q, doc_id as pos,
  'https://h' || (doc_id % 13) || '.example.org/' || (doc_id // 3) as url, source from documents),
c as (select * from e qualify row_number() over (partition by story, lang order by pos) <= 7),
o as (select *, {_tiers('source', 'false', sd.TIERS)} as quality_bonus from c qualify row_number() over (partition by story, url order by q, pos) = 1),
t as (select *, row_number() over (partition by story order by quality_bonus desc, q, pos) as place from o qualify place <= 18)
select story, url, place, quality_bonus, pos from t where not starts_with(url, 'https://h' || (story % 13) || '.example.org/')"""
ORACLES["coverage_second"] = f"""with e as (select doc_id // 200 as story, lang, case lang when 'de' then 1 when 'en' then 2 when 'es' then 3 else 4 end as q, doc_id as pos,
  'https://h' || (doc_id % 13) || '.example.org/' || (doc_id // 3) as url, source from documents),
c as (select * from e where q <= 3 qualify row_number() over (partition by story, lang order by pos) <= 5),
o as (select *, {_tiers('source', 'false', sd.TIERS)} as quality_bonus from c qualify row_number() over (partition by story, url order by q, pos) = 1)
select story, url, row_number() over (partition by story order by quality_bonus desc, q, pos) as place, quality_bonus, pos from o qualify place <= 12"""
ORACLES["query_derive"] = f"""with {PAGES},
w as (select page_id, h1, list_filter(list_distinct(regexp_extract_all(strip_accents(lower(h1)), '[a-z0-9]+')),
    lambda w: length(w) >= 3 and not list_contains({words(fv.IMAGE_STOPWORDS + fv.IMAGE_GENERIC)}, w)) as d0,
  regexp_extract_all(strip_accents(lower(h1)), '[a-z0-9]+') as raw,
  list_filter(regexp_extract_all(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '[a-z0-9]+'),
    lambda w: length(w) >= 3 and not list_contains({words(fv.IMAGE_STOPWORDS + fv.IMAGE_GENERIC)}, w)) as slug from par),
x as (select *, list_filter(raw, lambda r, i: list_contains(d0, r) and list_position(raw, r) = i) as d from w),
q as (select page_id, list_filter([h1, array_to_string(slug[1:8], ' '), case when len(d) >= 2 then array_to_string(d[1:2], ' ') end,
  case when len(d) >= 3 then array_to_string(d[1:3], ' ') end, case when len(d) >= 5 then array_to_string(d[1:5], ' ') end], lambda v: v <> '') as v from x)
select page_id, array_to_string(list_filter(v, lambda t, i: list_position(v, t) = i)[1:5], ' | ') as queries from q"""


# --- facts, modules, cards -----------------------------------------------------------------------

_W = r"[\p{L}\p{N}_]"
ORACLES["fact_extract"] = f"""select doc_id,
  coalesce(nullif(regexp_extract(text, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])((?:\\d{{1,2}}\\s+de\\s+)?(?:{'|'.join(fv.MONTH_NAMES_ES)})\\s+de\\s+20\\d\\d)(?:$|[^\\p{{L}}\\p{{N}}_])', 1), ''),
    regexp_extract(text, '(?:^|[^\\p{{L}}\\p{{N}}_])(20\\d\\d)(?:$|[^\\p{{L}}\\p{{N}}_])', 1)) as date,
  regexp_extract(text, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])(\\d[\\d.,]*\\s+(?:millones|mil\\s+millones)\\s+de\\s+d[oó]lares)(?:$|[^\\p{{L}}\\p{{N}}_])', 1) as amount,
  array_to_string(list_filter([{', '.join(f"case when contains(' ' || lower(strip_accents(text)) || ' ', '{n}') then '{t}' end" for t, n in fv.PLATFORM_NEEDLES)}], lambda x: x is not null), ' / ') as platforms
from documents"""
def short(x: str, n: int) -> str:
    c = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"case when length({c}) <= {n} then {c} else rtrim(regexp_replace(substring({c}, 1, {n}), ' [^ ]*$', ''), ' ,.;:') || '.' end"


def _has(*needles: str) -> str:
    return "(" + " or ".join(f"contains(folded, '{n}')" for n in needles) + ")"


def _plain_words(x: str) -> str:
    return split(f"regexp_replace(regexp_replace(lower(strip_accents({x})), '[^\\x00-\\x7f]', '', 'g'), '[^a-z0-9]+', ' ', 'g')")


_month = "|".join(fv.MONTH_NAMES_ES)
_edge, _end = "(?:^|[^\\p{L}\\p{N}_])", "(?:$|[^\\p{L}\\p{N}_])"
_needs = {t: n for t, n in fv.MODULE_NEEDS.items() if t is not None}
_need = lambda k: "case title " + " ".join(f"when '{t}' then {n[k]}" for t, n in _needs.items()) + f" else {fv.MODULE_NEEDS[None][k]} end"
MODULES = f"""sent as (select doc_id, source, {BRANCH} as rama, list_filter(list_transform(string_split_regex(text, '[.\n]+'), lambda s: trim(s)), lambda s: s <> '') as s from documents),
story as (select doc_id, rama, source, coalesce(s[1], '') as titulo, coalesce(s[2], '') as importa, coalesce(s[3], '') as angulo,
  array_to_string(s[4:], '. ') || '. ' || ({words(sd.PHRASES)})[doc_id % {len(sd.PHRASES)} + 1] as resumen, upper(source) as categoria from sent),
corpus as (select *, concat_ws(' ', titulo, resumen, angulo, importa, categoria) as corpus, case when angulo <> '' then angulo else resumen end as angle from story),
facts as (select *, lower(strip_accents(corpus)) as folded,
  coalesce(nullif(regexp_extract(corpus, '(?i){_edge}((?:\\d{{1,2}}\\s+de\\s+)?(?:{_month})\\s+de\\s+20\\d\\d){_end}', 1), ''), regexp_extract(corpus, '{_edge}(20\\d\\d){_end}', 1)) as day,
  regexp_extract(corpus, '(?i){_edge}(\\d[\\d.,]*\\s+(?:millones|mil\\s+millones)\\s+de\\s+d[oó]lares){_end}', 1) as amount,
  list_filter([{", ".join(f"case when contains(' ' || lower(strip_accents(corpus)) || ' ', '{n}') then '{t}' end" for t, n in fv.PLATFORM_NEEDLES)}], lambda x: x is not null) as platforms from corpus),
lead as (select *, case when {_has("inviert", "inversion")} and amount <> '' then {{'t': 'INVERSIÓN', 'x': amount}} when {_has("retras", "aplaz")} and day <> '' then {{'t': 'FECHA', 'x': day}}
  when {_has("nintendo switch 2")} then {{'t': 'PLATAFORMA', 'x': 'Nintendo Switch 2'}} when {_has("pelicula")} and day <> '' then {{'t': 'LANZAMIENTO', 'x': day}}
  when {_has("ciberataque", "hackeo", "robo de datos")} then {{'t': 'QUÉ CAMBIA', 'x': {short("angle", 88)}}} when {_has("semanal", "cada semana")} then {{'t': 'DISPONIBILIDAD', 'x': {short("angle", 88)}}}
  else {{'t': 'CONTEXTO', 'x': {short("categoria", 72)}}} end as m1 from facts),
mods as (select doc_id, unnest([m1, {{'t': 'POR QUÉ IMPORTA', 'x': {short("case when importa <> '' then importa else angle end", 96)}}},
  case when {_has("nvlink fusion")} then {{'t': 'TECNOLOGÍA', 'x': 'NVLink Fusion'}} when day <> '' and m1.t not in ('FECHA', 'LANZAMIENTO') then {{'t': 'FECHA', 'x': day}}
    when len(platforms) > 0 and m1.t <> 'PLATAFORMA' then {{'t': 'PLATAFORMAS', 'x': array_to_string(platforms[1:3], ' / ')}} else {{'t': 'DATO CLAVE', 'x': {short("angle", 96)}}} end]) as m,
  unnest([0, 1, 2]) as place from lead)"""
ORACLES["module_build"] = f"with {MODULES} select doc_id, place::bigint as place, m.t as titulo, m.x as texto from mods"
_same = "(len({a}.w) > 0 and len({b}.w) > 0 and ({a}.w = {b}.w or (least(len(list_distinct({a}.w)), len(list_distinct({b}.w))) >= 5 and len(list_intersect({a}.w, {b}.w)) >= 0.82 * least(len(list_distinct({a}.w)), len(list_distinct({b}.w))))))"
PICKED = f"""{MODULES},
d0 as (select doc_id, place, m.t as titulo, m.x as texto, {_plain_words('m.x')} as w, upper(array_to_string({_plain_words('m.t')}, ' ')) as title, length(trim(m.x)) as n from mods),
d1 as (select *, n < {_need(0)} or (len(w) <= 1 and len(w) >= {_need(2)} and n < {_need(1)}) as weak from d0),
d as (select *, least(n, 100) + len(w) * 4 + case title {" ".join(f"when '{t}' then {b}" for t, b in fv.MODULE_BONUS.items())} else 0 end - case when weak then 120 else 0 end as score,
  count(*) filter (not weak) over (partition by doc_id) as strong from d1),
u as (select *, case when strong < 2 then row_number() over (partition by doc_id order by score desc, place) else row_number() over (partition by doc_id order by place) end as up
  from d where strong < 2 or not weak),
k as (select c.*, (a.up is not null and c.up > 1 and {_same.format(a='c', b='a')}) as like1, b.up is not null and c.up > 2 and {_same.format(a='c', b='b')} and not {_same.format(a='b', b='a')} as like2
  from u c left join u a on a.doc_id = c.doc_id and a.up = 1 left join u b on b.doc_id = c.doc_id and b.up = 2),
o as (select *, count(*) filter (not coalesce(like1, false) and not coalesce(like2, false)) over (partition by doc_id) as kept from k),
c as (select *, row_number() over (partition by doc_id order by up) as ci, list_contains({words(fv.EDITORIAL_MODULES)}, title) as ed, list_contains({words(fv.CONCRETE_MODULES)}, title) as co
  from o where kept < 2 or (not coalesce(like1, false) and not coalesce(like2, false))),
r as (select *, case when ed and row_number() over (partition by doc_id, ed order by score desc, ci) = 1 then 0 when co and row_number() over (partition by doc_id, co order by score desc, ci) = 1 then 1 else 2 end as prio from c),
once as (select * from r qualify row_number() over (partition by doc_id, titulo, texto order by prio, score desc, ci) = 1),
two as (select *, row_number() over (partition by doc_id order by prio, score desc, ci) as pick from once qualify pick <= 2)"""
ORACLES["module_pick"] = f"with {PICKED} select doc_id, string_agg(titulo || ': ' || texto, ' || ' order by pick) as picked from two group by doc_id"
_label = lambda x: "case upper(" + x + ") " + " ".join(f"when '{k}' then '{v}'" for k, v in fv.MODULE_LABELS.items()) + f" else upper({x}) end"
ORACLES["card_payload"] = f"""with {PICKED},
p as (select doc_id, count(*) as n, coalesce(max(titulo) filter (pick = 1), '') as t1, coalesce(max(texto) filter (pick = 1), '') as x1, coalesce(max(titulo) filter (pick = 2), '') as t2,
  coalesce(max(texto) filter (pick = 2), '') as x2 from two group by doc_id)
select doc_id, lpad((doc_id % 6 + 1)::varchar, 2, '0') as numero, categoria, rama, case when importa <> '' then importa else angulo end as subheadline, source as "imagenFuente",
  n::bigint as "moduleCount", {_label('t1')} as "module1Title", x1 as "module1Text", {_label('t2')} as "module2Title", x2 as "module2Text", '' as "module3Title",
  case when length(titulo) <= 34 then 'title-short' when length(titulo) <= 52 then 'title-medium' when length(titulo) <= 70 then 'title-long' else 'title-xlong' end as "titleSize",
  case when length(trim(x1)) <= 14 then 'module-xl' when length(trim(x1)) <= 30 then 'module-lg' when length(trim(x1)) <= 58 then 'module-md' else 'module-sm' end as "module1Size",
  length(x1) + length(x2) >= 300 as compact from story join p using (doc_id)"""
ORACLES["length_buckets"] = f"""with {FEED}
select seq, case when length(title) <= 34 then 'title-short' when length(title) <= 52 then 'title-medium' when length(title) <= 70 then 'title-long' else 'title-xlong' end as title_size,
  case when length(title) <= 14 then 'module-xl' when length(title) <= 30 then 'module-lg' when length(title) <= 58 then 'module-md' else 'module-sm' end as module_size,
  {cut("regexp_replace(title, '\\s+', ' ', 'g')", 40)} as cut,
  case when length(regexp_replace(title, '\\s+', ' ', 'g')) <= 40 then regexp_replace(title, '\\s+', ' ', 'g') else
    rtrim(regexp_replace(substring(regexp_replace(title, '\\s+', ' ', 'g'), 1, 40), ' [^ ]*$', ''), ' ,.;:') || '.' end as short,
  array_to_string(string_split(regexp_replace(title, '\\s+', ' ', 'g'), ' ')[1:3], ' ') as lead,
  regexp_replace(title, '(' || regexp_escape(string_split(regexp_replace(title, '\\s+', ' ', 'g'), ' ')[1]) || ')', '<b>\\1</b>', 'gi') as marked from feed"""
ORACLES["final_records"] = f"""with {CHOSEN}
select c.batch, lpad((row_number() over (partition by c.batch order by c.candidate_id))::varchar, 2, '0') as numero, c.candidate_id,
  case c.editorial_branch when 'gaming' then 'GAMING' when 'tecnologia' then 'TECNOLOGÍA' else 'CULTURA POP' end as categoria, c.editorial_branch as rama,
  '30 ENE 2024' as fecha, a.source as fuente, 'doc:' || c.candidate_id as url, {stamp('a.published')} as fecha_original
from chosen c join articles a on a.doc_id = c.candidate_id"""


# --- streams -------------------------------------------------------------------------------------

ORACLES["stream_dedupe"] = f"""with {PAGE_ARTICLES}
select distinct case when doc_id % 3 = 0 or canonical = '' then 'title:' || lower(title) || '|source:' || lower(source) else 'url:' || canonical end as key from articles"""
ORACLES["stream_spend"] = """with c as (select date_trunc('day', ts) as d, case when user_id % 2 = 0 then 'gpt-5.6-terra' else 'gpt-5.6-luna' end as model,
  (floor(value * 40) * 2.0::double + floor(value * 8) * 12.0::double) / 1e6 * case when user_id % 2 = 0 then 1 else 0.1::double end as cost from events),
s as (select d, model, count(*) as calls, sum(cost) as spent from c group by all)
select strftime(d, '%Y-%m-%d %H:%M:%S') as start, model, calls, round(spent, 6) as spent_usd,
  case when spent >= 3.5 then 'STOP' when spent >= 2.5 then 'CRITICO' when spent >= 0.5 then 'ADVERTENCIA' else 'NORMAL' end as level from s"""
ORACLES["stream_register"] = f"""with {HISTORY},
kept as (select date, branch, title, source, url, story_key from hist where date::timestamp >= timestamp '2024-01-31' - interval 30 day),
news as (select doc_id, branch, title, source, case when doc_id % 3 = 0 then '' else regexp_extract(link, '^([^?#]*)', 1) end as url,
  substring(trim(regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '-', 'g'), '-'), 1, 140) as story_key from articles where title <> ''),
urlrows as (select * from news n where url <> '' and not exists (select 1 from kept k where k.date = '2024-01-31' and k.url = n.url)
  qualify row_number() over (partition by url order by doc_id) = 1),
keyrows as (select * from news n where url = '' and not exists (select 1 from kept k where k.date = '2024-01-31' and {whole('k')} = {whole('n')})
  and not exists (select 1 from urlrows u where {whole('u')} = {whole('n')} and u.doc_id < n.doc_id)
  qualify row_number() over (partition by {whole('n')} order by doc_id) = 1)
select * from kept
union all select '2024-01-31', branch, title, source, url, story_key from urlrows
union all select '2024-01-31', branch, title, source, url, story_key from keyrows"""


# --- near duplicates and history: all pairs, brute force -------------------------------------------

# longest common subsequence of x and y by the textbook table, row by row
LCS = """list_reduce(list_transform(string_split(x, ''), lambda ch: list_transform(string_split(y, ''), lambda c: (c = ch)::int)),
  lambda r, mv: list_reduce(list_transform(range(1, length(y) + 1), lambda j: [mv[j], r[j], r[j + 1]]),
    lambda acc, el: list_append(acc, case when el[1] = 1 then el[2] + 1 else greatest(acc[len(acc)], el[3]) end), [0]),
  list_transform(range(0, length(y) + 1), lambda z: 0))[length(y) + 1]"""


def ratio_ctes(source: str, a: str, b: str, limit: str, least: str = "lim", p: str = "", more: str = "true") -> str:
    """CTE `<p>rated`: source plus `ratio`, exact wherever it can reach `least`.

    A pair is only worked out letter by letter when lengths and letter counts leave it open.
    """
    below = "closed < lim" if least == "lim" else "closed < 100"
    return f"""{p}cut as materialized (select *, array_to_string(list_filter({a}, lambda w: list_contains({b}, w)), ' ') as s,
  array_to_string(list_filter({a}, lambda w: not list_contains({b}, w)), ' ') as x,
  array_to_string(list_filter({b}, lambda w: not list_contains({a}, w)), ' ') as y from {source}),
{p}sized as (select *, length(s) as ls, length(s) + (s <> '')::int + length(x) as la, length(s) + (s <> '')::int + length(y) as lb from {p}cut),
{p}closed as (select *, case when la = 0 or lb = 0 then 0.0 when ls > 0 and (x = '' or y = '') then 100.0
  when ls > 0 then greatest(100 - 100.0 * (la - ls) / (ls + la), 100 - 100.0 * (lb - ls) / (ls + lb)) else 0.0 end::double as closed, {limit} as lim from {p}sized),
{p}ask as materialized (select *, {below} and x <> '' and y <> '' and 100 - 100.0 * abs(la - lb) / (la + lb) >= {least} and {more} and
  100 - 100.0 * (length(x) + length(y) - 2 * list_sum(list_transform(list_distinct(string_split(x, '')), lambda c:
    least(length(x) - length(replace(x, c, '')), length(y) - length(replace(y, c, '')))))) / (la + lb) >= {least} as ask from {p}closed),
{p}rated as materialized (select *, case when ask then greatest(closed, 100 - 100.0 * (length(x) + length(y) - 2 * {LCS}) / (la + lb)) else closed end as ratio from {p}ask)"""


# numbered letter pairs of the padded words: two texts whose ratio reaches lim share (lim-based) many of them
PAIRS = """list_transform(flatten(list_transform(w, lambda t: list_transform(range(1, length(t) + 2), lambda i: substring(' ' || t || ' ', i, 2)))), lambda g: g)"""
NUMBERED = "list_transform(g, lambda t, i: t || len(list_filter(g[1:i], lambda u: u = t)))"


def _near(titles: str, group: str, rank: str) -> str:
    stop, noise = words(fv.RANK_STOPWORDS), words(fv.RANK_STOPWORDS + fv.RANK_EVENT_NOISE)
    return f"""norms as (select *, {normal('title')} as norm from {titles}),
sets as (select {group} as grp, {rank} as rk, list_sort(list_distinct({split('norm')})) as w, {families("' ' || norm || ' '", sd.EVENT_FAMILIES)} as f from norms where norm <> ''),
dist0 as (select grp, w, f, min(rk) as rk, {PAIRS} as g, list_filter(w, lambda x: length(x) >= 3 and not list_contains({stop}, x)) as m,
  list_filter(w, lambda x: length(x) >= 3 and not list_contains({noise}, x)) as e from sets group by grp, w, f),
dist as (select *, {NUMBERED} as ng from dist0),
allpairs as (select a.grp, a.rk as ra, b.rk as rb, a.w as wa, b.w as wb, len(list_intersect(a.ng, b.ng)) as cg, len(a.m) > 0 and len(b.m) > 0 as both_m, len(list_intersect(a.m, b.m)) as cm, least(len(a.m), len(b.m)) as sm,
  len(list_intersect(a.e, b.e)) as ce, list_has_any(a.f, b.f) as ff, len(a.f) > 0 and len(b.f) > 0 as fam from dist a join dist b on a.grp = b.grp and a.rk < b.rk),
{ratio_ctes('allpairs', 'wa', 'wb', "case when both_m and cm >= 4 then 72 else 84 end", more="cg >= (0.5 - 1.5 * (1 - lim / 100.0)) * (la + lb) + 1")},
dup as materialized (select grp, ra, rb from rated where ratio >= lim or (both_m and ((cm >= 4 and cm >= 0.55 * sm) or (ff and ce >= 2) or (ce >= 3 and fam))))"""


ORACLES["near_dup_pairs"] = f"""with {PAGE_ARTICLES}, {_near('articles', 'branch', 'doc_id')}
select ra as better_doc, rb as worse_doc from dup"""
_GREEDY = """members as (select s.*, d.rk as best from sets s join dist d on d.grp = s.grp and d.w = s.w and d.f = s.f),
tags as (select rk, row_number() over (order by rk) as n from dist),
worse as (select t.n, list(u.n) as better from dup join tags t on t.rk = dup.rb join tags u on u.rk = dup.ra group by t.n),
walk as (select 0::bigint as n, []::bigint[] as gone union all
  select walk.n + 1, case when w.n is not null and len(list_filter(w.better, lambda b: not list_contains(walk.gone, b))) > 0 then list_append(walk.gone, walk.n + 1) else walk.gone end
  from walk left join worse w on w.n = walk.n + 1 where walk.n < (select count(*) from tags)),
final as (select unnest(gone) as n from (select gone from walk order by n desc limit 1)),
kept as (select rk from tags where n not in (select n from final))"""
_GREEDY_RANKED = f"""{PAGE_ARTICLES}, base as (select seq, title, source, published, [branch] as cats from ROWS),
{score_cte(sd.fixture_rules(), 'base', 'seq, title, source, cats')},
assigned as (select seq as doc_id, branch, title, source, score, row_number() over (order by score desc, seq) as rk from scored where list_contains(cats, branch)),
{_near('assigned', 'branch', 'rk')}, {_GREEDY}"""
ORACLES["greedy_dedupe"] = f"""with recursive {_GREEDY_RANKED.replace('ROWS', 'articles')}
select doc_id, branch as editorial_branch, score as editorial_score, norm = '' or rk in (select rk from kept) as accepted from norms"""
ORACLES["duplicate_counts"] = f"""select editorial_branch, count(*) filter (where accepted) as kept, count(*) filter (where not accepted) as removed, count(*) as total
from ({ORACLES["greedy_dedupe"]}) group by editorial_branch"""

_EVENTS = f"list_sort(list_distinct(list_filter(list_transform(p, lambda x: {event_case('x', sd.EVENT_CLASSES)}), lambda e: e is not null)))"


def judge(material) -> str:
    """CTEs up to `verdict`: the open stories with status, reason and the matched history row."""
    return f"""told as (select 'c' as side, doc_id as id, null::bigint as age, title from open union all
  select 'h', hist_seq, floor(epoch(timestamp '2024-01-31' - date::timestamp) / 86400)::bigint, title from hist where date::timestamp >= timestamp '2024-01-31' - interval 10 day),
toks as (select *, list_sort(list_distinct({split(plain('title'))})) as p from told),
feat as (select *, {SUBJECT} as sub, {_EVENTS} as ev, list_sort(list_distinct(list_transform(p, lambda x: coalesce({event_case('x', sd.EVENT_CLASSES)}, x)))) as nm from toks),
pr as (select c.id as cid, h.id as hid, h.age, len(list_intersect(c.sub, h.sub)) as sh, least(len(c.sub), len(h.sub)) as sm, list_sort(list_intersect(c.sub, h.sub)) as shared,
  len(list_filter(list_intersect(c.sub, h.sub), lambda w: length(w) >= 5)) as st, list_has_any(c.ev, h.ev) as bo, c.nm as wa, h.nm as wb,
  list_sort(list_intersect(list_filter(c.ev, lambda e: not list_contains(h.ev, e)), {words(material)})) as newev
  from feat c join feat h on c.side = 'c' and h.side = 'h' and list_has_any(c.sub, h.sub)),
likely as (select * from pr where (bo and st >= 1) or (st >= 3 and sh >= 0.6 * sm)),
{ratio_ctes('likely', 'wa', 'wb', 'null', 'closed', 'h_')},
same as (select * from h_rated where case when age <= 3 then (bo and ((st >= 1 and ratio >= 84) or st >= 2)) or (st >= 3 and sh >= 0.6 * sm)
  else bo and ((st >= 1 and ratio >= 92) or (st >= 2 and sh >= 0.55 * sm and ratio >= 78)) end),
judged as (select cid, min(hid) filter (len(newev) = 0) as hit, arg_min(ratio, hid) filter (len(newev) = 0) as r, arg_min(shared, hid) filter (len(newev) = 0) as w,
  max(hid) filter (len(newev) > 0) as dev, arg_max(newev, hid) filter (len(newev) > 0) as de from same group by cid),
by_url as (select o.doc_id as cid, min(h.hist_seq) as url_hit from open o join hist h on o.canonical = h.canonical and h.canonical <> '' and o.title <> '' and h.title <> ''
  where h.date::timestamp >= timestamp '2024-01-31' - interval 10 day group by o.doc_id),
verdict as (select o.*, case when least(hit, url_hit) is not null then 'blocked' when dev is not null then 'development' else 'kept' end as status,
  case when url_hit = least(hit, url_hit) then 'misma URL' when hit is not null then 'misma historia | sim=' || round_even(r, 0)::int || ' | shared=' || len(w) || case when len(w) > 0 then ' | anchors=' || array_to_string(w[1:8], ', ') else '' end
    when dev is not null then 'nuevo desarrollo fuerte: ' || array_to_string(de, ', ') end as reason, coalesce(least(hit, url_hit), dev) as hist_seq
  from open o left join judged j on j.cid = o.doc_id left join by_url u on u.cid = o.doc_id)"""


_JUDGED_HISTORY = f"{HISTORY}, {judge(['delay', 'cancel', 'sales', 'beta', 'announce', 'release'])}"
_FULL = _GREEDY_RANKED.replace(f"{PAGE_ARTICLES}, ", "").replace("ROWS", "clean")
ORACLES["shortlist_deduped"] = f"""with recursive {_JUDGED_HISTORY}, clean as (select * exclude (status, reason, hist_seq) from verdict where status <> 'blocked'),
{_FULL}, left_over as (select doc_id, doc_id as seq, branch, title, source, score from norms where norm = '' or rk in (select rk from kept)),
{TOPK.format(src='left_over', norm=normal('source'))}
select shortlist_id, branch_rank, score as editorial_score, doc_id, branch as editorial_branch, title from short"""
ORACLES["history_block"] = f"with {_JUDGED_HISTORY} select doc_id, status, reason, hist_seq from verdict"
ORACLES["history_developments"] = f"with {_JUDGED_HISTORY} select doc_id, reason, hist_seq from verdict where status = 'development'"
ORACLES["history_split"] = f"""with {_JUDGED_HISTORY} select v.doc_id, reason, h.date, h.title as published_title
from verdict v join hist h using (hist_seq) where status = 'blocked'"""


# --- batches: pairs by brute force, the walk slot by slot ------------------------------------------

def _same_batch(src: str) -> str:
    """CTE `conflicts` (n, o): story n repeats story o of its batch, by title or by URL; src: batch, doc_id, title, canonical."""
    return f"""b_toks as (select batch, doc_id as id, list_sort(list_distinct({split(plain('title'))})) as p from {src} where title <> ''),
b_feat as (select *, {SUBJECT} as sub, {_EVENTS} as ev, list_sort(list_distinct(list_transform(p, lambda x: coalesce({event_case('x', sd.EVENT_CLASSES)}, x)))) as nm from b_toks),
b_pr as (select n.id as n, o.id as o, len(list_intersect(n.sub, o.sub)) as sh, least(len(n.sub), len(o.sub)) as sm, len(list_filter(list_intersect(n.sub, o.sub), lambda w: length(w) >= 5)) as st,
  list_has_any(n.ev, o.ev) as bo, n.nm as wa, o.nm as wb, len(list_intersect(list_filter(n.ev, lambda e: not list_contains(o.ev, e)), {words(fv.MATERIAL_EVENTS)})) as newev
  from b_feat n join b_feat o on n.batch = o.batch and n.id <> o.id and list_has_any(n.sub, o.sub)),
{ratio_ctes('b_pr', 'wa', 'wb', 'null', 'closed', 'b_')},
conflicts as (select n, o from b_rated where newev = 0 and ((bo and ((st >= 1 and ratio >= 84) or st >= 2)) or (st >= 3 and sh >= 0.6 * sm))
  union select n.doc_id, o.doc_id from {src} n join {src} o on n.batch = o.batch and n.doc_id <> o.doc_id and n.canonical = o.canonical and n.canonical <> '' and n.title <> '' and o.title <> '')"""


ORACLES["batch_pair_check"] = f"""with {PAGE_ARTICLES}, b as (select doc_id // 24 as batch, * from articles), {_same_batch('b')}
select b.batch, n as earlier, o as later from conflicts join b on b.doc_id = n where n < o"""


def _walk(healthy: str) -> str:
    return f"""with recursive {HISTORY}, {judge(fv.MATERIAL_EVENTS)},
b as (select v.doc_id // 24 as batch, v.*, regexp_matches(v.source, '^(m|blog)\\.') as reserve, v.status = 'blocked' as blocked, {healthy} as healthy from verdict v),
{_same_batch('b')},
os as (select b.*, (select coalesce(list(o), []) from conflicts where n = b.doc_id) as os from b),
mains as (select *, row_number() over (partition by batch order by doc_id) as slot, bool_or(not healthy) over (partition by batch) as recovering from os where not reserve),
spares as (select batch, branch, list({{'id': doc_id, 'os': os}} order by doc_id) as items from os where reserve and not blocked group by all),
walk as (select batch, 0::bigint as slot, case when bool_or(recovering) then coalesce(list(doc_id) filter (healthy), []) else []::bigint[] end as accepted, []::bigint[] as used,
    null::bigint as seq, null::varchar as status from mains group by batch
  union all
  select batch, slot, case when keep and recovering then accepted when keep then list_append(accepted, doc_id) when pick is not null then list_append(accepted, pick) else accepted end,
    case when keep or pick is null then used else list_append(used, pick) end, case when keep or pick is null then doc_id else pick end,
    case when keep then 'kept' when pick is not null then 'replaced' else 'no_reserve' end
  from (select w.batch, m.slot, w.accepted, w.used, m.doc_id, m.recovering, case when m.recovering then m.healthy else not m.blocked and not list_has_any(m.os, w.accepted) end as keep,
      list_filter(s.items, lambda x: not list_contains(w.used, x.id) and not list_has_any(x.os, w.accepted))[1].id as pick
    from walk w join mains m on m.batch = w.batch and m.slot = w.slot + 1 left join spares s on s.batch = m.batch and s.branch = m.branch))
select batch, slot, seq, status from walk where slot > 0"""


ORACLES["batch_substitute"] = _walk("true")
ORACLES["asset_recover"] = _walk(
    "coalesce((select floor(p_retailprice * 21) >= 20000 and 300 + 40 * p_size >= 600 and 170 + 22 * p_size >= 338 from part where p_partkey = v.doc_id), false)")


# --- landed files and outputs ----------------------------------------------------------------------

ORACLES["landed_list"] = """select doc_id, case when doc_id % 50 = 7 then null else n_chars end as n_chars, source, md5(text) as text_md5, 'read' as state from documents where doc_id % 50 <> 9
union all select doc_id, null, null, null, 'rejected' from documents where doc_id % 50 in (7, 9)"""
ORACLES["landed_rss"] = f"""with {PAGE_ARTICLES}
select link, replace(title, '&amp;', '&') || ' - ' || upper(source) as title, source, {stamp('published')} as published from articles where false
union all select link, replace(title, '&amp;', '&') as title, source, {stamp('published')} as published from articles
where published is null or published >= timestamp '2024-01-31' - interval {fv.PRIMARY_WINDOW_DAYS * 24 + fv.WINDOW_GRACE_HOURS} hour"""
ORACLES["image_headers"] = """with f as (select s_suppkey::bigint as key, 300 + s_suppkey * 37 % 1700 as w, 200 + s_suppkey * 53 % 900 as h, s_suppkey % 2 = 1 as jpeg, s_suppkey % 60000 as pad from supplier),
g as (select *, not jpeg or key % 5 <> 0 as sized, 10 * key % 50000 + case when not jpeg then 24 when key % 5 = 0 then 24 + pad + 4 else 24 + pad + 2 * (key % 3) + 9 end as n from f)
select key, n as n_bytes, case when jpeg then 'JPEG' else 'PNG' end as format, case when sized then w end as width, case when sized then h end as height,
  case when n < 20000 then 'archivo demasiado pequeño: ' || n || ' bytes' when not sized then 'imagen inválida' when w < 600 or h < 338 then 'dimensiones insuficientes: ' || w || 'x' || h else 'ok' end as verdict from g"""
ORACLES["stage_versions"] = """select doc_id, source, n_chars, 'newest' as version from documents where n_chars > 500
union all select doc_id, source, n_chars, 'monday' from documents"""
ORACLES["canonical_records"] = """select doc_id, md5(case when doc_id % 2 = 0 then trim('Re: ' || text, E' \\t\\n\\r') when doc_id % 3 = 0 then '' else trim(text, E' \\t\\n\\r') end) as headline, source as origin, '' as address from documents"""
ORACLES["cover_dates"] = """select doc_id // 6 as batch, arg_min(case when doc_id % 4 = 0 then '30 ENE 2024' else (doc_id % 28 + 1) || ' ENE 2024' end, doc_id) as cover from documents group by 1"""
