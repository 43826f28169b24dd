"""Main text of pages, with site templates removed by counting element subtrees.

Every page is read into a small element tree. Elements that say what they are (menus, footers, forms, scripts, adverts,
comments and so on, by tag, role or class) go, and the articles are taken as the main part where the page has any. Inside the main part
every element's subtree (tags, classes and text) has a hash; Spark counts the articles of each host that hold it, and subtrees in
many of them, at least MANY and SHARE of a host's, are site templates and are deleted on all pages.

Pages of a host whose longest block of text is the same are one article and count once, so neither an article under many URLs nor its
edited copies make a template of its text.
Counts combine before the shuffle, so a host with a third of all pages is no hot task. Pages are read twice; between the readings only hashes
move. Up to MOST_BROADCAST template hashes are broadcast to the second reading; if there are more, each page is joined with those found on it.
"""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.words import numbered
from pressroom.session import materialize

MANY = 10
SHARE = 0.5
CLEARLY = 2
MOST = 0.8
MOST_BROADCAST = 500_000

# HTML elements without content, those that end an open paragraph, and what closes what.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
SCOPE = frozenset("ul ol dl table menu article section div body html td th".split())
LISTS = frozenset("ul ol dl table menu select".split())

# Elements, roles and class words that are not part of an article.
JUNK_TAGS = frozenset(
    "script style noscript template nav footer aside button select textarea iframe object svg canvas dialog menu head title "
    "datalist audio video map label".split()
)
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
JUNK_WORDS = frozenset(
    "ad ads adbox adslot advert advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices paywall popup promo promotion "
    "related replies respond share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)
JUNK_NAMES = frozenset("header site-header page-header top-header siteheader pageheader topbar top-bar".split())
MAIN_WORDS = frozenset("article-body article-content entry-content post-content post-body main-content story-body content".split())
# First words of class names that state a layout, a state or a topic of an element, not what it is.
LAYOUT_WORDS = frozenset("no not has have with without is hide hidden show enable enabled disable disabled single category tag topic section type format status lang".split())
PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


class Element:
    """size: characters of text outside JUNK_TAGS; kept: it holds the page's main text, whatever its names."""

    __slots__ = ("tag", "attrs", "parts", "size", "kept")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts, self.size, self.kept = tag, attrs, [], 0, False


class TreeReader(HTMLParser):
    """Elements and texts of a page; unclosed elements end where HTML lets them end.

    The places of open elements are kept by tag, so that no tag walks over all open ones.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags; 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close_from(self, place: int) -> None:
        for e in self.open[place:]:
            self.places[e.tag].pop()
            if e.tag in BLOCK:
                self.blocks.pop()
        del self.open[place:]

    def close_to(self, tags: tuple[str, ...], scope: frozenset[str]) -> None:
        place = self.last(tags)
        if place and place >= self.last(scope):
            self.close_from(place)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.close_to(("p",), SCOPE)
        if tag in CLOSES:
            self.close_to(CLOSES[tag], LISTS)
        made = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].parts.append(made)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            if tag in BLOCK:
                self.blocks.append(len(self.open))
            self.open.append(made)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "span", "script"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        place = self.last((tag,))
        if place and (tag in BLOCK or not self.blocks or self.blocks[-1] <= place):
            self.close_from(place)

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def read_tree(html: str) -> Element:
    reader = TreeReader()
    reader.feed(html)
    reader.close()
    mark_kept(reader.root)
    return reader.root


def is_core(e: Element) -> bool:
    return e.tag in ("article", "main") or e.attrs.get("role") == "main" or bool(MAIN_WORDS.intersection(f"{e.attrs.get('class', '')} {e.attrs.get('id', '')}".lower().split()))


def mark_kept(root: Element) -> None:
    """Text sizes of all elements, and the elements around and at the page's largest article, main part or content container as kept.

    Elements that call themselves junk are taken for it last. On a page without such an element those with MOST of its text are kept.
    """
    stack, order, above = [(root, None, False)], [], {}
    while stack:
        e, parent, named = stack.pop()
        if e.tag in JUNK_TAGS:
            continue
        above[id(e)] = parent
        named = named or names_junk(e)
        order.append((e, parent, named))
        e.size = sum(len(x.strip()) for x in e.parts if isinstance(x, str))
        stack.extend((x, e, named) for x in e.parts if isinstance(x, Element))
    for e, parent, _ in reversed(order):
        if parent is not None:
            parent.size += e.size
    cores = [(not named, e.size, e) for e, parent, named in order if parent is not None and e.size and is_core(e)]
    if cores:
        e = max(cores, key=lambda c: c[:2])[2]
        while e is not None:
            e.kept = True
            e = above[id(e)]
    else:
        for e, _, _ in order:
            e.kept = e.size > MOST * root.size


def names_junk(e: Element) -> bool:
    """Whether the element's role, or the first or last word of one of its class names or its id, says that it is no part of an article."""
    if e.attrs.get("role", "").lower() in JUNK_ROLES or e.tag == "form":
        return True
    for name in ("class", "id"):
        for value in e.attrs.get(name, "").split():
            parts = [x.lower() for x in PARTS.findall(value)]
            if value.lower() in JUNK_NAMES or (parts and parts[0] not in LAYOUT_WORDS and (parts[0] in JUNK_WORDS or parts[-1] in JUNK_WORDS)):
                return True
    return False


def is_junk(e: Element, in_main: bool) -> bool:
    if e.kept:
        return False
    if e.tag in JUNK_TAGS or (e.tag == "header" and not in_main) or "hidden" in e.attrs:
        return True
    return e.tag not in ("html", "body", "main") and names_junk(e)


def text_size(e: Element) -> int:
    size, todo = 0, [e]
    while todo:
        own = todo.pop()
        for x in own.parts:
            if isinstance(x, str):
                size += len(x.strip())
            elif not is_junk(x, True):
                todo.append(x)
    return size


def main_part(root: Element) -> Element:
    """All articles outside junk, else all main elements, all content containers, or the whole page.

    Of elements in one another the outer one counts. A later kind with more than CLEARLY times the text of the kinds before it is taken
    instead of them: then the articles are teasers.
    """
    found: dict[str, list[Element]] = {"article": [], "main": [], "content": []}
    todo = [(root, frozenset())]
    while todo:  # elements come in page order
        e, inside = todo.pop()
        kind = None
        if e is not root:
            kind = "article" if e.tag == "article" else "main" if e.tag == "main" or e.attrs.get("role") == "main" else None
            if kind is None and MAIN_WORDS.intersection((e.attrs.get("class", "") + " " + e.attrs.get("id", "")).lower().split()):
                kind = "content"
            if kind and kind not in inside:
                found[kind].append(e)
        if kind != "article":
            within = inside | {kind} if kind else inside
            todo.extend((x, within) for x in reversed(e.parts) if isinstance(x, Element) and not is_junk(x, False))
    taken, size = root, None
    for own in found.values():
        if own:
            own_size = sum(map(text_size, own))
            if size is None or own_size > CLEARLY * size:
                taken, size = own[0] if len(own) == 1 else joined(own), own_size
    return taken


def joined(elements: list[Element]) -> Element:
    """One element that holds the given ones in page order."""
    whole = Element("main", {})
    whole.parts.extend(elements)
    return whole


def subtree_keys(main: Element, host: str) -> tuple[int, dict[int, int]]:
    """Key of the main part and of every element in it (by identity), each a hash of host, tag, class and content."""
    keys: dict[int, int] = {}
    stack = [(main, False)]
    while stack:
        e, ready = stack.pop()
        if not ready:
            stack.append((e, True))
            stack.extend((x, False) for x in e.parts if isinstance(x, Element) and not is_junk(x, True))
            continue
        inner = [" ".join(x.split()) if isinstance(x, str) else str(keys.get(id(x), "")) for x in e.parts]
        text = "\x1f".join([host, e.tag, e.attrs.get("class", ""), *(x for x in inner if x)])
        keys[id(e)] = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
    return keys[id(main)], keys


def longest_block(main: Element, keys: dict[int, int]) -> int:
    """Key of the block element with the most text of its own, inline elements included; the first of several."""
    sizes: dict[int, int] = {}
    todo = [(main, main)]
    while todo:
        e, block = todo.pop()
        block = e if e.tag in BLOCK else block
        sizes[id(block)] = sizes.get(id(block), 0) + sum(len(x.strip()) for x in e.parts if isinstance(x, str))
        todo.extend((x, block) for x in reversed(e.parts) if isinstance(x, Element) and id(x) in keys)
    return keys[max(sizes, key=sizes.get)]


def main_text(main: Element, keys: dict[int, int], templates: frozenset[int]) -> str:
    out, stack = [], [main]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is not main and (is_junk(x, main.tag != "html") or keys.get(id(x)) in templates):
            out.append(" ")
        else:
            space = " " if x.tag in BLOCK or x.tag in VOID else ""
            stack.append(space)
            stack.extend(reversed(x.parts))
            out.append(space)
    return " ".join("".join(out).split())


def host_of(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower()


def _keys(batches):
    for batch in batches:
        out = [[], [], [], []]
        for url, html in zip(batch.column("_url").to_pylist(), batch.column("_html").to_pylist(), strict=True):
            host = host_of(url)
            main = main_part(read_tree(html or ""))
            own, keys = subtree_keys(main, host)
            lead = longest_block(main, keys)
            keys.pop(id(main))
            for column, value in zip(out, (host, own, lead, list(set(keys.values()))), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), *(pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True))],
            names=["_row", "_host", "_main", "_lead", "_keys"],
        )


def _texts(known):
    """Texts of pages without their template subtrees; known: broadcast sorted template keys, or None where each page brings its own."""
    def made(batches):
        every = None if known is None else known.value
        for batch in batches:
            out = []
            own_keys = batch.column("_gone").to_pylist() if known is None else [None] * batch.num_rows
            for url, html, own in zip(batch.column("_url").to_pylist(), batch.column("_html").to_pylist(), own_keys, strict=True):
                main = main_part(read_tree(html or ""))
                gone = frozenset(own or ())
                keys = subtree_keys(main, host_of(url))[1] if gone or (every is not None and len(every)) else {}
                if every is not None and keys:
                    here = np.fromiter(set(keys.values()), np.int64)
                    at = np.minimum(np.searchsorted(every, here), len(every) - 1)
                    gone = frozenset(here[every[at] == here].tolist())
                out.append(main_text(main, keys, gone))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_id"), batch.column("_url"), pa.array(out, pa.string())], names=["_row", "_id", "url", "text"])

    return made


def site_templates(seen: DataFrame, many: int = MANY, share: float = SHARE) -> DataFrame:
    """(_key): the template keys of all hosts. seen: _row, _host, _main, _lead, _keys."""
    # keys hold the host, so equal main parts are copies on one host, with the same keys
    mains = materialize(seen.groupBy("_main").agg(F.min("_host").alias("_host"), F.first("_lead").alias("_lead"), F.first("_keys").alias("_keys")), "html-mains")
    # copies with other edits have the same longest block: together they count as one page
    each = mains.select("_host", "_lead", F.explode("_keys").alias("_key")).groupBy("_key", "_lead").agg(F.min("_host").alias("_host"))
    counts = materialize(each.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_host").alias("_host")).filter(F.col("_n") >= many), "html-counts")
    hosts = materialize(mains.groupBy("_host", "_lead").agg(F.lit(1).alias("_one")).groupBy("_host").agg(F.count(F.lit(1)).alias("_pages")), "html-hosts")
    return counts.join(hosts, "_host").filter(F.col("_n") >= share * F.col("_pages")).select("_key")


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", many: int = MANY, share: float = SHARE) -> DataFrame:
    """One row per row of pages: _row, _id, url, text (blocks in page order joined by one space, empty if none).

    Null and empty pages have an empty text; a null URL is the host ''. Repeated rows are pages of their own. Very long pages are read
    whole. An empty table gives no rows. Rows are named by words.numbered; other columns are not read.
    """
    own = numbered(pages.select(F.col(id).cast("long").alias("_id"), F.col(url).cast("string").alias("_url"), F.col(html).cast("string").alias("_html")))
    seen = materialize(own.select("_row", "_url", "_html").mapInArrow(_keys, "_row long, _host string, _main long, _lead long, _keys array<long>"), "html-keys")
    templates = materialize(site_templates(seen, many, share), "html-templates")
    result = "_row long, _id long, url string, text string"
    if templates.count() <= MOST_BROADCAST:  # 8 bytes each, so pages stay where they are
        known = pages.sparkSession.sparkContext.broadcast(np.sort(templates.toArrow().column("_key").to_numpy()))
        return own.mapInArrow(_texts(known), result)
    on_pages = seen.select("_row", F.explode("_keys").alias("_key")).join(templates, "_key")
    gone = materialize(on_pages.groupBy("_row").agg(F.collect_list("_key").alias("_gone")), "html-gone")
    return own.join(gone, "_row", "left").mapInArrow(_texts(None), result)
