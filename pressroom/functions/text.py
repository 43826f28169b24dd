"""Text functions as Column expressions: normalisation, tokens, trimming."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

from pressroom import fixed_values as fv


WHITE_SPACE = "".join(chr(p) for p in range(0x3001) if chr(p).isspace())


def strip(col: Column) -> Column:
    """White space of any Unicode kind removed at both ends."""
    return F.trim(col, F.lit(WHITE_SPACE))


def blank_if_null(col: Column) -> Column:
    """Missing text is the empty string, trimmed."""
    return F.coalesce(strip(col), F.lit(""))


def first_text(*cols: Column) -> Column:
    """The first non-empty of several alias columns, trimmed; '' if all are empty."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cols], F.lit(""))


def collapse(col: Column) -> Column:
    """White space (any Unicode kind) collapsed to single blanks, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"(?U)\s+", " "))


def word_normal(col: Column) -> Column:
    """Lower case; everything but letters, digits and _ becomes one blank. Accents stay."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{N}_]+", " "))


def once(value: Column, use) -> Column:
    """use(value), with the value worked out once however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


@lru_cache(maxsize=None)
def _folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition tables, derived from the Unicode database.

    Returns (from, to) for translate(): characters that fold to one ASCII letter or digit, followed
    by the combining marks, which have no counterpart and so are deleted; and a dict of the
    characters that fold to several.
    """
    one_from, one_to, several, marks = [], [], {}, []
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF:
            continue
        ch = chr(point)
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if plain == ch or not any(c.isascii() and c.isalnum() for c in plain):
            continue
        if len(plain) == 1:
            one_from.append(ch)
            one_to.append(plain)
        else:
            several[ch] = plain
    return "".join(one_from + marks), "".join(one_to), several


def fold_accents(col: Column) -> Column:
    """Compatibility-decompose and drop combining marks, as far as ASCII letters and digits go.

    Spark has no such function. Plain ASCII text, the common case, is passed through; other text
    takes one hash-based translate() pass, and only text with ligatures and the like a slower one.
    """
    chars, plain, several = _folding()
    pairs = "\x01".join(f"{c}\x02{text}" for c, text in several.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))

    def widened(folded: Column) -> Column:
        wide = F.array_join(F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
        # none of the letters up to U+00FF folds to several characters
        return (
            F.when(~folded.rlike(r"[^\x00-\x7f\u00c0-\u00ff]"), folded)
            .when(F.translate(folded, "".join(several), "") != folded, wide)
            .otherwise(folded)
        )

    return F.when(~col.rlike(r"[^\x00-\x7f]"), col).otherwise(once(F.translate(col, chars, plain), widened))


def fold_lower(col: Column) -> Column:
    """Accents folded, lower case, trimmed; punctuation kept."""
    return strip(F.lower(fold_accents(F.coalesce(col, F.lit("")))))


def ascii_words(col: Column) -> Column:
    """Accents folded; links dropped; everything but a-z and 0-9 becomes one blank."""
    folded = fold_accents(F.lower(F.coalesce(col, F.lit(""))))
    unlinked = F.regexp_replace(folded, r"https?://\S+", " ")
    return F.trim(F.regexp_replace(unlinked, "[^a-z0-9]+", " "))


def slug(col: Column, limit: int | None = 140) -> Column:
    """ASCII words joined by '-', cut at `limit` characters unless that is None (links are kept as words)."""
    folded = fold_accents(F.lower(F.coalesce(col, F.lit(""))))
    whole = F.trim(F.regexp_replace(folded, "[^a-z0-9]+", "-"), F.lit("-"))
    return whole if limit is None else F.substring(whole, 1, limit)


def file_slug(col: Column) -> Column:
    """Lower-case words joined by '_', accents kept; 'noticia' when nothing is left."""
    kept = F.regexp_replace(F.lower(strip(F.coalesce(col, F.lit("")))), r"(?U)[^\p{L}\p{N}_\s-]", "")
    joined = F.trim(F.regexp_replace(kept, r"(?U)[\s_-]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("noticia"))


def words(normal: Column) -> Column:
    """The words of a normalised text; an empty array for an empty text."""
    # no lambda, which would leave the whole normalisation below it to interpreted evaluation
    return F.array_remove(F.split(normal, " "), F.lit(""))


def word_set(normal: Column) -> Column:
    return F.array_distinct(words(normal))


def lit_array(values) -> Column:
    """A constant array of texts; one literal split once at planning time, however long the list."""
    values = list(values)
    return F.split(F.lit("\n".join(values)), "\n") if values else F.array().cast("array<string>")


def alnum_tokens(col: Column) -> Column:
    """All runs of a-z0-9 in folded, lower-case text, in order."""
    return F.regexp_extract_all(fold_lower(col), F.lit("([a-z0-9]+)"), 1)


def meaningful(tokens: Column, stopwords=None, min_length: int = 3) -> Column:
    """Words of at least `min_length` characters that are no stop words."""
    drop = fv.RANK_STOPWORDS if stopwords is None else stopwords
    kept = F.filter(tokens, lambda w: F.length(w) >= min_length)
    return F.array_except(kept, lit_array(drop))


def entity_words(tokens: Column, noise=None) -> Column:
    """Meaningful words that do not just name an event."""
    drop = fv.RANK_STOPWORDS + fv.RANK_EVENT_NOISE if noise is None else noise
    return meaningful(tokens, drop)


def cut_at_word(col: Column, limit: int, ending: str = "…", strip: str = " ") -> Column:
    """Collapsed text of at most `limit` characters, cut back to a word boundary, plus `ending`."""
    text = collapse(col)
    head = F.regexp_replace(F.substring(text, 1, limit), r" [^ ]*$", "")
    kept = F.trim(head) if strip == " " else F.rtrim(head, F.lit(strip))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(kept, F.lit(ending)))


def shorten(col: Column, limit: int = 92) -> Column:
    return cut_at_word(col, limit, ending=".", strip=" ,.;:")


def first_words(col: Column, count: int) -> Column:
    return F.array_join(F.slice(words(collapse(col)), 1, count), " ")


def highlight(text: Column, fragment: Column, before: str, after: str) -> Column:
    """Every occurrence of `fragment` in `text`, whatever its case, wrapped; literal match."""
    quoted = F.regexp_replace(fragment, r"([\\.*+?^${}()|\[\]])", r"\\$1")
    wrapped = F.regexp_replace(text, F.concat(F.lit("(?iu)"), quoted), F.lit(f"{before}$0{after}"))
    return F.when(F.coalesce(fragment, F.lit("")) == "", text).otherwise(wrapped)


def size_bucket(length: Column, steps: list[tuple[int, str]], last: str) -> Column:
    """The label of the first step whose limit is not exceeded."""
    out = None
    for limit, label in steps:
        cond = length <= limit
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(last)


def token_estimate(col: Column) -> Column:
    """Estimated tokens of a prompt: length / 3.2, rounded down, plus 400."""
    return F.greatest(F.floor(F.length(F.coalesce(col, F.lit(""))) / 3.2) + 400, F.lit(1)).cast("long")


def strip_source(title: Column, source: Column, dashes=(" - ",)) -> Column:
    """The title without its trailing ' - source', whatever the case."""
    title, source = blank_if_null(title), blank_if_null(source)
    out = title
    for dash in reversed(dashes):
        tail = F.concat(F.lit(dash), source)
        hit = (source != "") & F.lower(title).endswith(F.lower(tail))
        out = F.when(
            hit, strip(F.substring(title, F.lit(1), F.greatest(F.length(title) - F.length(tail), F.lit(0))))
        ).otherwise(out)
    return out


def source_of(feed_source: Column, raw_title: Column) -> Column:
    """The feed's source name, else the text after the last ' - ' of the title, else a fixed label."""
    title = blank_if_null(raw_title)
    feed = F.nullif(strip(feed_source), F.lit(""))
    tail = F.when(title.contains(" - "), strip(F.element_at(F.split(title, " - ", -1), -1)))
    return F.coalesce(feed, tail, F.lit(fv.NO_SOURCE))


def merge_key(link: Column, title: Column, source: Column) -> Column:
    """'url:' + link, or the lower-case title and source where there is no link."""
    link = blank_if_null(link)
    by_title = F.concat(
        F.lit("title:"), F.lower(blank_if_null(title)),
        F.lit("|source:"), F.lower(blank_if_null(source)),
    )
    return F.when(link != "", F.concat(F.lit("url:"), link)).otherwise(by_title)
