"""Reading landed HTML with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressroom.functions import text as tx

# fixed values: the entities that occur in text
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def unescape(col: Column) -> Column:
    for entity, char in ENTITIES:
        col = F.replace(col, F.lit(entity), F.lit(char))
    return col


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>", " ")


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags become blanks, entities are read, white space is collapsed."""
    return tx.collapse(unescape(F.regexp_replace(html, r"(?s)<[^>]*>", " ")))


def attributes(tag: Column) -> Column:
    """Struct of the names (lower case) and raw values of a tag's attributes, read in one pass."""
    found = F.regexp_extract_all(tag, F.lit(r"""(?is)[\s"']([a-z_:][-a-z0-9_:.]*\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))"""), 1)
    return F.struct(
        F.transform(found, lambda a: F.lower(F.trim(F.substring_index(a, "=", 1)))).alias("names"),
        F.transform(found, lambda a: F.regexp_extract(a, r"""(?s)=\s*["']?(.*?)["']?$""", 1)).alias("values"),
    )


def value_of(read: Column, name: str) -> Column:
    """Value of an attribute among those read; '' when there is none. The first of several counts."""
    return unescape(F.coalesce(F.get(read["values"], (F.array_position(read["names"], name) - 1).cast("int")), F.lit("")))


def attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of a tag; '' when it has none."""
    return value_of(attributes(tag), name)


def meta_tags(html: Column, key: str, value: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)(<meta\b[^>]*\b{key}\s*=\s*[\"']{value}[\"'][^>]*>)"), 1)


def meta(html: Column, key: str, value: str) -> Column:
    """Content of the first such meta tag, collapsed."""
    return tx.collapse(attribute(F.coalesce(F.get(meta_tags(html, key, value), F.lit(0)), F.lit("")), "content"))


def whole_element(html: Column, tag: str) -> Column:
    """Content of the first such element up to its own end tag, elements of the same name inside included; '' if there is none.

    The text after the start tag is cut at the end tags; the element ends where as many have ended as have begun. Without such an end
    it takes the rest of the page.
    """
    rest = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*)$", 1)
    pieces = F.split(rest, rf"(?i)</{tag}\s*>")
    walk = F.aggregate(
        pieces, F.struct(F.lit(1).alias("open"), F.lit(0).alias("taken")),
        lambda a, piece: F.struct(
            F.when(a["open"] > 0, a["open"] + F.regexp_count(piece, F.lit(rf"(?i)<{tag}\b")) - 1).otherwise(0).alias("open"),
            F.when(a["open"] > 0, a["taken"] + 1).otherwise(a["taken"]).alias("taken"),
        ),
    )
    return F.array_join(F.slice(pieces, 1, walk["taken"]), f"</{tag}>")


def section(html: Column) -> Column:
    """The first article, else the first main part, else the whole page."""
    return F.coalesce(F.nullif(whole_element(html, "article"), F.lit("")), F.nullif(whole_element(html, "main"), F.lit("")), html)


def paragraphs(html: Column, first: int | None = None) -> Column:
    """Texts of the paragraphs of a fragment; only the first `first` if a number is given."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), 1)
    return F.transform(found if first is None else F.slice(found, 1, first), plain_text)


def keep_first(texts: Column, by=lambda t: t) -> Column:
    """Distinct texts in order; `by` gives what is compared."""
    keys = F.transform(texts, by)
    return F.filter(texts, lambda t, i: F.array_position(keys, by(t)) == (i + 1).cast("bigint"))
