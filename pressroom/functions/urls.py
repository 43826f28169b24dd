"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import text as tx

# scheme, authority, path of an absolute URL; query and fragment are left out
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def host(url: Column) -> Column:
    """Lower-case authority (with the port, if any); '' for text that is no absolute URL."""
    return F.lower(F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit("")))


def path(url: Column) -> Column:
    whole = F.regexp_extract(url, _PARTS, 3)
    relative = F.regexp_extract(url, r"^([^?#]*)", 1)
    return F.coalesce(F.when(url.rlike(_PARTS), whole).otherwise(relative), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no trailing '/', no query, no fragment."""
    url = tx.blank_if_null(url)
    bare = F.rtrim(path(url), F.lit("/"))
    absolute = F.concat(scheme(url), F.lit(":"), F.when(url.rlike(r"^[^:/?#]+://"), "//").otherwise(""), host(url), bare)
    return F.when(url == "", "").when(url.rlike(_PARTS), absolute).otherwise(bare)


def path_words(url: Column) -> Column:
    """Runs of a-z0-9 in the path, in order."""
    return tx.alnum_tokens(path(url))


def last_segment_words(url: Column) -> Column:
    return tx.alnum_tokens(F.regexp_extract(path(url), r"([^/]*)/?$", 1))


def usable_image_url(url: Column, extensions=None, fragments=None) -> Column:
    """Not empty, no data: URL, no rejected extension, no rejected path part (query ignored)."""
    extensions = fv.IMAGE_BAD_EXTENSIONS if extensions is None else extensions
    fragments = fv.IMAGE_BAD_PATHS if fragments is None else fragments
    bare = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([^?#]*)", 1))
    bad = bare.startswith("data:")
    for extension in extensions:
        bad = bad | bare.endswith(extension)
    for fragment in fragments:
        bad = bad | bare.contains(fragment)
    return (F.coalesce(url, F.lit("")) != "") & ~bad


# How links of the news aggregator are recognised
AGGREGATOR_HOST = "news.google.com"
AGGREGATOR_PATHS = ["/rss/articles/", "/read/"]


def mentions_aggregator(url: Column) -> Column:
    """The aggregator's host or link form anywhere in the text."""
    url = F.coalesce(url, F.lit(""))
    hit = url.contains(AGGREGATOR_HOST)
    for part in AGGREGATOR_PATHS:
        hit = hit | url.contains(part)
    return hit


def is_aggregator(url: Column) -> Column:
    """The aggregator's host exactly, or its link form anywhere."""
    url = F.coalesce(url, F.lit(""))
    hit = host(url) == AGGREGATOR_HOST
    for part in AGGREGATOR_PATHS:
        hit = hit | url.contains(part)
    return hit


def absolute_url(base: Column, ref: Column) -> Column:
    """`ref` resolved against `base`: absolute, //host, /path, ?query, #fragment or relative."""
    root = F.concat(scheme(base), F.lit("://"), F.regexp_extract(base, _PARTS, 2))
    folder = F.regexp_extract(path(base), r"^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    joined = F.concat(folder, ref)
    # './' and '../' at any depth: walk the segments, '..' takes back the last one
    segments = F.split(F.regexp_extract(joined, r"^/([^?#]*)", 1), "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(segments, none, lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.array_append(done, s)))
    open_end = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    clean = F.concat(F.lit("/"), F.array_join(kept, "/"), open_end, F.regexp_extract(joined, r"^[^?#]*(.*)$", 1))
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(F.lit("https:"), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref.startswith("?"), F.concat(root, path(base), ref))
        .when(ref.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), ref))
        .otherwise(F.concat(root, clean))
    )


def best_of_srcset(srcset: Column) -> Column:
    """The URL of a srcset with the largest width or density descriptor; ties: the later text."""
    parts = F.split(F.coalesce(srcset, F.lit("")), ",")
    options = F.transform(
        parts, lambda p: F.filter(F.split(F.regexp_replace(p, r"\s+", " "), " "), lambda w: w != "")
    )

    def weigh(pieces: Column) -> Column:
        mark = F.lower(F.coalesce(F.get(pieces, F.lit(1)), F.lit("")))
        width = F.regexp_extract(mark, r"^(-?[0-9]+)w$", 1).try_cast("bigint")
        density = F.regexp_extract(mark, r"^(-?[0-9]*\.?[0-9]+)x$", 1).try_cast("double")
        weight = F.coalesce(width, (density * 1000).cast("bigint"), F.lit(0).cast("bigint"))
        return F.struct(weight.alias("weight"), F.get(pieces, F.lit(0)).alias("url"))

    ranked = F.transform(F.filter(options, lambda o: F.size(o) > 0), weigh)
    return F.coalesce(F.array_max(ranked)["url"], F.lit(""))
