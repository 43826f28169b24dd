"""URL rules and a weighted vocabulary found by an Aho-Corasick automaton.

One map over the URLs: the automaton is a bounded, fixed list inside the task, nothing is shuffled.
"""

from __future__ import annotations

import re

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The default vocabulary. One strict term rejects a URL, soft terms only together.
STRICT = [
    "adult", "casino", "casinos", "gambling", "hentai", "malware", "phishing", "porn", "porno", "sex", "spam", "viagra", "warez", "xxx",
]
SOFT = [
    "ad", "ads", "bet", "bets", "betting", "bonus", "cheap", "cialis", "click", "crack", "dating", "escort", "farm", "free", "jackpot",
    "keygen", "loan", "loans", "lottery", "nude", "pharmacy", "pill", "pills", "poker", "replica", "slots", "torrent", "track",
    "tracker", "tracking", "win", "winner",
]
SOFT_HITS = 2

# Verdict, host and path of the rules of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a text without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.regexp_replace(F.coalesce(rest, F.lit("")), r"(?s)[?#].*$", "")
    return F.translate(F.regexp_replace(rest, r"(?s)/.*$", ""), UPPER, LOWER), F.regexp_replace(rest, r"(?s)^[^/]*", "")


def rule_column(host: Column, path: Column, rules: list[tuple[str, str, str]], want: int | None = None) -> Column:
    """The longest fitting rule as host + path, or its verdict (want=0); null without one."""
    found = F.lit(None).cast("string")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.lit(verdict if want == 0 else name + start)).otherwise(found)
    return found


def automaton(strict: list[str], soft: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            found.add_word(term, (weight, term))
    found.make_automaton()
    return found


def term_hits(text: str, found: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms of a lower-case text that stand between non-alphanumeric characters."""
    hits = {"strict": set(), "soft": set()}
    for end, (weight, term) in found.iter(text):
        start = end - len(term) + 1
        if not (start and is_part(text[start - 1])) and not (end + 1 < len(text) and is_part(text[end + 1])):
            hits[weight].add(term)
    return hits["strict"], hits["soft"]


def is_part(char: str) -> bool:
    return "a" <= char <= "z" or "0" <= char <= "9"


def judge_urls(pages: DataFrame, id: str = "page_id", url: str = "url", rules: list[tuple[str, str, str]] = (),
               strict: list[str] = STRICT, soft: list[str] = SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, strict_terms and soft_terms (distinct, in order).

    The longest fitting rule decides; otherwise the vocabulary does, over the whole URL with A-Z folded: one
    strict term or `soft_hits` distinct soft terms block. Texts without :// have empty parts, so no rule fits, and are searched
    as they are; null counts as empty and is allowed.
    Repeated rows are judged one by one; other columns are not read.
    """
    index = automaton(list(strict), list(soft)) if strict or soft else None

    @F.pandas_udf("strict_terms array<string>, soft_terms array<string>")
    def terms(text: pd.Series) -> pd.DataFrame:
        rows = [term_hits(t, index) if index is not None and t else (set(), set()) for t in text]
        return pd.DataFrame({"strict_terms": [sorted(a) for a, _ in rows], "soft_terms": [sorted(b) for _, b in rows]})

    host, path = parts(F.col("_url"))
    rows = pages.select(F.col(id).alias("_id"), F.col(url).cast("string").alias("_url")).select("_id", "_url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_terms", terms(F.translate(F.coalesce("_url", F.lit("")), UPPER, LOWER)))
    rules = list(rules)
    bad = (F.size("_terms.strict_terms") > 0) | (F.size("_terms.soft_terms") >= soft_hits)
    verdict = F.coalesce(rule_column(F.col("host"), F.col("path"), rules, 0), F.when(bad, "block").otherwise("allow"))
    return rows.select(
        F.col("_id").alias(id), "host", "path", rule_column(F.col("host"), F.col("path"), rules).alias("rule"), verdict.alias("verdict"),
        F.col("_terms.strict_terms").alias("strict_terms"), F.col("_terms.soft_terms").alias("soft_terms"),
    )


def term_pattern(terms: list[str]) -> str:
    """The same boundary check as one pattern, for the SQL counterpart."""
    return f"(^|[^a-z0-9])({'|'.join(map(re.escape, terms))})([^a-z0-9]|$)"
