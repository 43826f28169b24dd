"""Event words of headlines, and the subject words left when they are taken out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import text as tx


def event_of(token: Column, classes=None) -> Column:
    """The event a word stands for, or null. The first class that matches wins.

    Only words that begin like some term are compared with the terms one by one; most words go after one look at a set.
    """
    classes = fv.EVENT_CLASSES if classes is None else classes
    terms = [t for _, prefixes, whole in classes for t in (*prefixes, *whole)]
    least = min(map(len, terms))
    out = None
    for event, prefixes, whole in classes:
        hit = None
        for prefix in prefixes:
            one = token.startswith(prefix)
            hit = one if hit is None else hit | one
        if whole:
            one = token.isin(*whole)
            hit = one if hit is None else hit | one
        out = F.when(hit, event) if out is None else out.when(hit, event)
    return F.when(F.substring(token, 1, least).isin(sorted({t[:least] for t in terms})), out)


def event_set(tokens: Column, classes=None) -> Column:
    return F.sort_array(F.array_distinct(F.array_compact(F.transform(tokens, lambda w: event_of(w, classes)))))


def with_events_named(tokens: Column, classes=None) -> Column:
    """Words in order, each event word replaced by its event."""
    return F.transform(tokens, lambda w: F.coalesce(event_of(w, classes), w))


def subject_words(tokens: Column, classes=None, stopwords=None, generic=None) -> Column:
    """Distinct words of 3+ letters that are no stop word, generic word, year or event word."""
    stop = fv.HISTORY_STOPWORDS if stopwords is None else stopwords
    broad = fv.HISTORY_GENERIC if generic is None else generic
    kept = F.filter(
        tokens,
        lambda w: (F.length(w) >= 3) & ~w.rlike("^0*20[0-9]{2}$") & event_of(w, classes).isNull(),
    )
    return F.array_except(kept, tx.lit_array(list(stop) + list(broad)))


def distinctive_words(subject: Column, min_length: int = 5) -> Column:
    return F.filter(subject, lambda w: F.length(w) >= min_length)


def families(normal: Column, table=None) -> Column:
    """Names of the event families with a phrase in the normalised title, in table order."""
    padded = F.concat(F.lit(" "), normal, F.lit(" "))
    table = fv.EVENT_FAMILIES if table is None else table
    tests = []
    for name, phrases in table.items():
        hit = None
        for phrase in phrases:
            one = padded.contains(f" {phrase} ")
            hit = one if hit is None else hit | one
        tests.append(F.when(hit, F.lit(name)))
    return F.array_compact(F.array(*tests))
