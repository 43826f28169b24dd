"""Clock, date and age rules. Every rule takes `as_of`; none reads the wall clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from pressroom import fixed_values as fv
from pressroom.functions import text as tx

HOUR = 3_600_000_000


def clock(as_of) -> Column:
    """`as_of` as a timestamp Column: a Column, a datetime or an ISO text (read as UTC)."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.to_timestamp(F.lit(as_of if "+" in as_of or as_of.endswith("Z") else as_of + "+00:00"))


def feed_date(raw: Column) -> Column:
    """RFC 822 or ISO date text to a timestamp; a date without a zone is UTC; bad text is null."""
    bare = F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3,9},\s*", "")
    bare = F.regexp_replace(bare, r"\s+", " ")
    zoned = F.when(bare.rlike(r"(?i)( [+-]\d{4}| [A-Z]{1,5})$"), bare).otherwise(F.concat(bare, F.lit(" +0000")))
    utc = F.regexp_replace(zoned, r" (GMT|UT|UTC|Z)$", " +0000")
    return F.coalesce(
        F.try_to_timestamp(utc, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(utc, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(utc, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(F.when(raw.rlike(r"^\d{4}-"), raw)),
    )


def day_of(text: Column) -> Column:
    """The first ten characters as a date; null when they are none."""
    return F.substring(text, 1, 10).try_cast("date")


def age_micros(moment: Column, as_of) -> Column:
    return F.unix_micros(clock(as_of)) - F.unix_micros(moment)


def age_points(published: Column, as_of) -> Column:
    """Points for freshness; no date gives 0, a date in the future counts as fresh."""
    age = age_micros(published, as_of)
    return (
        F.when(published.isNull(), 0)
        .when(age <= 12 * HOUR, 16)
        .when(age <= 24 * HOUR, 12)
        .when(age <= 48 * HOUR, 7)
        .when(age <= 72 * HOUR, 3)
        .otherwise(-20)
    )


def age_days(day: Column, as_of) -> Column:
    """Whole days from midnight (UTC) of `day` to the clock, never negative; null without a date."""
    micros = F.unix_micros(clock(as_of)) - F.unix_date(day).cast("bigint") * (24 * HOUR)
    return F.greatest(F.floor(micros / F.lit(24 * HOUR)), F.lit(0)).cast("int")


def since_day(day: Column, as_of, days: int) -> Column:
    """True when midnight (UTC) of `day` is no more than `days` x 24 h before the clock."""
    midnight = F.unix_date(day).cast("bigint") * (24 * HOUR)
    return F.coalesce(midnight >= F.unix_micros(clock(as_of)) - days * 24 * HOUR, F.lit(False))


def in_window(published: Column, as_of, days: int, grace_hours: int = fv.WINDOW_GRACE_HOURS) -> Column:
    """Undated, or not older than `days` plus the grace."""
    limit = (days * 24 + grace_hours) * HOUR
    return published.isNull() | (age_micros(published, as_of) <= limit)


def local_time(moment: Column, zone: str = fv.LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(F.to_utc_timestamp(moment, F.current_timezone()), zone)


def month_key(moment: Column, zone: str = fv.LOCAL_ZONE) -> Column:
    return F.date_format(local_time(moment, zone), "yyyy-MM")


def card_date(moment: Column, zone: str = fv.LOCAL_ZONE) -> Column:
    """'03 ENE 2024' in local time."""
    local = local_time(moment, zone)
    months = F.array(*[F.lit(m) for m in fv.MONTHS_ES])
    return F.concat_ws(
        " ", F.date_format(local, "dd"), F.element_at(months, F.month(local)), F.date_format(local, "yyyy")
    )


def cover_date(shown: Column, moment: Column, zone: str = fv.LOCAL_ZONE) -> Column:
    """The date on a cover: the first story's own, in capitals, else the card date of the moment."""
    own = tx.blank_if_null(shown)
    return F.when(own != "", F.upper(own)).otherwise(card_date(moment, zone))
