"""Text, date and hash expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where a user's public profile lives.
PROFILE_BASE = "https://github.com/"


def _md5_number(value: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(value.cast("string")), 1, digits), 16, 10).cast("bigint")


def hash32(value: Column) -> Column:
    """First 8 hex digits of the md5 of the value's text, as a bigint.

    Unlike ``rand()`` it gives the same value when a lost task runs again, and any SQL
    engine with md5 can reproduce it.
    """
    return _md5_number(value, 8)


def hash60(value: Column) -> Column:
    """The same with 15 hex digits, for ranges that 32 bits would not cover evenly."""
    return _md5_number(value, 15)


def event_day(created_at: Column) -> Column:
    """Day of an event time such as ``2018-01-02 03:04:05 UTC`` or ``2018-01-02T03:04:05Z``.

    One-digit months and days are accepted; text that is no date gives null.
    """
    words = F.replace(created_at, F.lit("T"), F.lit(" "))
    return F.try_to_date(F.substring_index(words, " ", 1), "yyyy-M-d")


def picker_text(day: Column) -> Column:
    """A day as a date picker prints it: ``Mon Jan 01 2018``."""
    return F.date_format(day, "EEE MMM dd yyyy")


def picker_day(text: Column) -> Column:
    """The day in a date picker's text; null when the text holds none.

    Spark parses no weekday names, so the first word is cut off.
    """
    return F.try_to_date(F.regexp_replace(text, r"^\s*\S+\s+", ""), "MMM d yyyy")


def iso_text(day: Column) -> Column:
    """A day as ``2018-01-01``."""
    return F.date_format(day, "yyyy-MM-dd")


def in_window(day: Column, start: date, end: date) -> Column:
    """True strictly between the two days: both end days are outside."""
    return (day > F.lit(start)) & (day < F.lit(end))


def profile_link(usr: Column) -> Column:
    """Address of a user's profile page."""
    return F.concat(F.lit(PROFILE_BASE), usr.cast("string"))
