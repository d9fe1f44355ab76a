"""Decoding of message events.

A message event is named ``.m`` + 16-digit message id + one separator + label.
An empty label means the message was sent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event label -> counter column, email then push.
EMAIL_COUNTERS = {
    "Sent": "Sent",
    "Delivered": "Delivered",
    "Open": "Open",
    "Click": "Click",
    "Bounce": "Bounce",
    "Dropped": "Dropped",
    "Block": "Block",
    "Unsubscribe": "Unsubscribe",
    "Marked as spam": "Spam",
}
PUSH_COUNTERS = {
    "Sent": "Sent",
    "Bounce": "Bounce",
    "Held Back": "Held_Back",
    "Open": "Open",
}
# The labels whose per-day uniques are reported.
UNIQUE_LABELS = ("Open", "Click")

SECONDS_PER_DAY = 86400
# 0001-01-01 and 9999-12-31 in days since 1970.
FIRST_DAY, LAST_DAY = -719_162, 2_932_896


def is_message_event(name: Column) -> Column:
    return name.startswith(".m")


def event_message_id(name: Column) -> Column:
    """The message id, NULL when the 16 characters are not a number."""
    return F.substring(name, 3, 16).try_cast("bigint")


def event_label(name: Column) -> Column:
    label = F.substr(name, F.lit(20))
    return F.when(label == "", "Sent").otherwise(label)


def event_causes(timed: bool) -> list[Column]:
    """Counts of events by what becomes of them; they add up, but for ``bad_times``, to ``events``.

    ``nameless`` and ``foreign`` events are no message events, ``bad_ids`` have no message id,
    ``unknown_labels`` no counter. ``bad_times``, where times are read, have no day.
    """
    name = F.col("name")
    message, known = is_message_event(name), event_label(name).isin(*EMAIL_COUNTERS, *PUSH_COUNTERS)
    found = message & event_message_id(name).isNotNull()
    causes = {
        "events": F.lit(True),
        "nameless": name.isNull(),
        "foreign": ~message,
        "bad_ids": message & event_message_id(name).isNull(),
        "unknown_labels": found & ~known,
        "counted": found & known,
    }
    if timed:
        causes["bad_times"] = found & utc_day(F.col("time")).isNull()
    return [F.count_if(cause).alias(title) for title, cause in causes.items()]


def utc_day(seconds: Column) -> Column:
    """UTC date of epoch seconds, whatever the session time zone is.

    The seconds are cut to whole seconds first (toward zero), as an integer
    cast does. Times outside the years 1 to 9999, as of stamps in other units,
    have no date.
    """
    whole = seconds.try_cast("bigint")
    days = F.floor(whole / SECONDS_PER_DAY)
    known = F.when(days.between(FIRST_DAY, LAST_DAY), days)
    return F.date_from_unix_date(known.cast("int"))


def day_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def start_date(active_since: Column) -> Column:
    return F.coalesce(day_text(utc_day(F.unix_seconds(active_since))), F.lit("Unknown"))
