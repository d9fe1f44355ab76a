"""Counting message events.

All counts are two-level. The first level groups by everything a unique is
defined on; the second one only sums its small result into counter columns. The
user columns enter the first level only for the labels whose uniques are
reported, so the other labels (the bulk: sent and delivered) collapse in the
map-side aggregation already, and one message that holds a large part of all
events is spread over its users.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendstats.functions.events import UNIQUE_LABELS
from sendstats.operators.idfilter import probed
from sendstats.operators.sizing import few_rows


def event_counts(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Occurrences by ``keys`` and label."""
    return events.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("occurrence"))


def collapsed(events: DataFrame, keys: Sequence[str], unique_keys: Sequence[str]) -> DataFrame:
    """The first level: occurrences by ``keys``, label and, for the labels whose uniques are reported, ``unique_keys``."""
    tracked = F.col("label").isin(*UNIQUE_LABELS)
    marks = [F.when(tracked, F.col(k)).alias(k) for k in unique_keys]
    return events.groupBy(*keys, "label", *marks).agg(F.count(F.lit(1)).alias("occurrence"))


def counters_of_groups(
    groups: DataFrame, keys: Sequence[str], counters: dict[str, str], unique_keys: Sequence[str] = ()
) -> DataFrame:
    """The second level: ``groups``, distinct in keys, label and unique keys, as totals and uniques by ``keys``."""
    columns = _sums(counters)
    if unique_keys:
        columns += [F.expr(f"count_if(label = '{u}')").alias(f"Unique_{u}") for u in UNIQUE_LABELS]
    return groups.groupBy(*keys).agg(*columns)


def message_counters(
    events: DataFrame,
    keys: Sequence[str],
    counters: dict[str, str],
    unique_keys: Sequence[str] = (),
) -> DataFrame:
    """Totals and, when ``unique_keys`` are given, per-day uniques in one pass."""
    return counters_of_groups(collapsed(events, keys, unique_keys), keys, counters, unique_keys)


def _sums(counters: dict[str, str]) -> list[Column]:
    return [
        F.expr(f"sum(if(label = '{label}', occurrence, 0))").alias(name)
        for label, name in counters.items()
    ]


def of_messages(events: DataFrame, ids: DataFrame, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``count`` makes of the events of the (app, message) pairs in ``ids``.

    A short id list filters the events, so foreign messages are never shuffled.
    A long one filters them by a hashed bitmap, which leaves few foreign events, and
    then the finished counts, which gives the same rows because ``count`` groups by both
    id columns; events are never shuffled by message id, whatever share of them one
    message holds.
    """
    pair = ["app_id", "message_id"]
    if few_rows(ids):
        return count(events.join(F.broadcast(ids), pair, "left_semi"))
    return count(probed(events, ids, pair)).join(ids, pair, "left_semi")


def counters_of_messages(
    events: DataFrame,
    ids: DataFrame,
    keys: Sequence[str],
    counters: dict[str, str],
    unique_keys: Sequence[str] = (),
) -> DataFrame:
    """``message_counters`` of the (app, message) pairs in ``ids`` only."""
    return of_messages(events, ids, lambda own: message_counters(own, keys, counters, unique_keys))
