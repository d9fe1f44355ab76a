"""Counters by session day, kept in a table, for domain reports that scan closed days once.

Of each day of sessions the table ``<root>/day_state`` holds, by app, message and domain

- ``count``: the occurrences of each label, and how many distinct (user, address) opened or
  clicked on that very day. These add up over days.
- ``spill``: the distinct opens and clicks (user, address, event day) whose event fell on
  another day than its session, as after midnight. They are few.
- ``mark``: the distinct opens and clicks of the day itself. They are read only to tell which
  spills into the day it has already.

A unique counts once per event day, so the counters of the days and the spills that no day of
the window has yet give just what one pass over all sessions gives.

A day is built again if its session files, by name, size and time, or the place of the email
attribute of one of its apps are not what they were; it replaces that day alone, see
``committed``. Days that are not built yet, such as the running one, are counted from their
sessions.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from sendstats.functions.events import EMAIL_COUNTERS, UNIQUE_LABELS
from sendstats.functions.mail import EMAIL
from sendstats.operators.counts import collapsed
from sendstats.operators.nesting import email_position, message_events, with_email
from sendstats.operators.sizing import few_rows
from sendstats.plans.domain import KEYS, report_of_counters
from sendstats.plans.inputs import Inputs, Scope
from sendstats.plans.messages import DEFAULT_LINK_BASE
from sendstats.sources.committed import commit, exists, file_system, read_committed, stage, visible
from sendstats.sources.ingest import days_between
from sendstats.sources.scans import read_sessions

COUNT, SPILL, MARK = "count", "spill", "mark"
IDENTITY = ["user_id", "email", "day"]
SCHEMA = StructType([
    StructField(name, kind)
    for kind, names in (
        (StringType(), ("kind", "Domain", "label", "email")),
        (LongType(), ("app_id", "message_id", "user_id", "occurrence", "uniques")),
        (IntegerType(), ("email_at",)),
        (DateType(), ("day", "dt")),
    )
    for name in names
])


def state_path(root: str) -> str:
    return f"{root}/day_state"


def state_rows(sessions: DataFrame, positions: DataFrame) -> DataFrame:
    """The rows of the table for ``sessions``: one scan, one shuffle of collapsed events.

    ``positions``: see ``email_position``. Apps without one are counted as well, without addresses.
    """
    columns = ["user_id", "app_id", "states", "attrs", "dt"]
    located = with_email(sessions.select(*columns), positions, "left")
    events = message_events(located).where(F.col("label").isin(*EMAIL_COUNTERS))
    first = collapsed(events, [*KEYS, "dt"], IDENTITY)
    tracked, own = F.col("label").isin(*UNIQUE_LABELS), F.col("day") == F.col("dt")
    counts = first.groupBy(*KEYS, "label", "dt").agg(
        F.sum("occurrence").alias("occurrence"), F.count_if(tracked & own).alias("uniques")
    ).join(F.broadcast(positions) if few_rows(positions) else positions, "app_id", "left").withColumn("kind", F.lit(COUNT))
    seen = first.where(tracked).withColumn("kind", F.when(own, MARK).otherwise(SPILL)).drop("occurrence")
    return counts.unionByName(seen, allowMissingColumns=True).select(*SCHEMA.fieldNames())


def fingerprint(spark: SparkSession, folder: str) -> str | None:
    """Names, sizes and times of the files below a folder; None if there is none."""
    if not exists(spark, folder):
        return None
    files = file_system(spark, folder).listFiles(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append(f"{file.getPath().getName()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def refresh(spark: SparkSession, root: str, inputs: Inputs, start, end) -> list[dt.date]:
    """Build the days of the window that are missing or have changed; returns them.

    ``inputs``: for the apps as they are now. Sessions of no other day are read.
    """
    path, positions = state_path(root), email_position(inputs.live_app)
    there, notes = visible(spark, path), {}
    for day in days_between(start, end):
        note = fingerprint(spark, f"{root}/sessions/dt={day}")
        if note:
            notes[day] = note
    moved = _moved_days(read_committed(spark, path, SCHEMA, notes), positions)
    stale = [day for day, note in notes.items() if day in moved or day not in there or there[day].note != note]
    gone = {day: None for day in days_between(start, end) if day in there and day not in notes}
    built = {}
    if stale:
        sessions = read_sessions(spark, f"{root}/sessions", "domain").where(F.col("dt").isin(stale))
        built = stage(state_rows(sessions, positions), path, stale, notes)
    if built or gone:
        commit(spark, path, built | gone, replace=True)
    return stale


def _moved_days(stored: DataFrame, positions: DataFrame) -> set[dt.date]:
    """Days that were built with another place of an app's email attribute."""
    seen = stored.where(F.col("kind") == COUNT).select("dt", "app_id", "email_at").distinct()
    now = positions.withColumnRenamed("email_at", "now")
    found = seen.join(now, "app_id", "left").where(~F.col("email_at").eqNullSafe(F.col("now")))
    return {r.dt for r in found.select("dt").distinct().collect()}


def counters_of_days(rows: DataFrame) -> DataFrame:
    """Totals and uniques by app, message and domain from rows of the table; ``rows`` has the window's days."""
    identity = [*KEYS, "label", *IDENTITY]
    spilled = rows.where(F.col("kind") == SPILL).select(*identity).distinct()
    marks = rows.where(F.col("kind") == MARK).select(*identity)
    # Marks are read for the spills alone, which are short enough to be broadcast as a rule.
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"m.{c}")) for c in identity]
    side = F.broadcast(spilled) if few_rows(spilled) else spilled
    known = marks.alias("m").join(side.alias("s"), same, "left_semi")
    fresh = spilled.alias("s").join(known.alias("m"), same, "left_anti")
    extra = fresh.select(*KEYS, "label", F.lit(0).cast("bigint").alias("occurrence"), F.lit(1).cast("bigint").alias("uniques"))
    every = rows.where(F.col("kind") == COUNT).select(*KEYS, "label", "occurrence", "uniques").unionByName(extra)
    totals = [F.expr(f"sum(if(label = '{label}', occurrence, 0))").alias(name) for label, name in EMAIL_COUNTERS.items()]
    uniques = [F.expr(f"sum(if(label = '{u}', uniques, 0))").alias(f"Unique_{u}") for u in UNIQUE_LABELS]
    return every.groupBy(*KEYS).agg(*totals, *uniques)


def stored_domain_report(
    spark: SparkSession, root: str, inputs: Inputs, start, end, company_id=None, app_id=None, link_base=DEFAULT_LINK_BASE
) -> DataFrame:
    """``domain_report`` from the table; only the sessions of days that it lacks are read."""
    scope, path = Scope(inputs, end, company_id, app_id), state_path(root)
    there = visible(spark, path)
    days = [day for day in days_between(start, end) if day in there]
    rows = read_committed(spark, path, SCHEMA, days)
    open_days = [day for day in days_between(start, end) if day not in there and exists(spark, f"{root}/sessions/dt={day}")]
    if open_days:
        sessions = inputs.sessions.where(F.col("dt").isin(open_days))
        rows = rows.unionByName(state_rows(scope.of_app(sessions), email_position(inputs.live_app)))
    counters = counters_of_days(scope.of_app(rows))
    ids = scope.ids(inputs.live_study, EMAIL)
    own = counters.join(ids, ["app_id", "message_id"], "left_semi").join(scope.email_positions().select("app_id"), "app_id", "left_semi")
    return report_of_counters(own, inputs, start, end, scope, link_base)
