"""Snapshots as intervals of days in which a row did not change.

Snapshots repeat every row daily, most of them unchanged. Here each distinct row is
stored once per run of snapshots that hold it, with the first and the last day of that
run (``first_dt``, ``dt``). The rows of any day, and the distinct rows of any window, come
back from that exactly, so every look-up over snapshots works on intervals as it is.

Stored intervals are partitioned by their last day. A new snapshot then touches two
partitions only: the one of the day before, whose rows are extended or stay closed, and
its own; both become visible by one marker. A look-up for a day reads later partitions only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sendstats.operators.sizing import join_few
from sendstats.sources.committed import commit, read_committed, stage, visible
from sendstats.sources.scans import as_day, read_snapshots

DAYS = ("first_dt", "dt")


def snapshot_days(snapshots: DataFrame) -> list[dt.date]:
    """The days there are snapshots of: one value a day, of the partition column alone."""
    return sorted(r.dt for r in snapshots.select("dt").distinct().collect() if r.dt is not None)


def _day_array(days: Sequence[dt.date]) -> Column:
    return F.array(*[F.lit(day) for day in days]).cast("array<date>")


def row_intervals(snapshots: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Gaps and islands: one row per distinct row of ``snapshots`` and run of ``days`` that hold it.

    One shuffle by the whole row, so no entity is a hot key; equal rows of several days
    collapse before it. A row's list of days is bounded by the calendar.
    """
    carried = [c for c in snapshots.columns if c not in DAYS]
    place = F.array_position(_day_array(days), F.col("dt")).cast("int")
    runs = snapshots.where(F.col("dt").isNotNull()).groupBy(*carried).agg(F.array_sort(F.collect_set(place)).alias("_at"))
    starts = F.expr("filter(_at, (p, i) -> i = 0 OR _at[greatest(i - 1, 0)] <> p - 1)")
    ends = F.expr("filter(_at, (p, i) -> i = size(_at) - 1 OR _at[least(i + 1, size(_at) - 1)] <> p + 1)")
    run = runs.select(*carried, F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("_run"))
    day = lambda p: F.get(_day_array(days), F.col(p) - 1)
    return run.select(*carried, day("_run.a").alias("first_dt"), day("_run.b").alias("dt"))


def extended(ending: DataFrame, snapshot: DataFrame, day: dt.date) -> DataFrame:
    """The intervals that end with the day before, and those of the snapshot of ``day``, as they are after it.

    Rows that are in both are extended, those gone stay closed, new ones open.
    """
    carried = [c for c in snapshot.columns if c not in DAYS]
    none = F.lit(None).cast("date")
    old = ending.select(*carried, *DAYS, F.lit(False).alias("_in"))
    new = snapshot.select(*carried, none.alias("first_dt"), none.alias("dt"), F.lit(True).alias("_in"))
    both = old.unionByName(new).groupBy(*carried).agg(
        F.max("first_dt").alias("first_dt"), F.max("dt").alias("dt"), F.max("_in").alias("_in")
    )
    return both.select(
        *carried,
        F.coalesce("first_dt", F.lit(day)).alias("first_dt"),
        F.when(F.col("_in"), F.lit(day)).otherwise(F.col("dt")).alias("dt"),
    )


def interval_path(root: str, model: str) -> str:
    return f"{root}/intervals/{model}"


def _stored(spark: SparkSession, path: str, rows: T.StructType, days=None) -> DataFrame:
    fields = [*[f for f in rows.fields if f.name not in DAYS], *[T.StructField(d, T.DateType()) for d in DAYS]]
    return read_committed(spark, path, T.StructType(fields), days)


def refresh_intervals(spark: SparkSession, root: str, model: str, rebuild: bool = False) -> list[dt.date]:
    """Bring the stored intervals of a model up to its snapshots; the days that were added.

    Snapshots after the newest one known are added one by one. The first call, ``rebuild`` and
    a snapshot that appears between known days make all intervals again. A known snapshot that
    was replaced is not noticed: ``rebuild`` is for that.
    """
    snapshots, path = read_snapshots(spark, f"{root}/{model}", model), interval_path(root, model)
    days, known = snapshot_days(snapshots), sorted(visible(spark, path))
    new = [day for day in days if day not in known]
    if rebuild or not known or (new and new[0] < known[-1]) or set(known) - set(days):
        gone = {day: None for day in known if day not in days}
        commit(spark, path, stage(row_intervals(snapshots, days), path, days) | gone, replace=True)
        return days
    for day in new:
        before = known[-1]
        rows = extended(_stored(spark, path, snapshots.schema, [before]), snapshots.where(F.col("dt") == F.lit(day)), day)
        commit(spark, path, stage(rows, path, [before, day]), replace=True)
        known.append(day)
    return new


class Intervals:
    """The intervals of one model with the days that had snapshots."""

    def __init__(self, rows: DataFrame, days: Sequence[dt.date]):
        self.rows = rows
        self.days = sorted(days)

    def _newest(self, day) -> dt.date | None:
        return max((d for d in self.days if d <= as_day(day)), default=None)

    def on(self, day) -> DataFrame:
        """The rows of the newest snapshot up to ``day``, as its own ``dt``; none before the first one."""
        at = F.lit(self._newest(day)).cast("date")
        held = self.rows.where((F.col("dt") >= at) & (F.col("first_dt") <= at))
        return held.drop("first_dt").withColumn("dt", at)

    def between(self, start, end) -> DataFrame:
        """The distinct rows of the snapshots of a window, once per run, with the last day of the run in the window."""
        first, last = as_day(start), as_day(end)
        # Both ends of the window moved to snapshots: a run that lies round a window without any is not in it.
        inside = [d for d in self.days if first <= d <= last]
        low, high = (F.lit(d).cast("date") for d in ((inside[0], inside[-1]) if inside else (None, None)))
        held = self.rows.where((F.col("dt") >= low) & (F.col("first_dt") <= high))
        return held.drop("first_dt").withColumn("dt", F.least("dt", high))

    def joined(self, rows: DataFrame, on: Sequence[str], day: str) -> DataFrame:
        """Inner interval join: each of ``rows`` with what the newest snapshot up to its ``day`` says.

        Short interval lists are broadcast after they were counted; for long ones the ``rows`` of hot keys are salted.
        """
        until = F.get(_day_array(self.days), F.array_position(_day_array(self.days), F.col("dt")).cast("int"))
        states = self.rows.withColumn("_until", until).withColumnRenamed("first_dt", "_from").drop("dt")
        met = join_few(rows, states, on, "inner", count_keys=True)
        held = (F.col("_from") <= F.col(day)) & (F.col("_until").isNull() | (F.col(day) < F.col("_until")))
        return met.where(held).drop("_from", "_until")


def read_intervals(spark: SparkSession, root: str, model: str) -> Intervals:
    path = interval_path(root, model)
    schema = read_snapshots(spark, f"{root}/{model}", model).schema
    return Intervals(_stored(spark, path, schema), list(visible(spark, path)))
