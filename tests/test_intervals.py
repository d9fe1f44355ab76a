"""Change intervals of snapshots against the snapshots themselves."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import scenario as s
from sendstats.operators import sizing
from sendstats.operators.dims import latest, newest_definition, push_names, senders
from sendstats.sources import intervals as iv
from sendstats.sources.committed import visible
from sendstats.sources.scans import between_days, on_day, read_snapshots

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3, 7, 8, 20)]
SCHEMA = "key bigint, name string, tags array<string>, dt date"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def history(seed):
    """Random snapshots: entities come, change, change back and go; rows may be repeated or have NULLs."""
    rng, found = random.Random(seed), []
    for day in DAYS:
        for key in [*range(12), None]:
            if rng.random() < 0.75:
                row = (key, rng.choice(["a", "b", None]), rng.choice([["x"], [], None]), day)
                found += [row] * rng.choice([1, 1, 2])
    return found


def plain(found):
    """Runs of consecutive days of each distinct row."""
    out = []
    for row in {str(r[:3]): r[:3] for r in found}.values():
        first = None
        for i, day in enumerate(DAYS):
            here = (*row, day) in found
            if here and first is None:
                first = day
            if first and (not here or day == DAYS[-1]):
                out.append((*row, first, day if here else DAYS[i - 1]))
                first = None
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_of_unchanged_rows(spark, seed):
    found = history(seed)
    df = spark.createDataFrame(found, SCHEMA)
    made = iv.row_intervals(df, DAYS)
    assert rows(made) == plain(found) and iv.snapshot_days(df) == DAYS
    held = iv.Intervals(made, DAYS)
    for day in (dt.date(2023, 12, 31), DAYS[0], dt.date(2024, 1, 5), DAYS[3], DAYS[-1], dt.date(2025, 1, 1)):
        newest = max((d for d in DAYS if d <= day), default=None)
        assert rows(held.on(day)) == sorted({str(r): r for r in found if r[3] == newest}.values(), key=str)
    for start, end in ((DAYS[0], DAYS[-1]), (DAYS[1], DAYS[3]), (dt.date(2024, 1, 9), dt.date(2024, 1, 19))):
        window = {str((*r, d)) for r in (r[:3] for r in found) for d in DAYS if (*r, d) in found and start <= d <= end}
        # Each row of the window is in it, with the last of its days.
        got = rows(held.between(start, end))
        assert {str(r) for r in got} <= window and {str(r[:3]) for r in got} == {str(r[:3]) for r in found if start <= r[3] <= end}
    assert held.rows.sparkSession.createDataFrame([], SCHEMA).transform(lambda e: iv.row_intervals(e, [])).count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_interval_join(spark, monkeypatch, few):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 10**6 if few else -1)
    found = history(3)
    held = iv.Intervals(iv.row_intervals(spark.createDataFrame(found, SCHEMA), DAYS), DAYS)
    asked = [(k, dt.date(2023, 12, 30) + dt.timedelta(days=d)) for k in [*range(13), None] for d in range(0, 26, 2)]
    expected = set()
    for key, day in asked:
        newest = max((d for d in DAYS if d <= day), default=None)
        expected |= {str((key, day, *r[1:3])) for r in found if r[0] == key and r[3] == newest and key is not None}
    got = rows(held.joined(spark.createDataFrame(asked, "key bigint, day date"), ["key"], "day"))
    assert len(got) == len(expected) and {str(r) for r in got} == expected


def test_a_long_interval_list_is_not_copied_for_all_keys(spark, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", -1)
    held = iv.Intervals(iv.row_intervals(spark.createDataFrame(history(3), SCHEMA), DAYS), DAYS)
    met = held.joined(spark.range(13).select(F.col("id").alias("key"), F.lit(DAYS[-1]).alias("day")), ["key"], "day")
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "explode([0,1,2" not in plan and "explode(sequence(0, CASE WHEN" in plan


def test_day_by_day_equals_all_at_once(spark, tmp_path):
    found, root = history(4), str(tmp_path)
    # Stored as studies, which is what the readers know.
    df = spark.createDataFrame(found, SCHEMA).selectExpr(
        "struct(key AS id) AS __key__", "struct(1L AS id) AS app", "name", "get(tags, 0) AS action_type", "1 AS delivery_type",
        "CAST(NULL AS timestamp) AS last_change_time", "CAST(NULL AS timestamp) AS active_since", "7L AS category_id", "dt",
    )
    path = iv.interval_path(root, "Study")
    for i, day in enumerate(DAYS):
        df.where(df.dt == day).write.mode("append").partitionBy("dt").parquet(f"{root}/Study")
        if i:
            before = visible(spark, path)
            assert iv.refresh_intervals(spark, root, "Study") == ([day] if i > 1 else DAYS[:2])
            # Only the new day and the one before it are written.
            moved = {d for d, entry in visible(spark, path).items() if before.get(d) != entry}
            assert moved == ({DAYS[i - 1], day} if i > 1 else set(DAYS[:2]))
    assert iv.refresh_intervals(spark, root, "Study") == []
    study = read_snapshots(spark, f"{root}/Study", "Study")
    stored = iv.read_intervals(spark, root, "Study")
    names = stored.rows.columns
    assert stored.days == DAYS and rows(stored.rows) == rows(iv.row_intervals(study, DAYS).select(names))
    # A look-up reads the partitions of its day and later ones.
    plan = stored.on(DAYS[3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and ">= 2024-01-07" in plan
    # A snapshot between known ones, or one that is gone, makes them again.
    df.where(df.dt == DAYS[1]).withColumn("dt", iv.F.lit(dt.date(2024, 1, 5))).write.mode("append").partitionBy("dt").parquet(f"{root}/Study")
    assert len(iv.refresh_intervals(spark, root, "Study")) == 7
    study = read_snapshots(spark, f"{root}/Study", "Study")
    again = iv.read_intervals(spark, root, "Study")
    assert rows(again.rows) == rows(iv.row_intervals(study, again.days).select(names)) and len(again.days) == 7


def test_look_ups_over_intervals(spark, tmp_path):
    root = s.write(spark, str(tmp_path))
    for model in ("Study", "Experiment", "App"):
        iv.refresh_intervals(spark, root, model)
    study, experiment = (read_snapshots(spark, f"{root}/{m}", m) for m in ("Study", "Experiment"))
    held, arms = (iv.read_intervals(spark, root, m) for m in ("Study", "Experiment"))
    window = lambda df: between_days(df, s.START, s.END)
    assert rows(newest_definition(held.between(s.START, s.END))) == rows(newest_definition(window(study)))
    assert rows(push_names(held.between(s.START, s.END), "__Push Notification")) == rows(push_names(window(study), "__Push Notification"))
    assert rows(senders(arms.between(s.START, s.END))) == rows(senders(window(experiment)))
    assert rows(latest(held.on(s.AFTER), ["message_id"]).select(study.columns)) == rows(latest(study, ["message_id"]))
    assert rows(held.on(s.DAY1).select(study.columns)) == rows(on_day(study, s.DAY1))
