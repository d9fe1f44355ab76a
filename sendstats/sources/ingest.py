"""Loading daily snapshot files into the date-partitioned tables."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sendstats.sources.committed import Day, commit, delete, exists, file_system, is_committed, stage, visible
from sendstats.sources.scans import MODELS, as_day
from sendstats.sources.schemas import SNAPSHOTS

# Fixed value: days after this one follow the newer naming rule.
LAST_OLD_DAY = dt.date(2018, 4, 26)
# Fixed value: names below a day's folder that hold this are no snapshots.
OUTPUT = "output"


def days_between(start, end) -> Iterator[dt.date]:
    first, last = as_day(start), as_day(end)
    for n in range((last - first).days + 1):
        yield first + dt.timedelta(days=n)


def snapshot_pattern(model: str, day: dt.date) -> tuple[str, str]:
    """Folder prefix and name part that mark a model's file of one day.

    Up to 2018-04-26: ``backup_<YYYYMMDD>...`` holding ``.<model>.``; after it
    ``<YYYYMMDD>...`` holding ``_<model>.``.
    """
    text = day.strftime("%Y%m%d")
    if day > LAST_OLD_DAY:
        return text, f"_{model.lower()}."
    return f"backup_{text}", f".{model.lower()}."


def find_snapshot(spark: SparkSession, src: str, model: str, day: dt.date) -> str | None:
    """The day's file of a model, at any depth, only when exactly one matches."""
    prefix, part = snapshot_pattern(model, day)
    fs = file_system(spark, src)
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{src}/{prefix}*")
    matching = []
    # A match is taken whole, be it a file or a folder of part files.
    below = [entry for top in fs.globStatus(glob) or [] if top.isDirectory() for entry in fs.listStatus(top.getPath())]
    while below:
        entry = below.pop()
        path = entry.getPath()
        name = _below(path, prefix).lower()
        if path.getName().startswith((".", "_")) or OUTPUT in name:
            continue
        if part in name:
            matching.append(path.toString())
        elif entry.isDirectory():
            below.extend(fs.listStatus(path))
    return matching[0] if len(matching) == 1 else None


@dataclass
class Load:
    """What became of the days of each model that had a file to load."""

    loaded: dict[str, list[dt.date]] = field(default_factory=dict)
    failed: dict[str, dict[dt.date, str]] = field(default_factory=dict)


def load_snapshots(
    spark: SparkSession, src: str, dst: str, start, end, models: Sequence[str] = MODELS
) -> Load:
    """Add the days that are missing in the tables ``<dst>/<model>``, see ``committed``.

    Each model is one read, one write and one marker over all its new days. If that fails,
    its days are loaded one by one, and those that cannot be are told with the reason. A
    day that another load has added in the meantime stays as that one left it. Only file
    names pass through the driver.
    """
    load = Load()
    for model in models:
        there = _loaded_days(spark, f"{dst}/{model}")
        new = {}
        for day in days_between(start, end):
            path = None if day in there else find_snapshot(spark, src, model, day)
            if path:
                new[day] = path
        load.loaded[model], load.failed[model] = _load(spark, new, model, f"{dst}/{model}")
    return load


def ingest_snapshots(
    spark: SparkSession, src: str, dst: str, start, end, models: Sequence[str] = MODELS
) -> dict[str, list[dt.date]]:
    """``load_snapshots`` that warns of failed days; returns the days loaded per model."""
    load = load_snapshots(spark, src, dst, start, end, models)
    for model, failed in load.failed.items():
        for day, reason in failed.items():
            warnings.warn(f"{model} of {day} is not loaded: {reason}"[:500], stacklevel=2)
    return load.loaded


def remove_snapshots(
    spark: SparkSession, dst: str, start, end, models: Sequence[str] = MODELS
) -> None:
    """Drop the loaded days of the window, by one marker per model; their files go after that."""
    for model in models:
        path = f"{dst}/{model}"
        there = visible(spark, path)
        gone = [day for day in days_between(start, end) if day in there]
        if gone:
            commit(spark, path, dict.fromkeys(gone), replace=True)
        for day in gone:
            if there[day].folder:
                delete(spark, f"{path}/{there[day].folder}")
        for day in days_between(start, end):
            delete(spark, f"{path}/dt={day}")


def _loaded_days(spark: SparkSession, path: str) -> set[dt.date]:
    """Days of the table. One whose days were stored without markers gets a marker that lists them."""
    if not is_committed(spark, path) and exists(spark, path):
        fs = file_system(spark, path)
        plain = [entry.getPath().getName() for entry in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dt=*"))]
        if plain:
            commit(spark, path, {as_day(name.removeprefix("dt=")): Day(name) for name in plain}, replace=False)
    return set(visible(spark, path))


def _load(spark: SparkSession, new: dict[dt.date, str], model: str, dst: str) -> tuple[list[dt.date], dict[dt.date, str]]:
    """Load all days at once or else one by one: the days added, and those that failed."""
    if not new:
        return [], {}
    try:
        return _copy(spark, new, model, dst), {}
    except (Py4JJavaError, PySparkException):
        done, failed = [], {}
        for day in sorted(new):
            try:
                done += _copy(spark, {day: new[day]}, model, dst)
            except (Py4JJavaError, PySparkException) as failure:
                failed[day] = str(failure)
        return done, failed


def _copy(spark: SparkSession, paths: dict[dt.date, str], model: str, dst: str) -> list[dt.date]:
    stored = SNAPSHOTS[model]
    schema = type(stored)([field for field in stored if field.name != "dt"])
    days = [
        spark.read.schema(schema).parquet(path).withColumn("dt", F.lit(day))
        for day, path in sorted(paths.items())
    ]
    every = days[0]
    for day in days[1:]:
        every = every.unionByName(day)
    return commit(spark, dst, stage(every, dst, paths), replace=False)


def _below(path, prefix: str) -> str:
    """The part of a path that starts with the day's folder."""
    text = path.toString()
    return text[text.rindex(f"/{prefix}"):]
