"""Scans of date-partitioned tables.

Layout: ``<root>/sessions``, ``<root>/Study``, ``<root>/Experiment`` and
``<root>/App``, Parquet partitioned by ``dt``; tables that ``load_snapshots`` fills have
commit markers besides. A day without data simply matches nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sendstats.sources.committed import is_committed, read_committed
from sendstats.sources.schemas import FLAT_KEYS, SESSIONS, SNAPSHOTS

MODELS = tuple(SNAPSHOTS)
# The longest window of a report and the oldest start, in days.
MAX_WINDOW_DAYS = 32
MAX_AGE_DAYS = 60


def as_day(value: str | dt.date) -> dt.date:
    """A date, or its ``YYYYMMDD`` / ``YYYY-MM-DD`` text."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value.replace("-", ""), "%Y%m%d").date()


def check_window(start, end, as_of) -> None:
    """Refuse reversed or long windows, and starts too far before ``as_of``."""
    first, last = as_day(start), as_day(end)
    if not 0 <= (last - first).days <= MAX_WINDOW_DAYS:
        raise ValueError(f"window must be 0 to {MAX_WINDOW_DAYS} days long: {first}..{last}")
    if (as_day(as_of) - first).days > MAX_AGE_DAYS:
        raise ValueError(f"window may start at most {MAX_AGE_DAYS} days before {as_day(as_of)}")


def between_days(df: DataFrame, start, end) -> DataFrame:
    """Rows of the days from start to end, both included."""
    return df.where(F.col("dt").between(F.lit(as_day(start)), F.lit(as_day(end))))


def on_day(df: DataFrame, day) -> DataFrame:
    return df.where(F.col("dt") == F.lit(as_day(day)))


def flat_keys(raw: DataFrame, model: str) -> DataFrame:
    """Project the nested keys of a snapshot to flat columns."""
    keys = FLAT_KEYS[model]
    nested = {path.split(".")[0] for path in keys.values()}
    return raw.select(
        *[F.col(path).alias(name) for name, path in keys.items()],
        *[c for c in raw.columns if c not in nested],
    )


def read_sessions(spark: SparkSession, path: str, report: str = "all") -> DataFrame:
    """Sessions with only the columns that ``report`` needs."""
    return spark.read.schema(SESSIONS[report]).parquet(path)


def read_snapshots(spark: SparkSession, path: str, model: str) -> DataFrame:
    """The snapshots of a model: the committed days only, if the table has markers."""
    if is_committed(spark, path):
        return flat_keys(read_committed(spark, path, SNAPSHOTS[model]), model)
    return flat_keys(spark.read.schema(SNAPSHOTS[model]).parquet(path), model)


def scan_sessions(spark: SparkSession, path: str, start, end, report: str = "all") -> DataFrame:
    return between_days(read_sessions(spark, path, report), start, end)


def scan_snapshots(spark: SparkSession, path: str, model: str, start, end) -> DataFrame:
    return between_days(read_snapshots(spark, path, model), start, end)


def app_asof(spark: SparkSession, path: str, day) -> DataFrame:
    return on_day(read_snapshots(spark, path, "App"), day)
