"""The tables a report reads, and the apps it covers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sendstats.functions.mail import file_safe
from sendstats.operators.dims import latest, message_ids
from sendstats.operators.nesting import email_position
from sendstats.operators.sizing import join_few
from sendstats.sources.scans import between_days, on_day, read_sessions, read_snapshots


class Inputs:
    """Sessions and all snapshots, unfiltered; a report takes its own window."""

    # An Observation that gets the counts of events that are not counted, by cause.
    watch = None

    def __init__(self, sessions: DataFrame, study: DataFrame, experiment: DataFrame, app: DataFrame):
        self.sessions = sessions
        self.study = study
        self.experiment = experiment
        self.app = app

    @cached_property
    def live_study(self) -> DataFrame:
        return latest(self.study, ["message_id"])

    @cached_property
    def live_app(self) -> DataFrame:
        return latest(self.app, ["app_id"])

    def window(self, start, end) -> Window:
        return Window(self, start, end)


@dataclass(frozen=True)
class Window:
    """The rows of one report window."""

    inputs: Inputs
    start: object
    end: object

    @property
    def sessions(self) -> DataFrame:
        return between_days(self.inputs.sessions, self.start, self.end)

    @property
    def study(self) -> DataFrame:
        return between_days(self.inputs.study, self.start, self.end)

    @property
    def experiment(self) -> DataFrame:
        return between_days(self.inputs.experiment, self.start, self.end)


def read_inputs(spark: SparkSession, root: str, report: str = "all") -> Inputs:
    return Inputs(
        read_sessions(spark, f"{root}/sessions", report),
        read_snapshots(spark, f"{root}/Study", "Study"),
        read_snapshots(spark, f"{root}/Experiment", "Experiment"),
        read_snapshots(spark, f"{root}/App", "App"),
    )


def company_apps(app: DataFrame, day, company_id: int | None = None) -> DataFrame:
    """Apps in the snapshot of ``day``, optionally of one company."""
    apps = on_day(app, day)
    if company_id is not None:
        apps = apps.where(F.col("company_id") == int(company_id))
    return apps.select(
        "company_id", "app_id", F.col("name").alias("AppName"),
        F.col("email_from_address").alias("default_sender"),
    )


@dataclass(frozen=True)
class Scope:
    """The apps a report covers: one app, one company's, or all of them."""

    inputs: Inputs
    end: object
    company_id: int | None = None
    app_id: int | None = None

    def __post_init__(self):
        if self.company_id is not None and self.app_id is not None:
            raise ValueError("a report covers a company or an app, not both")
        if self.app_id is None and on_day(self.inputs.app, self.end).isEmpty():
            raise ValueError(f"no App snapshot of {self.end}, which lists the apps of the report")

    def listing(self) -> DataFrame:
        """Name and default sender of each covered app.

        One app is taken as it is now; a company, or everything, as listed in
        the snapshot of the last day. Default senders are always of that day.
        """
        listed = company_apps(self.inputs.app, self.end, self.company_id).drop("company_id")
        if self.app_id is None:
            return listed
        live = self.of_app(self.inputs.live_app)
        default = self.of_app(listed).drop("AppName")
        return live.select("app_id", F.col("name").alias("AppName")).join(default, "app_id", "left")

    def covered(self) -> DataFrame | None:
        """Ids of the apps of one app's or one company's report; None for a report on all."""
        if self.app_id is not None:
            spark = self.inputs.app.sparkSession
            return spark.range(int(self.app_id), int(self.app_id) + 1).toDF("app_id")
        return None if self.company_id is None else self.listing().select("app_id")

    def apps(self) -> DataFrame:
        """The listing with file-safe names and the current categories."""
        live = self.of_app(self.inputs.live_app).select("app_id", "unsubscribe_categories")
        listed = self.listing().join(live, "app_id", "left")
        return listed.withColumn("App", file_safe(F.col("AppName"))).drop("AppName")

    def email_positions(self) -> DataFrame:
        """Position of the email attribute per app, NULL without a live app."""
        live = email_position(self.of_app(self.inputs.live_app))
        return self.listing().select("app_id").join(live, "app_id", "left")

    def of_app(self, df: DataFrame) -> DataFrame:
        """A single app is a plain predicate, which reaches the scan."""
        return df if self.app_id is None else df.where(F.col("app_id") == int(self.app_id))

    def ids(self, live_study: DataFrame, channel: str) -> DataFrame:
        ids = message_ids(self.of_app(live_study), channel)
        if self.company_id is None:
            return ids
        return ids.join(self.listing(), "app_id", "left_semi")

    def sessions(self, sessions: DataFrame) -> DataFrame:
        if self.company_id is None or self.app_id is not None:
            return self.of_app(sessions)
        return join_few(sessions, self.listing().select("app_id"), ["app_id"], "left_semi")
