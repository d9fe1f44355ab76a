"""Report inputs derived from the driver's tables (formulas: FIXTURES.md).

Every input is a row-wise projection of one whole table, so nothing here
shuffles: ``events`` -> sessions, ``part`` -> messages and experiments,
``supplier`` -> apps. Only for snapshots that are stored by day the rows of the table are
dealt first (``dealt``): each task sorts by day what its few narrow rows become.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sendstats.plans.inputs import Inputs
from sendstats.sources.scans import flat_keys

START = dt.date(2024, 1, 1)
END = dt.date(2024, 1, 30)
# Snapshot days; the last one lies after the window and is the live state.
SNAPSHOT_DAYS = (
    dt.date(2024, 1, 1), dt.date(2024, 1, 11), dt.date(2024, 1, 30), dt.date(2024, 2, 5),
)
FIRST_MESSAGE = 4500000000000000
HOT_MESSAGES = 40
# Rows of a table that one task makes stored snapshots of.
TASK_ROWS = 50_000

DAYS = "array(" + ", ".join(f"DATE '{day}'" for day in SNAPSHOT_DAYS) + ")"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str, dealt: bool) -> DataFrame:
    """``df`` in parts of some ``TASK_ROWS`` rows, whatever files it lies in, if it is to be ``dealt``."""
    return df.repartition(max(1, -(-df.count() // TASK_ROWS)), key) if dealt else df


def snapshots(df: DataFrame, first: str) -> DataFrame:
    """Each row once per snapshot from number ``first`` on, as ``s`` and ``dt``."""
    return df.selectExpr("*", f"posexplode({DAYS}) AS (s, dt)").where(f"s >= {first}")


def parts(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    part = spread(table(spark, sf_dir, "part").selectExpr("p_partkey AS k", "p_name", "p_size"), "k", dealt)
    known = snapshots(part, "CASE WHEN p_size % 25 = 13 THEN 3 ELSE 0 END")
    # Some are deleted before the last snapshot.
    return known.where("NOT (s = 3 AND p_size % 25 = 4)")


def raw_study(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    return parts(spark, sf_dir, dealt).selectExpr(
        "struct(4500000000000000 + k AS id) AS __key__",
        "struct(k div 20 AS id) AS app",
        "concat(p_name, ' #', k, CASE WHEN k % 6 = 0 THEN concat(' v', s) ELSE '' END) AS name",
        """CASE WHEN k % 50 IN (7, 13) AND s = 3 THEN '__In App'
                WHEN k % 5 = 3 THEN '__Push Notification'
                WHEN k % 5 = 4 THEN '__In App' ELSE '__Email' END AS action_type""",
        "p_size % 8 AS delivery_type",
        """timestamp_seconds(1701388800 + 86400 * (k % 30
             + CASE WHEN k % 6 = 0 AND k % 12 <> 0 THEN s ELSE 0 END)) AS last_change_time""",
        """timestamp_seconds(CASE WHEN k % 10 <> 9 THEN 1698883199 + 86400 * (k % 60) END)
             AS active_since""",
        """CASE WHEN k % 3 <> 0
                THEN (k + CASE WHEN k % 7 = 0 AND s = 3 THEN 1 ELSE 0 END) % 4 END AS category_id""",
        "dt",
    )


def raw_experiment(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    arms = parts(spark, sf_dir, dealt).where("k % 5 < 3").selectExpr(
        "k", "s", "dt", "explode(CASE WHEN k % 4 = 0 THEN array(0, 1) ELSE array(0) END) AS b"
    )
    texts = arms.selectExpr(
        "*",
        "concat('__message__', 4500000000000000 + k) AS arm_var",
        "concat('Subj ', k, CASE WHEN k % 8 = 0 AND b = 1 THEN concat(' r', s) ELSE '' END) AS subject",
        """CASE WHEN k % 15 = 6 THEN 'no-at-sender' WHEN k % 25 = 11 THEN ''
                ELSE concat('news', k, '@mail', k % 3,
                            CASE WHEN k % 8 = 4 AND b = 1 THEN '.alt' ELSE '' END, '.example.com')
                END AS sender""",
        """concat('Subj ', k, CASE WHEN b = 0 THEN ' /A' ELSE ' /B' END,
                  CASE WHEN k % 16 = 0 THEN concat(' r', s) ELSE '' END) AS arm_subject""",
    )

    def var(name: str, text: str) -> str:
        return f"named_struct('name', {name}, 'value', named_struct('text', {text}))"

    subject, sender = var("'Subject'", "subject"), var("'Sender email'", "sender")
    own, shown = var("arm_var", "''"), var("concat(arm_var, '.Subject')", "arm_subject")
    return texts.selectExpr(
        "struct(9000000000 + 2 * k + b AS id) AS __key__",
        "struct(4500000000000000 + k AS id) AS study",
        f"""concat(array({subject}),
              CASE WHEN k % 5 <> 2 THEN array({sender}) ELSE array() END,
              CASE WHEN k % 4 = 0 THEN array({own}) ELSE array() END,
              CASE WHEN k % 4 = 0 AND k % 12 <> 8 THEN array({shown}) ELSE array() END) AS vars""",
        "dt",
    )


def raw_app(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS a", "s_name", "s_nationkey")
    rows = snapshots(spread(supplier, "a", dealt), "CASE WHEN a % 25 = 22 THEN 3 ELSE 0 END")
    news, promo, late = (
        f"named_struct('id', {n}L, 'name', '{name}')" for n, name in ((1, "News"), (2, "Promo"), (1, "Late"))
    )
    return rows.selectExpr(
        "struct(a AS id) AS __key__",
        "struct(cast(s_nationkey AS bigint) AS id) AS company",
        """concat(CASE WHEN a % 7 = 0 THEN translate(s_name, '#', '/') ELSE s_name END,
                  CASE WHEN a % 5 = 1 AND s = 3 THEN ' new' ELSE '' END) AS name""",
        """concat('default', CASE WHEN a % 4 = 1 THEN cast(s AS string) ELSE '' END,
                  '@app', a, '.example.net') AS email_from_address""",
        "CASE WHEN a % 25 = 23 THEN 'mail' WHEN a % 25 <> 24 THEN 'email' END AS email_user_attribute",
        """array(CASE WHEN a % 3 = 0 THEN 'email' ELSE 'attr_0' END,
                 CASE WHEN a % 3 = 1 THEN 'email' ELSE 'attr_1' END,
                 CASE WHEN a % 3 = 2 THEN 'email' ELSE 'attr_2' END) AS attribute_columns""",
        f"""CASE WHEN a % 6 = 4 THEN array({news}, {promo}, {late})
                 WHEN a % 2 = 0 THEN array({news}, {promo}) END AS unsubscribe_categories""",
        "dt",
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per ``events`` row, with three states of events."""
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "cast(ts AS date) AS dt",
        "cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS pk",
        "(event_id * 7 + user_id * 3) % 20 AS code",
        # Seconds since 1970 of a zone-less timestamp, with its fraction.
        """cast(unix_date(cast(ts AS date)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 AS double)
             + cast(extract(SECOND FROM ts) AS double) AS t""",
    )
    message = base.selectExpr(
        "*", "CASE WHEN pk < 40 THEN pk ELSE event_id div 5 END AS m",
    ).selectExpr(
        "*",
        "m div 20 AS app_id",
        "concat('.m', 4500000000000000 + m) AS head",
        """CASE WHEN code < 7 THEN '' WHEN code < 12 THEN ' Delivered' WHEN code < 15 THEN ' Open'
                WHEN code = 15 THEN ' Click' WHEN code = 16 THEN ' Bounce'
                WHEN code = 17 AND m % 5 = 3 THEN ' Held Back' WHEN code = 17 THEN ' Dropped'
                WHEN code = 18 AND m % 2 = 1 THEN ' Block' WHEN code = 18 THEN ' Unsubscribe'
                ELSE ' Marked as spam' END AS tail""",
        """concat('u', user_id, CASE user_id % 10
             WHEN 0 THEN '@Gmail.com'
             WHEN 1 THEN CASE WHEN event_id % 2 = 1 THEN '@hotmail.com' ELSE '@yahoo.com' END
             WHEN 2 THEN '@hotmail.com' WHEN 3 THEN '@example.org' WHEN 5 THEN '' WHEN 6 THEN '@QQ.com'
             WHEN 7 THEN '@corp.example' WHEN 8 THEN '@icloud.com' WHEN 9 THEN '@yahoo.co.uk'
             END) AS email""",
        "array(named_struct('variant', 9000000000 + 2 * m + user_id % 2)) AS arm",
    )
    named = message.selectExpr(
        "*",
        "CASE WHEN event_type = 'error' THEN 'session end' ELSE concat(head, tail) END AS first",
        """CASE WHEN tail = '' THEN concat(head, ' Delivered')
                WHEN tail = ' Delivered' AND user_id % 2 = 0 THEN concat(head, ' Open')
                WHEN tail = ' Delivered' THEN head ELSE 'session end' END AS second""",
        """CASE WHEN event_id % 97 = 5 THEN concat('.m', 4500000000000000 + m + 20, ' Open')
                WHEN event_id % 499 = 3 THEN '.mbadidbadidbadid1 Open'
                WHEN event_id % 211 = 9 THEN '.m4599999999999999 Click' END AS third""",
    )

    def event(name: str, time: str) -> str:
        return f"named_struct('name', {name}, 'time', {time})"

    return named.selectExpr(
        "user_id", "app_id",
        f"""array(
              struct(array_repeat({event("first", "t")}, cast(1 + event_id % 3 AS int)) AS events),
              struct(array({event("second", "t + 3600.5D")}) AS events),
              struct(CASE WHEN third IS NOT NULL THEN array({event("third", "t")}) END AS events)
            ) AS states""",
        """array(CASE WHEN app_id % 3 = 0 THEN email ELSE 'x' END,
                 CASE WHEN app_id % 3 = 1 THEN email ELSE 'x' END,
                 CASE WHEN app_id % 3 = 2 THEN email ELSE 'x' END) AS attrs""",
        """CASE WHEN user_id % 3 = 2 THEN array()
                ELSE concat(arm, CASE WHEN user_id % 11 = 0 THEN arm ELSE array() END,
                            CASE WHEN user_id % 7 = 0 THEN array(named_struct('variant', 1L)) ELSE array() END)
                END AS experiments""",
        "dt",
    )


class DerivedInputs(Inputs):
    """The inputs over one folder of tables, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions(self.spark, self.sf_dir)

    @cached_property
    def study(self) -> DataFrame:
        return flat_keys(raw_study(self.spark, self.sf_dir), "Study")

    @cached_property
    def experiment(self) -> DataFrame:
        return flat_keys(raw_experiment(self.spark, self.sf_dir), "Experiment")

    @cached_property
    def app(self) -> DataFrame:
        return flat_keys(raw_app(self.spark, self.sf_dir), "App")
