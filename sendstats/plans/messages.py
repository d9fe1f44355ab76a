"""Message-level columns shared by the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendstats.functions.events import start_date
from sendstats.functions.mail import category_name

DEFAULT_LINK_BASE = "https://dashboard.example.com/dashboard"


def with_live_message(df: DataFrame, live_study: DataFrame, channel: str) -> DataFrame:
    """Add what the current message entity says, and drop messages that are of
    another channel by now. A message without an entity is kept."""
    live = live_study.select(
        "message_id",
        "category_id",
        F.col("name").alias("live_name"),
        F.col("action_type").alias("live_type"),
        start_date(F.col("active_since")).alias("StartDate"),
    )
    joined = df.join(live, "message_id", "left")
    same = F.col("live_type").isNull() | (F.col("live_type") == channel)
    return joined.where(same).drop("live_type").withColumn(
        "StartDate", F.coalesce("StartDate", F.lit("Unknown"))
    )


def with_category(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "Category", category_name(F.col("unsubscribe_categories"), F.col("category_id"))
    )
