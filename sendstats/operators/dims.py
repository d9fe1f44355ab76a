"""Dimension look-ups over snapshots of messages, experiments and apps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sendstats.functions.mail import delivery_type

# Patterns over the names of experiment variables.
SUBJECT_VAR = "Subject"
SENDER_VAR = "Sender email"
VARIANT_PREFIX = 12  # a message id starts at this character of a variable name


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark turns this shape into a group limit that already drops rows before
    the shuffle, so a key with very many rows does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The entities as they are now: those of the newest snapshot, one row per key.

    What is gone from that snapshot was deleted, whatever earlier ones say. Its day is a
    scalar subquery, so that only its partition is read.
    """
    last = df.select("dt").agg(F.max("dt")).scalar()
    rest = [F.col(c).desc() for c in df.columns if c not in keys and c != "dt"]
    return newest(df.where(F.col("dt") == last), keys, [F.col("dt"), *rest])


def message_ids(study: DataFrame, channel: str) -> DataFrame:
    """(app, message) pairs of one channel."""
    return study.where(F.col("action_type") == channel).select("app_id", "message_id").distinct()


def ids_from_literals(spark: SparkSession, ids: Sequence[int]) -> DataFrame:
    """A caller's list of message ids as rows."""
    values = F.array(*[F.lit(int(i)) for i in ids]).cast("array<bigint>")
    return spark.range(1).select(F.explode(values).alias("message_id"))


def newest_definition(study: DataFrame) -> DataFrame:
    """Name and delivery type of each message, by its last change."""
    order = [
        F.col("last_change_time").desc(), F.col("dt").desc(),
        F.col("name").desc(), F.col("delivery_type").desc(),
    ]
    return newest(study, ["message_id"], order).select(
        "message_id", "name", delivery_type(F.col("delivery_type")).alias("Type")
    )


def push_names(study: DataFrame, channel: str) -> DataFrame:
    """One snapshot name per (app, message) of the channel, the newest."""
    named = study.where(F.col("action_type") == channel).select("app_id", "message_id", "name", "dt")
    return newest(named, ["app_id", "message_id"], [F.col("dt").desc(), F.col("name").desc()]).drop("dt")


def vars_named(experiment: DataFrame, predicate: Callable[[Column], Column]) -> DataFrame:
    """The variables whose name satisfies ``predicate``, one per row."""
    flat = experiment.select("variant_id", "message_id", "dt", F.explode("vars").alias("var"))
    name = F.col("var.name")
    return flat.where(predicate(name)).select(
        "variant_id", "message_id", "dt",
        name.alias("var_name"), F.col("var.value.text").alias("text"),
    )


def subject_lines(experiment: DataFrame) -> DataFrame:
    """Distinct subjects per message."""
    found = vars_named(experiment, lambda name: name == SUBJECT_VAR)
    return found.select("message_id", F.col("text").alias("Subject")).distinct()


def newest_subject(experiment: DataFrame) -> DataFrame:
    """One subject per message, of its newest snapshot."""
    found = vars_named(experiment, lambda name: name == SUBJECT_VAR)
    order = [F.col("dt").desc(), F.col("text")]
    return newest(found, ["message_id"], order).select(
        "message_id", F.col("text").alias("newest_subject")
    )


def variant_messages(experiment: DataFrame) -> DataFrame:
    """Distinct (variant, message) pairs: the variable name ends in the id."""
    tail = F.substr(F.col("var_name"), F.lit(VARIANT_PREFIX))
    found = vars_named(
        experiment,
        lambda name: F.substr(name, F.lit(VARIANT_PREFIX)).rlike("[0-9]{16}"),
    ).select("variant_id", tail.alias("tail"), tail.try_cast("bigint").alias("message_id"))
    # Ids are compared as text, so a tail with anything around the id is no match.
    exact = F.col("message_id").cast("string") == F.col("tail")
    return found.where(exact).select("variant_id", "message_id").distinct()


def variant_subjects(experiment: DataFrame) -> DataFrame:
    """The newest subject line of each (variant, message)."""
    found = vars_named(experiment, lambda name: name.contains(".Subject")).select(
        "variant_id",
        F.substr(F.col("var_name"), F.lit(VARIANT_PREFIX), F.lit(16)).try_cast("bigint").alias("message_id"),
        "dt",
        F.col("text").alias("variant_subject"),
    ).where(F.col("message_id").isNotNull())
    order = [F.col("dt").desc(), F.col("variant_subject")]
    return newest(found, ["variant_id", "message_id"], order).drop("dt")


def senders(experiment: DataFrame) -> DataFrame:
    """The newest sender address of each message."""
    found = vars_named(experiment, lambda name: name == SENDER_VAR)
    order = [F.col("dt").desc(), F.col("variant_id").desc(), F.col("text").desc()]
    return newest(found, ["message_id"], order).select("message_id", F.col("text").alias("sender"))


def sender_or_default(sender: Column, default: Column) -> Column:
    """The message's own sender unless it is missing or empty."""
    return F.coalesce(F.nullif(sender, F.lit("")), default, F.lit(""))
